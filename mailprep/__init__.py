"""mailprep: cleaning, labelling and querying customer-mail tables on Spark."""
