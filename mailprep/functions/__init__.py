"""Column functions: every one takes columns and returns one column."""
