"""Table operators: every one takes tables and returns tables."""
