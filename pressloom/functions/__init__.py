"""Column functions: pure expressions over Spark columns."""
