"""Column functions; every one is built from Spark's own expressions."""
