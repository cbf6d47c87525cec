"""Column expressions: everything here is built from native Spark functions."""
