"""Column expressions and DataFrame helpers built from native Spark functions."""
