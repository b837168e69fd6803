"""Column expressions; all built from Spark built-ins, no Python UDF."""
