"""Column-level helpers built from Spark's built-in functions (no Python UDFs)."""
