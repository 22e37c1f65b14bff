"""Column-level helpers built from Spark built-ins."""
