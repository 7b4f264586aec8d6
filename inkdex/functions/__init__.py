"""Column expressions: everything here is a built-in Spark expression, no UDFs."""
