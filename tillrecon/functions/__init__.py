"""Column expressions. All are native Spark expressions."""
