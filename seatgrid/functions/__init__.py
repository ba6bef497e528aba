"""Column expressions: DataFrame columns in, columns out, no Python UDFs."""
