"""DataFrame -> DataFrame operators, built from built-in Spark expressions."""
