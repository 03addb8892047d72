"""Column expressions: no function here starts a Spark job."""
