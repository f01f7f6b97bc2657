"""Column expressions. All of them are built-in Spark functions; there is no Python UDF."""
