"""Column builders: every scalar and aggregate helper is a built-in Spark expression."""
