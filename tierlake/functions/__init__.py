"""Column functions. Every one is a composition of Spark built-ins."""
