"""Column-level building blocks (Column -> Column), all Spark built-ins."""
