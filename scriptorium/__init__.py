"""scriptorium: building, querying and checking large text libraries on Spark."""
