"""Monthly insurance-claims emergence, expressed as Spark DataFrame operations."""
