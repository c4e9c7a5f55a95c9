"""Fixed values and reusable Spark column expressions."""
