"""Customer and billing analytics on Spark."""
