"""Point-in-time match analytics as Spark DataFrame transformations."""
