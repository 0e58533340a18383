"""Network-detection analytics as Spark jobs."""
