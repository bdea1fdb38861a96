"""Comment-text analytics as Spark DataFrame jobs."""
