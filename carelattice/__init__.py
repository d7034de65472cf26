"""Provider-directory analytics as Spark DataFrame jobs."""
