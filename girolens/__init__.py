"""Payment-message analytics expressed as Spark DataFrame jobs."""
