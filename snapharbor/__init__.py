"""snapharbor: a snapshot warehouse expressed as Spark DataFrame jobs."""
