"""Episode quality scoring, ingest and reporting as Spark DataFrame jobs."""
