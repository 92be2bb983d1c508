"""Quality checks and curation of market bars, written as Spark DataFrame jobs."""
