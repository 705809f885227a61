"""changelake: change-data-capture ingestion written as Spark DataFrame jobs."""
