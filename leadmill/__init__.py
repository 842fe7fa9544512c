"""leadmill: lead-ingestion and qualification pipeline as Spark DataFrame jobs."""
