"""Bill-document ETL and extraction scoring, written as Spark DataFrame jobs."""
