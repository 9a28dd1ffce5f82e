"""Data-quality checks, cleaning and aggregation of retail sales, as Spark jobs."""
