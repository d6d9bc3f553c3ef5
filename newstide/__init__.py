"""News-sentiment and market-data analytics, written as Spark DataFrame jobs."""
