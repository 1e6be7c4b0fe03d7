"""Market, macro, weather and sentiment time series as Spark DataFrame jobs."""
