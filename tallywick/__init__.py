"""Analytics jobs written as functions from Spark DataFrame to DataFrame."""
