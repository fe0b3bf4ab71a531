"""Availability analytics on Spark: features, as-of joins, splits, forecasts, monitoring and serving tables."""
