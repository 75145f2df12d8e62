"""Panel time-series features, forecasts and evaluation as plain PySpark jobs."""
