"""Container-metric time series on Spark: preparation, analysis and forecasting."""
