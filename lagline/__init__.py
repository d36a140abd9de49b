"""Time-series tables on Spark: features, forecasts and monitoring per series."""
