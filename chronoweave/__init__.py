"""Daily and 15-minute time series on Spark, driven by import configuration tables."""
