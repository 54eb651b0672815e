"""Candle analytics on Spark: scan, check, repair, store and derive market time series."""
