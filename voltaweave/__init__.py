"""Spark-native analytics for drifting tabular sources, time series and text corpora."""
