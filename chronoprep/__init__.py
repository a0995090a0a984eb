"""chronoprep: Spark-native preparation of time series for model training."""
