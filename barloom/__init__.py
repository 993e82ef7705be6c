"""Panel time-series analytics on Spark: bars, features, labels, cross-sections and quality checks."""
