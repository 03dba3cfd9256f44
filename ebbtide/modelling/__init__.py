"""Feature preparation, selection, Spark ML training, scoring and evaluation."""
