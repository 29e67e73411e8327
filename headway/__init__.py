"""Trip-arrival analytics on Spark: clean, featurise, split, train, score, explain."""
