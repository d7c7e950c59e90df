"""Daily demand panels on Spark: reshape, features, classes, forecasts, blends, scores."""
