"""Page-stream analytics on Spark: signals, boundaries, segments, classes, reports."""
