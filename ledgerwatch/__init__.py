"""Transaction monitoring on Spark: load, profile, detect, score, report and test."""
