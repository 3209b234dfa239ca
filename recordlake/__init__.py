"""recordlake: raw JSON responses to clean, profiled tables on Spark."""
