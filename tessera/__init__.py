"""Spark-first analytics over versioned public-indicator data and training-data tables."""
