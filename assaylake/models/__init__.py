"""Spark ML classifiers: training, scoring and storage."""
