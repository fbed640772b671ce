"""Spark ML training, tuning, overfit checks and batch scoring."""
