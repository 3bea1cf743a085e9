"""Yield models on Spark ML."""
