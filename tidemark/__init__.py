"""Indicator analytics on Spark."""
