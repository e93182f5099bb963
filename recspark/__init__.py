"""Recommendation data work as Spark DataFrame functions."""
