"""Spark-native engine for building reviewable datasets from two-sided recordings."""
