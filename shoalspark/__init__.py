"""Coastal survey analytics as Spark DataFrame operators."""
