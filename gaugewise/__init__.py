"""Monitoring-data analytics as composable Spark DataFrame transformations."""
