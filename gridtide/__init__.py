"""Electricity and weather time-series analytics as composable Spark DataFrame operators."""
