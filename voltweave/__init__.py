"""Spark-first analytics for smart-meter load surveys."""
