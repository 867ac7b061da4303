"""Operators: functions of DataFrames, without actions or state."""
