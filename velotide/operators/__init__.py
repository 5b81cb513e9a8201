"""Operators: functions from DataFrame to DataFrame, no actions unless stated."""
