"""Operators: functions DataFrame -> DataFrame."""
