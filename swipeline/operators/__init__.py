"""Operators: functions from transaction DataFrames to result DataFrames."""
