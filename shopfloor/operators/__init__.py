"""Analytical operators: functions from DataFrames to DataFrames."""
