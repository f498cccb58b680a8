"""Operators: functions from DataFrames to DataFrames. They stay lazy unless their text says otherwise."""
