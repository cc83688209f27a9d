"""Operators: every one maps DataFrames to a DataFrame and stays lazy unless it says otherwise."""
