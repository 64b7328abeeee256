"""Operators over DataFrames; column names are arguments."""
