"""Operators over DataFrames; each takes the names of the columns it works on."""
