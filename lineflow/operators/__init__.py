"""Operators on DataFrames: encode, decode, batch, merge schemas, delivery plans."""
