"""Whole maps: DataFrames in, layer tables out."""
