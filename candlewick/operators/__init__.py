"""Batch operators of the quote lakehouse, each a DataFrame -> DataFrame function."""
