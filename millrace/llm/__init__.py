"""Operators of a training-data pipeline over documents, pages, urls and vectors.

Nothing else in the library imports this package. Every operator is a function on DataFrames;
``queries`` applies each to its whole table.
"""
