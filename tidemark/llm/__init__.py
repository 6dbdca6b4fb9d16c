"""Operators of a training-data pipeline over tables of documents and vectors.

Each module holds one operator with an interface of its own; ``queries`` applies them to the given
tables. Nothing else in the library imports this subpackage.
"""
