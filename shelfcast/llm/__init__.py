"""Operators of a training-data pipeline: extraction, counting, cleaning,
deduplication and encoding of very large document tables.

Every operator takes DataFrames and returns DataFrames; each module's
docstring gives its method and what it returns for nulls, empty and very long
texts, ties, repeated rows and empty tables.  ``queries`` applies the
operators to the given tables.
"""
