"""Operators for building training data out of documents, pages and vectors.

Nothing outside this package imports it. ``queries`` registers one query for
each operator and the corpus pipeline.
"""
