"""Operators of a training-data pipeline: tokenizing, deduplication, filters, search.

Nothing else in the library imports this subpackage; ``queries`` holds the
registered queries and their SQL.
"""
