"""Operators of a training-data pipeline over text and embedding tables.

Nothing else in the library imports this subpackage. Each module holds one
operator; :mod:`sparkfolio.llm.queries` registers one query for each.
"""
