"""Operators of a training-data pipeline over ``documents``, ``pages`` and ``conversations``.

Nothing else in tidemark imports this subpackage. Queries and SQL are in ``queries.py``.
"""
