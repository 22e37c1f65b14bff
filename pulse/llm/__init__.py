"""Training-data pipeline operators: one module per operator, queries in ``queries.py``.

Nothing outside this subpackage imports it.
"""
