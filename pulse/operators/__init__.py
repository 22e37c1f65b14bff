"""Operators: each one a ``DataFrame -> DataFrame`` transform over statuses."""
