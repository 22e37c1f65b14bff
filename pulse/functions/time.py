"""Event-time helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from pulse.settings import CREATED_AT_PATTERN


def created_at_text(ts: Column) -> Column:
    """Date-time as text in Java ``Date.toString`` layout (UTC wall clock)."""
    return F.date_format(ts, CREATED_AT_PATTERN)
