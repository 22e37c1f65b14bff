"""pulse: social-status analytics as plain Spark DataFrame transforms.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark
built-ins, so the same code serves batch reads and Structured Streaming.

* ``pulse.sources``    driver tables, derived status records, lexicons
* ``pulse.operators``  filters, projections, counts and ranks, sentiment, keyed row logs
* ``pulse.functions``  column helpers and the size-checked broadcast
* ``pulse.plans``      the reference's jobs as batch plans, SQL views, DuckDB oracles
* ``pulse.streaming``  file replay, streaming queries, the seven apps
"""

from pulse.session import work_dir  # noqa: F401

__all__ = ["work_dir"]
