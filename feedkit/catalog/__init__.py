"""Every operator bound to the test tables: a Spark query and, where SQL can say it, the same result in SQL."""

from . import columns, feeds, files, jobs, relations, scalars, streams, targets  # noqa: F401  (each registers its queries)
from .registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
