"""Routing rows to targets.

A router adds one ``route`` column instead of returning one frame per target: the rules run once, and the
result can be written in one pass with ``partitionBy('route')``. ``split_routes`` gives the separate frames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def route(df: DataFrame, cond: Column, good: str = "good", bad: str = "bad", to: str = "route") -> DataFrame:
    """Label rows by a condition; a null condition counts as bad."""
    return df.withColumn(to, F.when(cond, F.lit(good)).otherwise(F.lit(bad)))


def split_routes(df: DataFrame, routes: Sequence[str], on: str = "route") -> tuple[DataFrame, ...]:
    """One frame per route. Persist or write the routed frame first when several of them are used."""
    return tuple(df.filter(F.col(on) == F.lit(r)).drop(on) for r in routes)


def length_errors(df: DataFrame, col: str, low: int, high: int, to: str = "length_error") -> DataFrame:
    """Flag values shorter than ``low`` or longer than ``high``; nulls are not errors."""
    n = F.length(F.col(col))
    return df.withColumn(to, F.coalesce((n < low) | (n > high), F.lit(False)))
