"""Unions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """By position, keeping copies; types are widened."""
    return a.union(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """SQL UNION: by position, copies removed, also those inside one side."""
    return a.union(b).distinct()


def union_by_name(*frames: DataFrame) -> DataFrame:
    """By name; columns a frame lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_many(frames: Sequence[DataFrame]) -> DataFrame:
    """Fold any number of same-shaped frames, by name."""
    return reduce(DataFrame.unionByName, frames)
