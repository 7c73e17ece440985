"""Joins beyond the plain equi join. None of them needs a nested loop or a forced broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def join_on_exprs(
    left: DataFrame, right: DataFrame, pairs: Sequence[tuple[Column, Column]], how: str = "inner"
) -> DataFrame:
    """Equi join on expressions: ``pairs`` are (left expression, right expression). Keys are not kept.

    The expressions are computed first, on their own side, so Spark sees an ordinary equi join.
    """
    keys = [f"_k{i}" for i in range(len(pairs))]
    lhs = left.withColumns({k: p[0] for k, p in zip(keys, pairs)})
    rhs = right.withColumns({k: p[1] for k, p in zip(keys, pairs)})
    return lhs.join(rhs, keys, how).drop(*keys)


def lookup(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str = "left") -> DataFrame:
    """Join with a side that was grouped, or made distinct, by the keys of this join.

    Spark would reuse the grouping's shuffle for the join, and adaptive execution splits a hot key only where both
    inputs of a join are plain shuffles. Joining on the hash of the keys as well makes Spark shuffle the grouped
    side once more, which is little after grouping, and leaves the hot key of the other side to be split.
    """
    pairs = [(left[a], right[b]) for a, b in on]
    cond = pairs[0][0] == pairs[0][1]
    for a, b in pairs[1:]:
        cond = cond & (a == b)
    # Equal values hash alike only within one type; other pairs join as they are.
    if all(left.schema[a].dataType == right.schema[b].dataType for a, b in on):
        cond = cond & (F.xxhash64(*[a for a, _ in pairs]) == F.xxhash64(*[b for _, b in pairs]))
    return left.join(right, cond, how)


def join_any_key(left: DataFrame, right: DataFrame, key: str, others: Sequence[str]) -> DataFrame:
    """Inner join where ``left.key`` equals any of the right columns ``others``.

    Each right row is listed once per distinct value among those columns, which turns the condition into one
    equi join that finds every pair once. A join on ``a = x OR a = y`` would compare all rows with all rows.
    """
    listed = right.withColumn("_any", F.explode(F.array_distinct(F.array(*others)))).filter("_any IS NOT NULL")
    return left.join(listed, left[key] == F.col("_any"), "inner").drop("_any")


def resolve_id(df: DataFrame, xref: DataFrame, key: str, xref_key: str, value: str, to: str, how: str = "inner") -> DataFrame:
    """Bring in the id that ``xref`` holds for an external id.

    ``how='inner'`` drops unmapped rows, ``'left'`` keeps them with a null. An external id listed for several
    values repeats the row: uniqueness of the cross-reference is the caller's contract.
    """
    table = xref.select(F.col(xref_key).alias("_xkey"), F.col(value).alias(to)).filter("_xkey IS NOT NULL").distinct()
    return df.join(table, F.col(key) == F.col("_xkey"), how).drop("_xkey")


def semi(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows that have a partner (IN / EXISTS)."""
    return df.join(other.select(*on), list(on), "left_semi")


def anti(df: DataFrame, other: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a partner (NOT EXISTS): a null key never has a partner, so the row stays."""
    return df.join(other.select(*on), list(on), "left_anti")


def filter_in(df: DataFrame, col: str, values: Sequence | DataFrame) -> DataFrame:
    """Rows whose ``col`` is one of ``values``: a short list, or the first column of a frame. Nulls are never in it."""
    if isinstance(values, DataFrame):
        return semi(df, values.select(F.col(values.columns[0]).alias(col)), [col])
    return df.filter(F.col(col).isin(*values)) if values else df.filter(F.lit(False))


def with_partner_flag(df: DataFrame, other: DataFrame, key: str, other_key: str, to: str) -> DataFrame:
    """Boolean column: does ``other`` hold this key? Usable inside a larger condition."""
    keys = other.select(F.col(other_key).alias("_okey")).filter("_okey IS NOT NULL").distinct()
    marked = lookup(df, keys.withColumn("_hit", F.lit(True)), [(key, "_okey")])
    return marked.withColumn(to, F.coalesce(F.col("_hit"), F.lit(False))).drop("_okey", "_hit")


def not_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """SQL ``NOT IN``: any null on the other side leaves no rows, a null key passes only if that side is empty.

    Built from an equi anti join and two one-row facts about the other side. Spark's own plan for NOT IN
    broadcasts the other side whatever its size.
    """
    other_key = other_key or key
    keys = other.select(F.col(other_key).alias("_okey"))
    empty = keys.agg(F.count("*") == 0).scalar()
    has_null = keys.agg(F.count_if(F.col("_okey").isNull()) > 0).scalar()
    rest = df.join(keys.filter("_okey IS NOT NULL"), F.col(key) == F.col("_okey"), "left_anti")
    return rest.filter(empty | (~has_null & F.col(key).isNotNull()))


def find_conflicts(df: DataFrame, ref: DataFrame, key: str, id_col: str, ref_key: str, ref_id: str) -> DataFrame:
    """Rows whose ``key`` value is held in ``ref`` by a different id, with the number of such reference rows.

    The reference is counted per (value, id) and per value before the join, so a value shared by very many rows
    is met with one count instead of one row per pair.
    """
    per_id = (
        ref.filter(F.col(ref_key).isNotNull() & F.col(ref_id).isNotNull())
        .groupBy(F.col(ref_key).alias("_key"), F.col(ref_id).alias("_id"))
        .agg(F.count("*").alias("_n"))
    )
    per_key = per_id.groupBy("_key").agg(F.sum("_n").alias("_total"))
    own = per_id.select(F.col("_key").alias("_key2"), F.col("_id").alias("_id2"), F.col("_n").alias("_own"))
    joined = lookup(df.filter(F.col(id_col).isNotNull()), per_key, [(key, "_key")], "inner")
    joined = lookup(joined, own, [(key, "_key2"), (id_col, "_id2")])
    conflicts = F.col("_total") - F.coalesce(F.col("_own"), F.lit(0))
    return joined.withColumn("conflicts", conflicts).filter("conflicts > 0").drop("_key", "_total", "_key2", "_id2", "_own")


def has_other_id(df: DataFrame, ref: DataFrame, key: str, id_col: str, ref_key: str, ref_id: str, to: str) -> DataFrame:
    """Boolean column: is the row's ``key`` held in ``ref`` by an id other than its own?

    Smallest and largest id per value decide that, so the reference side is one row per value.
    """
    held = (
        ref.filter(F.col(ref_key).isNotNull())
        .groupBy(F.col(ref_key).alias("_key"))
        .agg(F.min(ref_id).alias("_low"), F.max(ref_id).alias("_high"))
    )
    own = F.col(id_col)
    other = (F.col("_low") != own) | (F.col("_high") != own)
    marked = lookup(df, held, [(key, "_key")])
    return marked.withColumn(to, F.coalesce(other, F.lit(False))).drop("_key", "_low", "_high")
