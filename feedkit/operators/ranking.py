"""First row per key.

Orders must end in columns that make a row unique among the columns kept, or the survivor is arbitrary. Spark's
own null placement applies unless the order says otherwise: ascending puts nulls first, descending last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import as_col


def keep_first(df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key.

    The ``= 1`` filter on a row number makes Spark cut every key down to one row per task before the shuffle,
    so a key holding a third of the table costs no more than any other.
    """
    w = Window.partitionBy(*[as_col(k) for k in keys]).orderBy(*[as_col(o) for o in order])
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def flag_first(
    df: DataFrame,
    keys: Sequence[Column | str],
    order: Sequence[Column | str],
    to: str = "is_first",
    salts: int | None = None,
) -> DataFrame:
    """Keep all rows and mark the first one per key.

    Here every row must pass through a window, so each key is first spread over ``salts`` groups, by default as many
    as the session has shuffle partitions; the result does not depend on the number. Only the
    winner of each group meets the other winners of its key; the rest stay spread. The salt mixes the row's
    values with its task number: different rows spread, copies of one row spread, and a task that is run again
    gives each row the same salt.
    """
    salts = salts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = {f"_key{i}": k for i, k in enumerate(keys) if not isinstance(k, str)}  # plain columns are not copied: all rows travel twice
    key_cols = [as_col(k) if isinstance(k, str) else F.col(f"_key{i}") for i, k in enumerate(keys)]
    spread = F.pmod(F.xxhash64(*[as_col(c) for c in df.columns]) + F.spark_partition_id(), F.lit(salts))
    by = [as_col(o) for o in order]
    salted = df.withColumns(names).withColumn("_salt", spread)
    local = salted.withColumn("_local", F.row_number().over(Window.partitionBy(*key_cols, "_salt").orderBy(*by)))
    grouped = local.withColumn("_group", F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_salt")))
    final = F.row_number().over(Window.partitionBy(*key_cols, "_group").orderBy(*by))
    return grouped.withColumn("_final", final).withColumn(to, (F.col("_group") == -1) & (F.col("_final") == 1)).drop(
        *names, "_salt", "_local", "_group", "_final"
    )


def split_first(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[Column | str], salts: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(first row per key, all other rows)."""
    marked = flag_first(df, keys, order, "_first", salts)
    return marked.filter("_first").drop("_first"), marked.filter("NOT _first").drop("_first")


def drop_dups(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """``dropDuplicates`` on a subset with a stable survivor. Rows with equal (also null) keys are one group."""
    return keep_first(df, keys, order)


def first_value_of(df: DataFrame, col: str) -> DataFrame:
    """One row: the smallest distinct value of a column."""
    return df.agg(F.min(col).alias(col))
