"""Change detection against the last snapshot or the target table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.hashing import row_hash
from ..functions.text import as_col
from .relate import anti


def flag_delta(
    cur: DataFrame,
    prev: DataFrame,
    key: str | None = None,
    cols: Sequence[str] | None = None,
    to: str = "isdelta",
    mode: str = "safe",
) -> DataFrame:
    """Mark rows whose trimmed key, or hash of ``cols``, is not in the previous snapshot.

    Copies of a row are removed. A row with a null key is new, and a null in the snapshot matches nothing.
    The drop is shuffled once: it meets the snapshot's identities by its own, and copies, which share an identity, are
    removed where they already lie together.
    """
    if (key is None) == (cols is None):
        raise ValueError("give either key or cols")

    def ident(df: DataFrame) -> Column:
        return row_hash(*cols, mode=mode) if cols is not None else F.trim(as_col(key).cast("string"))

    seen = prev.select(ident(prev).alias("_seen")).filter("_seen IS NOT NULL").distinct()
    # The second key makes Spark shuffle the distinct identities once more, so that a hot one of the drop can be split.
    seen = seen.withColumn("_seen_mark", F.xxhash64("_seen"))
    rows = cur.withColumn("_ident", ident(cur)).withColumn("_mark", F.xxhash64("_ident"))
    joined = rows.join(seen, (F.col("_ident") == F.col("_seen")) & (F.col("_mark") == F.col("_seen_mark")), "left")
    flagged = joined.withColumn(to, F.col("_seen").isNull()).drop("_seen", "_seen_mark")
    return flagged.distinct().drop("_ident", "_mark")


def new_by_key(cur: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct rows whose key the target lacks. A null key is never in the target."""
    return anti(cur.distinct(), target, key)


def new_by_hash(cur: DataFrame, target: DataFrame, cols: Sequence[str], mode: str = "safe") -> DataFrame:
    """Rows whose hash over ``cols`` the target lacks; copies within ``cur`` stay."""
    held = target.select(row_hash(*cols, mode=mode).alias("_hash"))
    return cur.withColumn("_hash", row_hash(*cols, mode=mode)).join(held, ["_hash"], "left_anti").drop("_hash")
