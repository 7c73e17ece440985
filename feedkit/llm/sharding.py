"""Shards of nearly equal bytes by histogram sort, in DataFrame operations only.

Rows are ordered by a key. To find the keys that cut the table into equal bytes, the exact bytes below a set of probes
are counted on all partitions at once; only the intervals that still hold a cut are probed again, more finely, until
every cut is as near its target as asked. Then the rows are exchanged once.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import keep

PROBES = 64  # per interval and round


@dataclass(frozen=True)
class Interval:
    """Keys between two probes that hold cuts: of ``key`` in [lo, hi], or of the tie of the one key ``within``."""

    lo: int
    hi: int
    below: int  # bytes under ``lo``
    targets: tuple[int, ...]  # indices of the cuts
    within: int | None = None


def _count(keys: DataFrame, intervals: list[Interval]) -> dict[int, dict[int, tuple]]:
    """Per interval and probe: bytes, and the smallest and largest key there. At most intervals * PROBES rows come back."""
    wide = "decimal(20,0)"  # differences of two longs
    hits = []
    for i, x in enumerate(intervals):  # two per cut at most, and they are disjoint
        value = F.col("key" if x.within is None else "tie")
        hit = value.between(x.lo, x.hi) if x.within is None else (F.col("key") == x.within) & value.between(x.lo, x.hi)
        step = F.lit((x.hi - x.lo) // PROBES + 1).cast(wide)
        slot = F.floor((value.cast(wide) - F.lit(x.lo).cast(wide)) / step).cast("int")
        hits.append(F.when(hit, F.struct(F.lit(i).alias("i"), slot.alias("slot"), value.alias("value"))))
    found = keys.select(F.coalesce(*hits).alias("p"), "size").filter("p IS NOT NULL")
    rows = found.groupBy("p.i", "p.slot").agg(F.sum("size").alias("n"), F.min("p.value").alias("a"), F.max("p.value").alias("b")).collect()
    out: dict[int, dict[int, tuple]] = {}
    for r in rows:
        out.setdefault(r["i"], {})[r["slot"]] = (int(r["n"]), int(r["a"]), int(r["b"]))
    return out


def splitters(keys: DataFrame, cuts: int, tolerance: float) -> list[tuple[int, int | None]]:
    """``cuts - 1`` splitters (key, tie) of a table (key, tie, size): a row is past one if (key, tie) is at or above it.

    A tie of None stands for all rows of the key. Each splitter has between it and its target at most ``tolerance`` of
    a shard's bytes, or the rows of a single (key, tie), which cannot be told apart.
    """
    total, lo, hi = keys.agg(F.coalesce(F.sum("size"), F.lit(0)), F.min("key"), F.max("key")).first()
    if lo is None:
        return []
    total = int(total)
    target = [total * (c + 1) // cuts for c in range(cuts - 1)]
    near = max(1, int(total / cuts * tolerance))
    best: list[tuple[int, tuple[int, int | None]]] = [(total + 1, (hi, None))] * (cuts - 1)
    open_ = [Interval(int(lo), int(hi), 0, tuple(range(cuts - 1)))]
    while open_:
        counted, following = _count(keys, open_), []
        for i, x in enumerate(open_):
            below, slots = x.below, sorted(counted.get(i, {}).items())
            for _, (n, a, b) in slots:
                at = (a, None) if x.within is None else (x.within, a)
                for c in x.targets:
                    if abs(below - target[c]) < best[c][0]:
                        best[c] = (abs(below - target[c]), at)
                inside = tuple(c for c in x.targets if below < target[c] < below + n and best[c][0] > near)
                if inside and a < b:
                    following.append(replace(x, lo=a, hi=b, below=below, targets=inside))
                elif inside and x.within is None:  # one key holds the cut: go on among its ties
                    following.append(Interval(-(1 << 63), (1 << 63) - 1, below, inside, a))
                below += n
        # A cut whose best splitter was found at the end of the next slot needs no further probing.
        open_ = [replace(x, targets=t) for x in following if (t := tuple(c for c in x.targets if best[c][0] > near))]
    return [at for _, at in best]


def _past(splitter: tuple[int, int | None]) -> Column:
    key, tie = splitter
    if tie is None:
        return F.col("_key") >= key
    return (F.col("_key") > key) | ((F.col("_key") == key) & (F.col("_tie") >= tie))


def shard(docs: DataFrame, shards: int, size: Column, key: str = "doc_id", tie: Column | None = None, tolerance: float = 0.002) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1, in key order, of nearly equal total ``size``) and ``slot`` (gapless in the shard).

    Rows of one key are told apart by ``tie``, a hash of the row unless given, so one key may hold any share of the
    bytes; rows equal in both stay in one shard. A null key sorts below all others. Shards may be empty when there are
    fewer rows than shards. Columns named shard and slot are replaced.

    Slots are counted in buckets of a shard, as many as the session has shuffle partitions, so no task gets a whole
    shard: a bucket's first slot is the number of rows in the buckets before it.
    """
    spark = docs.sparkSession
    low = -(1 << 63)
    own = [c for c in docs.columns if c not in ("shard", "slot")]
    tie = F.xxhash64(*own) if tie is None else tie
    keyed = docs.select(*own, F.coalesce(F.col(key).cast("long"), F.lit(low)).alias("_key"), tie.alias("_tie"), size.cast("long").alias("_size"))
    keys = keep(keyed.select(F.col("_key").alias("key"), F.col("_tie").alias("tie"), F.col("_size").alias("size")), "shard-keys")
    parts = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    at = splitters(keys, shards, tolerance)
    place = F.lit(0)
    for s in at:
        place = place + _past(s).cast("int")
    # Buckets need not be even in bytes: equal steps of the key between a shard's ends.
    placed = keyed.withColumn("shard", place)
    where = keys.select(F.col("key").alias("_key"), F.col("tie").alias("_tie")).withColumn("shard", place)
    ends = where.groupBy("shard").agg(F.min("_key").alias("_lo"), F.max("_key").alias("_hi"))  # at most ``shards`` rows
    share = (F.col("_key").cast("double") - F.col("_lo")) / (F.col("_hi").cast("double") - F.col("_lo") + 1)
    ties = (F.col("_tie").cast("double") + 2.0**63) / 2.0**64
    share = F.when(F.col("_lo") == F.col("_hi"), ties).otherwise(share)
    bucket = F.least(F.floor(share * parts), F.lit(parts - 1)).cast("int")
    counts = where.join(F.broadcast(ends), "shard").groupBy("shard", bucket.alias("_bucket")).count()  # shards * parts rows
    upto = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(F.col("shard").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("_first"))
    dealt = placed.join(F.broadcast(ends), "shard").withColumn("_bucket", bucket)
    order = Window.partitionBy("shard", "_bucket").orderBy("_key", "_tie")
    slots = dealt.withColumn("_nth", F.row_number().over(order) - 1)
    out = slots.join(F.broadcast(first), (F.col("shard") == F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    return out.select(*own, "shard", (F.col("_first") + F.col("_nth")).cast("long").alias("slot"))
