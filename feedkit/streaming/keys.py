"""An index of the keys that earlier batches brought, in hash buckets with a Bloom filter each.

A batch asks the filters first and reads only the buckets in which one of its keys may be: a batch of new keys reads
hardly any, whatever came before it. The filters are bitmaps of 32,768 bits with three bits a key, built and tested by
Spark's own functions; with ``buckets`` times 3,000 keys about one new key in a hundred opens a bucket for nothing, with
more keys more do, and results stay right. All filters together are ``buckets`` times 4 KB and are carried from batch to
batch.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BITS = 32_768  # of the bitmaps that bitmap_construct_agg makes
BUCKETS = 64  # a batch writes a file for each of its buckets


def _bit(bitmap: str, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.expr("1").bitwiseAND(F.call_function("shiftright", byte, F.pmod(position, F.lit(8)).cast("int"))) == 1


class KeyIndex:
    """Keys of a stream's target by batch, below ``root``: ``keys/bucket=b/batch=n`` and ``filters/batch=n``."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = BUCKETS):
        self.spark, self.root, self.key, self.buckets = spark, root.rstrip("/"), key, buckets
        #: Buckets that the last ``known`` opened.
        self.opened: list[int] = []

    def _marked(self, keys: DataFrame) -> DataFrame:
        bits = F.xxhash64(self.key, F.lit(1))
        places = [F.pmod(F.call_function("shiftright", bits, F.lit(15 * i)), F.lit(BITS)) for i in range(3)]
        return keys.select(self.key, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int").alias("bucket"), F.array(*places).alias("places"))

    def _filters(self, batch: int) -> DataFrame | None:
        """The filters over all batches before this one, or None if they were not kept."""
        none = self.spark.createDataFrame([], "bucket int, bits binary")
        if batch == 0:
            return none
        try:
            return self.spark.read.schema(none.schema).parquet(f"{self.root}/filters/batch={batch - 1}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def covers(self, batch: int) -> bool:
        """Whether the index holds all batches before this one."""
        return self._filters(batch) is not None

    def known(self, keys: DataFrame, batch: int) -> DataFrame:
        """Which of the keys (not null) an earlier batch brought."""
        held = self._marked(keys).join(self._filters(batch), "bucket")
        maybe = held.filter(_bit("bits", F.col("places")[0]) & _bit("bits", F.col("places")[1]) & _bit("bits", F.col("places")[2]))
        maybe = maybe.select(self.key, "bucket")
        self.opened = sorted(maybe.agg(F.collect_set("bucket")).first()[0])  # at most ``buckets``
        if not self.opened:
            return keys.select(self.key).limit(0)
        folders = [f"{self.root}/keys/bucket={b}" for b in self.opened]
        earlier = self.spark.read.option("basePath", f"{self.root}/keys").parquet(*folders).filter(F.col("batch") < batch)
        return maybe.join(earlier.select(self.key, "bucket"), [self.key, "bucket"], "left_semi").select(self.key)

    def add(self, keys: DataFrame, batch: int) -> None:
        """Enter the keys (distinct, not null) that a batch brought. A batch that runs again replaces its own entries."""
        marked = self._marked(keys)
        entries = marked.select(self.key, "bucket", F.lit(batch).alias("batch")).repartition("bucket")
        writer = entries.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("bucket", "batch").parquet(f"{self.root}/keys")
        self._carry(marked, batch, self._filters(batch))
        if batch > 1:  # a batch that runs again needs those of the one before it
            none = self.spark.createDataFrame([], "bucket int, bits binary").coalesce(1)
            none.write.mode("overwrite").parquet(f"{self.root}/filters/batch={batch - 2}")

    def rebuild(self, keys: DataFrame, batch: int) -> None:
        """Enter all keys (distinct, not null) of the batches up to this one as if it had brought them."""
        marked = self._marked(keys)
        entries = marked.select(self.key, "bucket", F.lit(batch).alias("batch")).repartition("bucket")
        entries.write.mode("overwrite").partitionBy("bucket", "batch").parquet(f"{self.root}/keys")
        self._carry(marked, batch, None)

    def _carry(self, marked: DataFrame, batch: int, before: DataFrame | None) -> None:
        own = marked.select("bucket", F.explode("places").alias("p")).groupBy("bucket").agg(F.bitmap_construct_agg("p").alias("bits"))
        if before is not None:
            own = own.unionByName(before).groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        own.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/filters/batch={batch}")
