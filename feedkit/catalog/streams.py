"""File feeds as streams: drops made from orders, loaded until nothing is left."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.files import read_delimited
from ..streaming.feeds import load_stream, stream_delta, stream_feed
from .registry import Tables, query

SCHEMA = "o_orderkey STRING, o_custkey STRING, o_orderpriority STRING"
TEXT = "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority FROM orders"


def _drops(t: Tables, files: int) -> str:
    path = scratch_dir(t.spark, "drops")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    rows.repartition(files, "o_orderkey").write.option("header", True).csv(path)
    return path


@query("stream_file_feed", TEXT)
def stream_file_feed(t: Tables):
    target, state = scratch_dir(t.spark, "feed"), scratch_dir(t.spark, "feed-state")
    stream = stream_feed(t.spark, _drops(t, 4), SCHEMA).drop("filename")
    load_stream(stream, target, state).awaitTermination()
    return t.spark.read.schema(SCHEMA).parquet(target)


@query(
    "archive_file",
    f"SELECT 'loaded' AS part, * FROM ({TEXT}) UNION ALL SELECT 'archived', * FROM ({TEXT} WHERE o_orderkey < (SELECT max(o_orderkey) FROM orders))",
)
def archive_file(t: Tables):
    # The newest file holds the last order; it waits for a later batch, all older files must have moved.
    drops, archive = scratch_dir(t.spark, "drops"), scratch_dir(t.spark, "archive")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    last = rows.orderBy(F.desc("o_orderkey")).limit(1)
    older = rows.join(last.select("o_orderkey"), "o_orderkey", "left_anti").repartition(3)
    for drop in (older, last):
        drop.write.mode("append").option("header", True).csv(drops)
    target, state = scratch_dir(t.spark, "archived"), scratch_dir(t.spark, "archived-state")
    for _ in range(2):  # over one checkpoint: the second run finds all files loaded
        stream = stream_feed(t.spark, drops, SCHEMA, archive, files_per_batch=1).drop("filename")
        load_stream(stream, target, state).awaitTermination()
    loaded = t.spark.read.schema(SCHEMA).parquet(target)
    moved = read_delimited(t.spark, archive, SCHEMA, recursive=True)
    return loaded.select(F.lit("loaded").alias("part"), "*").union(moved.select(F.lit("archived"), "*"))


@query(
    "stream_delta_upsert",
    "SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS o_custkey FROM orders WHERE o_custkey % 11 <> 0 "
    "UNION ALL SELECT CAST(NULL AS VARCHAR) FROM orders WHERE o_custkey % 11 = 0",
)
def stream_delta_upsert(t: Tables):
    # A customer's first order in any drop adds the customer; which order that is depends on file order.
    target, state = scratch_dir(t.spark, "delta"), scratch_dir(t.spark, "delta-state")
    # An order without a customer is always new.
    stream = stream_feed(t.spark, _drops(t, 4), SCHEMA, files_per_batch=2).drop("filename")
    known = F.when(F.col("o_custkey").cast("bigint") % 11 != 0, F.col("o_custkey"))
    stream = stream.withColumn("o_custkey", known)
    stream_delta(stream, target, "o_custkey", [F.col("o_orderkey").cast("bigint")], state).awaitTermination()
    return t.spark.read.parquet(target).select("o_custkey")
