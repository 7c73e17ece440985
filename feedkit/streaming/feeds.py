"""The recurring loop "take the oldest file, load it, archive it" as a file stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.ranking import keep_first
from ..sources.files import with_file_name
from .keys import BUCKETS, KeyIndex


def stream_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    archive: str | None = None,
    *,
    sep: str = ",",
    header: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of delimited files, oldest first; ``files_per_batch`` bounds a micro-batch, by default all there are.

    With ``archive`` a file moves there once a later batch has been planned, so the last file moves on the next
    run. The checkpoint of the query remembers which files were loaded.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("header", header)
        .option("sep", sep)
        .option("quote", '"')
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return with_file_name(reader.csv(path))


def load_stream(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append everything available now to a parquet folder, then stop."""
    return (
        stream.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def delta_batch(rows: DataFrame, batch_id: int, target: str, key: str, order: list[Column | str], index: KeyIndex) -> None:
    """Write the rows of one batch whose key no earlier batch brought into ``target``, and enter their keys in the index."""
    spark, out = rows.sparkSession, f"{target}/batch={batch_id}"
    if not index.covers(batch_id):  # the target is older than its index
        held = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("batch", T.LongType())])).parquet(target)
        earlier = held.filter((F.col("batch") < batch_id) & F.col(key).isNotNull()).select(key).distinct()
        index.rebuild(earlier, batch_id - 1)
    first = keep_first(rows.filter(F.col(key).isNotNull()), [key], order)
    new = first.join(index.known(first, batch_id), [key], "left_anti").select(*rows.columns)
    new.unionByName(rows.filter(F.col(key).isNull())).write.mode("overwrite").parquet(out)
    index.add(spark.read.schema(rows.schema).parquet(out).filter(F.col(key).isNotNull()), batch_id)


def stream_delta(
    stream: DataFrame, target: str, key: str, order: list[Column | str], checkpoint: str, index: str | None = None, buckets: int = BUCKETS
) -> StreamingQuery:
    """Append only rows whose key no earlier batch brought; the first row per key within a batch wins.

    Each batch writes its own ``batch=N`` folder and is compared with earlier batches only, so a batch that runs again
    after a failure replaces its own output and gives the same rows. Earlier keys lie in an index beside the target
    (``index``, by default ``<target>__keys``) of which a batch reads the buckets that may hold one of its keys; a target
    without an index gets one. A row with a null key is new, as in ``flag_delta``: all of them are appended.
    """
    target = target.rstrip("/")
    keys = KeyIndex(stream.sparkSession, index or f"{target}__keys", key, buckets)

    def load(rows: DataFrame, batch_id: int) -> None:
        rows = rows.persist()  # read for the look-up and for the write
        try:
            delta_batch(rows, batch_id, target, key, order, keys)
        finally:
            rows.unpersist()

    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
