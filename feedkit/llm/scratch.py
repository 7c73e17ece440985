"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from ..session import scratch_dir


def keep(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: what follows starts from files, not from a lineage."""
    path = f"{scratch_dir(df.sparkSession, label)}/table"
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keep_bucketed(df: DataFrame, key: str, label: str) -> DataFrame:
    """Like ``keep``, as a table bucketed by ``key``: joins by that key shuffle the other side only."""
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.format("parquet").bucketBy(buckets, key).option("compression", "uncompressed")
    writer.option("path", f"{scratch_dir(spark, label)}/table").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and ``table`` keeps reading them
    return table
