"""Versioned snapshots: a table that is replaced whole, with one full version readable at every moment.

Below its root a snapshot has one folder per version and a log, ``versions``, with one small entry per published version.
A replace writes the new folder in full and then appends its entry to the log; readers take the folder of the newest
entry. A job that dies leaves a folder that no entry names, and nothing is moved or renamed by this module: the entry
appears whole or not at all wherever a finished file does, also on stores where renaming is a copy. A frame that was
read before a replace goes on reading its own version.

One writer at a time: of two that publish the same number one stays the reader's choice and the other gets an error.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

LOG = "versions"
LOG_SCHEMA = "version long, folder string, n_rows long, dropped boolean"


class Version(NamedTuple):
    version: int
    folder: str
    n_rows: int
    dropped: bool


class Conflict(RuntimeError):
    """Another writer published first."""


def versions(spark: SparkSession, root: str) -> DataFrame:
    """The published versions: version, folder, n_rows, dropped. Empty where nothing was published yet."""
    try:
        log = spark.read.schema(LOG_SCHEMA).option("recursiveFileLookup", True).json(f"{root.rstrip('/')}/{LOG}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        log = spark.createDataFrame([], LOG_SCHEMA)
    # Of entries with one number the smallest folder counts, for every reader alike.
    chosen = log.groupBy("version").agg(F.min("folder").alias("folder"))
    return (
        log.groupBy("version", "folder")
        .agg(F.max("n_rows").alias("n_rows"), F.max(F.coalesce("dropped", F.lit(False))).alias("dropped"))
        .join(chosen, ["version", "folder"])
    )


def latest(spark: SparkSession, root: str) -> Version | None:
    """The version that readers get now, or None."""
    row = versions(spark, root).orderBy(F.desc("version")).first()
    return Version(*row) if row else None


def _announce(spark: SparkSession, root: str, entry: Version) -> None:
    # A folder of its own: what a job that died while writing its entry left there can't come out with a later one.
    spark.createDataFrame([entry], LOG_SCHEMA).coalesce(1).write.json(f"{root}/{LOG}/{entry.version:010d}-{uuid.uuid4().hex}")


def publish(df: DataFrame, root: str, base: int | None = None) -> int:
    """Replace the snapshot by ``df``, which may read it, and return the new version.

    With ``base``, the version that ``df`` was made from (0 for none), a snapshot that has moved on is not replaced.
    """
    spark, root = df.sparkSession, root.rstrip("/")
    held = latest(spark, root)
    now = held.version if held else 0
    if base is not None and base != now:
        raise Conflict(f"{root} is at version {now}, not at {base}")
    folder = f"data-{now + 1:010d}-{uuid.uuid4().hex}"
    counted = Observation()
    df.observe(counted, F.count(F.lit(1)).alias("n_rows")).write.parquet(f"{root}/{folder}")
    _announce(spark, root, Version(now + 1, folder, counted.get["n_rows"], False))
    seen = latest(spark, root)
    if seen.version == now + 1 and seen.folder != folder:
        raise Conflict(f"version {now + 1} of {root} was published by another writer")
    return now + 1


def read_snapshot(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """One whole version, by default the newest."""
    root = root.rstrip("/")
    found = versions(spark, root)
    found = found.orderBy(F.desc("version")) if version is None else found.filter(F.col("version") == version)
    row = found.first()
    if row is None or row["dropped"]:
        raise LookupError(f"{root} has no version {'' if version is None else version}".rstrip())
    return spark.read.parquet(f"{root}/{row['folder']}")


def drop_old(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Give back the space of all but the ``keep`` newest versions and return their numbers.

    They are marked in the log before their rows go, so that nobody takes an emptied folder for a version. Frames that
    still read a dropped version fail: keep as many as replaces can happen during the longest read.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    root = root.rstrip("/")
    gone = list(versions(spark, root).orderBy(F.desc("version")).offset(keep).filter("NOT dropped").toLocalIterator())
    for row in gone:
        path = f"{root}/{row['folder']}"
        schema = spark.read.parquet(path).schema
        _announce(spark, root, Version(row["version"], row["folder"], row["n_rows"], True))
        spark.createDataFrame([], schema).coalesce(1).write.mode("overwrite").parquet(path)
    return sorted(row["version"] for row in gone)
