"""Table writes: truncate-and-load, append, truncate."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from ..snapshots import latest, publish, read_snapshot
from ..sources.tables import jdbc_options


def _is_path(target: str) -> bool:
    return "/" in target


def _swap(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of another. The old rows go last, so one full copy exists at any moment, for a
    moment under another name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    new, now, old = path(staged), path(target), path(f"{staged}-old")
    fs = now.getFileSystem(spark._jsc.hadoopConfiguration())
    had = fs.exists(now)
    if had and not fs.rename(now, old):
        raise OSError(f"{target} can't be moved aside; the new rows are in {staged}")
    if not fs.rename(new, now):
        if had:
            fs.rename(old, now)
        raise OSError(f"{staged} can't be moved to {target}")
    if had:
        fs.delete(old, True)
    spark.catalog.refreshByPath(target)


def truncate_load(df: DataFrame, target: str) -> None:
    """Replace all rows of a table (catalog name or parquet folder), keeping the table definition.

    The new rows are written in full beside the target before anything of it is touched: ``df`` may read the target,
    and a job that dies leaves the old rows. A versioned snapshot (``feedkit.snapshots``) gets its next version, so that
    readers see one whole version at any moment. A plain folder is exchanged by two renames, between which a reader
    finds none; begin it with ``publish`` where that matters. Of a catalog table the new rows stay in
    ``<name>__new_<id>`` if the last step, the copy into the table, fails.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex
    if _is_path(target) and latest(spark, target):
        publish(df, target)
    elif _is_path(target):
        staged = f"{target.rstrip('/')}__new_{mark}"
        df.write.parquet(staged)
        _swap(spark, staged, target.rstrip("/"))
    elif spark.catalog.tableExists(target):
        names = spark.table(target).columns
        staged = f"{target}__new_{mark}"
        df.select(*[f"`{n}`" for n in names]).write.saveAsTable(staged)
        spark.table(staged).write.insertInto(target, overwrite=True)
        spark.sql(f"DROP TABLE {staged}")
    else:
        df.write.saveAsTable(target)


def append(df: DataFrame, target: str) -> None:
    """Add rows to a table, matching columns by name. A versioned snapshot takes whole replacements only."""
    if _is_path(target):
        if latest(df.sparkSession, target):
            raise ValueError(f"{target} is a versioned snapshot; publish it with the rows added")
        df.write.mode("append").parquet(target)
    else:
        df.write.mode("append").saveAsTable(target)


def truncate(spark: SparkSession, targets: Iterable[str]) -> None:
    """Empty every listed table and keep its columns."""
    for target in targets:
        if _is_path(target) and latest(spark, target):
            publish(spark.createDataFrame([], read_snapshot(spark, target).schema), target)
        elif _is_path(target):
            spark.createDataFrame([], spark.read.parquet(target).schema).write.mode("overwrite").parquet(target)
        elif spark.catalog.getTable(target).tableType == "EXTERNAL":
            # Spark refuses TRUNCATE where it does not own the files.
            spark.createDataFrame([], spark.table(target).schema).write.insertInto(target, overwrite=True)
        else:
            spark.sql(f"TRUNCATE TABLE {target}")


def jdbc_write_options(
    url: str, table: str, properties: Mapping[str, str] | None = None, *, truncate: bool, batch: int = 10_000
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch), **(properties or {})}
    if truncate:
        options["truncate"] = "true"
    return options


def swap_script(table: str, staged: str, columns: Iterable[str]) -> str:
    """One transaction that puts the staged rows in the place of a table's."""
    names = ", ".join(columns)
    return f"BEGIN; DELETE FROM {table}; INSERT INTO {table} ({names}) SELECT {names} FROM {staged}; COMMIT"


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None, *, replace: bool, connections: int = 16, staged: str | None = None
) -> None:
    """Load into a database table: ``replace`` exchanges all rows, otherwise rows are appended.

    ``connections`` caps the partitions, and so the sessions opened against the database at a time. A replace first
    writes all rows into the table ``staged`` (by default ``<table>__new``), which it makes anew, and then exchanges them
    in one transaction. The frame may read the table; a job that dies before the exchange leaves the table as it was, and
    one that is repeated gives the same rows. The staged rows stay for the next replace to overwrite. The exchange is
    sent as the opening statements of a one-row read, which the database must take several of at once.
    """
    writer = df.repartition(connections).write.format("jdbc")
    if not replace:
        writer.mode("append").options(**jdbc_write_options(url, table, properties, truncate=False)).save()
        return
    staged = staged or f"{table}__new"
    writer.mode("overwrite").options(**jdbc_write_options(url, staged, properties, truncate=False)).save()
    exchange = jdbc_options(url, "(SELECT 1 AS done) q", properties, single=True)
    exchange["sessionInitStatement"] = swap_script(table, staged, df.columns)
    df.sparkSession.read.format("jdbc").options(**exchange).load().first()
