"""Delimited exports and the log of files handed out."""

from __future__ import annotations

import os
import shutil
import uuid
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..sources.files import decoded_path, list_files
from ..sources.listing import local_path

BOM = "\ufeff"


def export_delimited(
    df: DataFrame,
    path: str,
    *,
    sep: str = ",",
    header: bool = True,
    quote_all: bool = False,
    encoding: str = "UTF-8",
    bom: bool = False,
    single: bool = False,
    keep_blanks: bool = False,
) -> None:
    """Write delimited text into folder ``path``. Blanks around a value are not written, but with ``keep_blanks``.

    Output is partitioned; ``single=True`` gathers it into one file for receivers that need exactly one, and so
    is meant for small extracts only (the plan above the gathering shuffle stays parallel). ``bom`` puts a byte-order mark in front of the first heading.
    """
    if bom:
        if not header:
            raise ValueError("a byte-order mark needs a header line")
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    if single:
        df = df.repartition(1)
    writer = df.write.mode("overwrite").option("sep", sep).option("header", header).option("quoteAll", quote_all)
    if keep_blanks:
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("escape", '"').option("encoding", encoding).csv(path)


class Counted(NamedTuple):
    """A frame to write, and what was counted on the way once it is written."""

    df: DataFrame
    found: Observation

    @property
    def n_rows(self) -> int:
        return self.found.get["n_rows"]

    @property
    def checksum(self) -> int:
        """Over all values, whatever the order of the rows; 0 without rows."""
        return self.found.get["checksum"] or 0


def counted(df: DataFrame) -> Counted:
    """Count rows and add up a checksum while ``df`` is written, so that a log needs no second read.

    Spark takes each partition's counts once, from the attempt that finished it.
    """
    found = Observation()
    each = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).cast("decimal(38,0)")
    return Counted(df.observe(found, F.count(F.lit(1)).alias("n_rows"), F.sum(each).alias("checksum")), found)


def export_log(
    spark: SparkSession, exports: Mapping[str, Counted], path: str, category: str, as_of: Column, *, suffix: str | None = None
) -> DataFrame:
    """The log of files that were just written, by name: as ``file_log``, with the rows and checksums counted then."""
    seen = spark.createDataFrame([(n, c.n_rows, str(c.checksum)) for n, c in exports.items()], "name string, numberofrows long, checksum string")
    files = list_files(spark, path, suffix=suffix).join(seen, "name")
    return files.select("name", "modified", "numberofrows", "size", F.lit(category).alias("category"), as_of.alias("processed_date"), "checksum")


def name_parts(spark: SparkSession, path: str, name: str) -> None:
    """Give the written files of a folder the ``name`` their receiver expects.

    Several files get ``_1``, ``_2`` ... before the suffix, in the order of their rows.
    """
    make = spark._jvm.org.apache.hadoop.fs.Path
    root = make(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in fs.listStatus(root)]
    parts = sorted(n for n in names if n.startswith("part-"))
    stem, dot, suffix = name.rpartition(".")
    for i, part in enumerate(parts, 1):
        to = name if len(parts) == 1 else f"{stem}_{i}{dot}{suffix}"
        if not fs.rename(make(root, part), make(root, to)):
            raise OSError(f"{part} of {path} can't be named {to}")
    spark.catalog.refreshByPath(path)


def export_ordered_file(
    df: DataFrame,
    path: str,
    name: str,
    order: Sequence[str | Column],
    *,
    columns: Sequence[str] | None = None,
    parts: int | None = None,
    **options,
) -> Counted:
    """Write ``df`` as the one delimited file ``path``/``name``, its rows in ``order``, without gathering them in a task.

    Rows are exchanged by ranges of ``order`` and written as headless parts, which are then joined in the store: on a
    shared file system every part is copied to its place in the file by a task of its own, on HDFS the file system's
    ``concat`` does it. Other stores raise NotImplementedError before a row is written; there, write several files and
    name them (``name_parts``). ``columns`` are those written, by default all. The options are those of
    ``export_delimited``. The file appears under its name when it is complete. What was written is counted on the way.
    """
    spark = df.sparkSession
    scheme = urlsplit(path).scheme
    if scheme not in ("", "file", "hdfs"):
        raise NotImplementedError(f"{scheme} can't join parts of a file")
    if "single" in options:
        raise TypeError("the rows are not gathered")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    ranged = ranged.select(*[f"`{c}`" for c in columns]) if columns else ranged
    written = counted(ranged)  # after the exchange, which looks at the rows once more to find its ranges
    work = f"{path.rstrip('/')}/_parts-{uuid.uuid4().hex}"
    header = options.pop("header", True)
    export_delimited(written.df, f"{work}/rows", **{**options, "header": False, "bom": False})
    if header:  # a frame without rows writes its headings
        export_delimited(spark.createDataFrame([], ranged.schema).coalesce(1), f"{work}/head", **options)
    folders = [f"{work}/head", f"{work}/rows"] if header else [f"{work}/rows"]
    pieces = []  # in the order of the file; Spark numbers parts by their ranges
    for folder in folders:
        found = list_files(spark, folder).filter(F.col("name").startswith("part-")).select("path", "name", "size")
        pieces += [(r["path"], r["size"]) for r in sorted(found.toLocalIterator(), key=lambda r: r["name"])]
    if scheme == "hdfs":
        _concat(spark, [p for p, _ in pieces], f"{path.rstrip('/')}/{name}")
    else:
        _place(spark, pieces, f"{local_path(path).rstrip('/')}/{name}")
    for folder in folders:  # give their space back
        spark.createDataFrame([], "done string").coalesce(1).write.mode("overwrite").text(folder)
    spark.catalog.refreshByPath(path)
    return written


def _place(spark: SparkSession, pieces: list[tuple[str, int]], target: str) -> None:
    """Copy every piece to its place in ``target``, all at once; a task that runs again writes the same bytes there."""
    work = f"{target}.{uuid.uuid4().hex}"
    starts, total = [], 0
    for _, size in pieces:
        starts.append(total)
        total += size
    with open(work, "wb") as file:
        file.truncate(total)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                with open(local_path(piece["path"]), "rb") as source, open(work, "r+b") as file:
                    file.seek(piece["start"])
                    shutil.copyfileobj(source, file, 8 << 20)
        yield pa.RecordBatch.from_pydict({"done": pa.array([1], pa.int64())})

    plan = spark.createDataFrame([(p, s) for (p, n), s in zip(pieces, starts) if n], "path string, start long")
    plan.repartition(max(1, min(len(pieces), 1024)), "path").mapInArrow(copy, "done long").write.format("noop").mode("overwrite").save()
    os.replace(work, target)


def _concat(spark: SparkSession, pieces: list[str], target: str) -> None:
    """Join the pieces by the file system's own operation, which moves blocks and copies nothing."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    first, to = make(pieces[0]), make(target)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    rest = spark.sparkContext._gateway.new_array(make, len(pieces) - 1)
    for i, piece in enumerate(pieces[1:]):
        rest[i] = make(piece)
    if len(rest):
        fs.concat(first, rest)
    if not fs.rename(first, to):
        raise OSError(f"the joined file can't be named {target}")


def line_counts(spark: SparkSession, path: str) -> DataFrame:
    """Lines per file: path, n_lines. Files are split across tasks and counted before the shuffle."""
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    return lines.select(decoded_path(F.col("_metadata.file_path")).alias("path")).groupBy("path").agg(F.count("*").alias("n_lines"))


def file_log(
    spark: SparkSession, path: str, category: str, as_of: Column, *, suffix: str | None = None, has_header: bool = True
) -> DataFrame:
    """One row per outbound file: name, modified, numberofrows, size, category, processed_date."""
    files = list_files(spark, path, suffix=suffix)
    counted = files.join(line_counts(spark, path), "path", "left")
    rows = F.coalesce(F.col("n_lines"), F.lit(0)) - F.lit(1 if has_header else 0)
    return counted.select(
        "name",
        "modified",
        F.greatest(rows, F.lit(0)).alias("numberofrows"),
        "size",
        F.lit(category).alias("category"),
        as_of.alias("processed_date"),
    )


def with_export_name(df: DataFrame, name: str | Column, to: str = "filename") -> DataFrame:
    """Add the name of the file the rows were sent in, ready to append to the log of sent rows."""
    return df.withColumn(to, name if isinstance(name, Column) else F.lit(name))
