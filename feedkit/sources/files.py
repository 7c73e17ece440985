"""Delimited file drops: reading, lineage, listing and picking files."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from .listing import FileListing, can_list


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | str | None = None,
    *,
    sep: str = ",",
    header: bool = True,
    names: Sequence[str] | None = None,
    escape: str | None = None,
    infer: bool = False,
    recursive: bool = False,
    multiline: bool = False,
) -> DataFrame:
    """Read delimited text. Without a schema every column is a string; ``infer=True`` costs one more pass.

    ``names`` names the columns of a header-less file. With a schema and a header the two are checked against
    each other, so a file whose columns moved fails instead of landing in the wrong columns.
    """
    if names is not None:
        schema, header = T.StructType([T.StructField(n, T.StringType()) for n in names]), False
    reader = spark.read.option("sep", sep).option("header", header).option("quote", '"')
    if escape is not None:
        reader = reader.option("escape", escape)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if multiline:
        reader = reader.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", not header)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


def decoded_path(path: Column) -> Column:
    """A path as it is named; Spark reports paths URL-encoded, and a plus sign stands for itself."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def read_file_name() -> Column:
    """Base name of the file a row was read from. Spark reports it URL-encoded; a plus sign stands for itself."""
    return decoded_path(F.col("_metadata.file_name"))


def with_file_name(df: DataFrame, to: str = "filename") -> DataFrame:
    """Add the base name of the file each row was read from."""
    return df.withColumn(to, read_file_name())


def clean_headers(df: DataFrame) -> DataFrame:
    """Strip quotes and outer blanks from column names."""
    return df.toDF(*[c.replace('"', "").strip() for c in df.columns])


def skip_preamble(df: DataFrame, n: int = 7) -> DataFrame:
    """Drop the first ``n`` rows of every file of a freshly read frame.

    Rows are numbered as they are read, so those of a file's first block are consecutive. The smallest and largest
    number per file say which ``n`` rows to drop; only these are shuffled, and no file is gathered in one task, whether
    it can be split or not. The read must keep malformed rows, as it does by default, because rows are numbered in a
    second scan of few columns.
    """
    if n <= 0:
        return df
    tagged = df.select(
        "*",
        F.col("_metadata.file_path").alias("_path"),
        (F.col("_metadata.file_block_start") == 0).alias("_first_block"),
    ).withColumn("_order", F.monotonically_increasing_id())
    ends = tagged.groupBy("_path").agg(
        F.min(F.when(F.col("_first_block"), F.col("_order"))).alias("_low"),
        F.max(F.when(F.col("_first_block"), F.col("_order"))).alias("_high"),
    )
    numbers = F.sequence("_low", F.least(F.col("_low") + (n - 1), F.col("_high")))
    drops = ends.filter("_low IS NOT NULL").select(F.explode(numbers).alias("_order"))
    return tagged.join(drops, "_order", "left_anti").drop("_order", "_path", "_first_block")


def skip_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Drop the ``n`` smallest rows by a unique, non-null ``order`` key.

    The rows to drop are found with a distributed top-n, so the table is never sorted in one task and the
    other side of the anti join has exactly ``n`` rows.
    """
    first = df.select(*order).orderBy(*order).limit(n)
    return df.join(F.broadcast(first), list(order), "left_anti")


def list_files(spark: SparkSession, path: str, suffix: str | None = None, contains: str | None = None) -> DataFrame:
    """One row per file below ``path``: path, name, modified, size. File contents are not read.

    Folders are listed in parallel, files of zero bytes included. Stores that only Spark can open are listed by its own
    file scan, which leaves those out.
    """
    if can_list(path):
        spark.dataSource.register(FileListing)
        files = spark.read.format("file_listing").load(path)
    else:
        scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        files = scan.select(
            decoded_path(F.col("_metadata.file_path")).alias("path"),
            read_file_name().alias("name"),
            F.col("modificationTime").alias("modified"),
            F.col("length").alias("size"),
        )
    if suffix is not None:
        files = files.filter(F.col("name").endswith(suffix))
    if contains is not None:
        files = files.filter(F.col("name").contains(contains))
    return files


def pick_file(
    listing: DataFrame, order: str = "asc", nth: int = 0, suffix: str | None = None, contains: str | None = None
) -> DataFrame:
    """The ``nth`` file by modification time: ``asc`` gives the oldest first, ``desc`` the newest.

    Ties go by name. The result is empty when there are not enough files.
    """
    if suffix is not None:
        listing = listing.filter(F.col("name").endswith(suffix))
    if contains is not None:
        listing = listing.filter(F.col("name").contains(contains))
    when = F.col("modified").asc() if order == "asc" else F.col("modified").desc()
    return listing.orderBy(when, F.col("name").asc()).offset(nth).limit(1)


class Checked(NamedTuple):
    """Lines of a drop by what became of them."""

    rows: DataFrame  #: the columns of the schema and ``filename``
    rejects: DataFrame  #: filename, line (from 1, the header counted), text


def read_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    sep: str = ",",
    header: bool = True,
    escape: str | None = None,
    recursive: bool = False,
) -> Checked:
    """Read delimited text and set aside lines with too few or too many fields, or with a value its type does not take.

    A plain read makes nulls of them. Good rows are those of ``read_delimited``; blank lines are neither. A record is a
    line: quoted line ends are not supported here. Lines are numbered from their file's splits, and only for rejects.
    """
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    options = {"sep": sep, "quote": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    if escape is not None:
        options["escape"] = escape
    wanted = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in schema.fields], T.StructField("_corrupt", T.StringType())])
    reader = spark.read.option("recursiveFileLookup", recursive)
    lines = reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_path"),
        read_file_name().alias("filename"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_at"),
    )
    # One row per split: its first row's number, and the lines of its file before it.
    splits = lines.groupBy("_path", "_block").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    body = lines
    if header:
        heads = splits.filter("_before = 0").select(F.col("_first").alias("_at"))
        body = body.join(heads, "_at", "left_anti")
    text = F.col("value")
    parsed = body.filter(F.trim(text) != "").withColumn("_row", F.from_csv(text, wanted.toDDL(), options))
    good = parsed.filter("_row._corrupt IS NULL").select(*[F.col("_row")[f.name].alias(f.name) for f in schema.fields], "filename")
    bad = parsed.filter("_row._corrupt IS NOT NULL").select("filename", "value", "_path", "_block", "_at")
    numbered = bad.join(splits, ["_path", "_block"])
    return Checked(good, numbered.select("filename", (F.col("_before") + F.col("_at") - F.col("_first") + 1).alias("line"), F.col("value").alias("text")))


def if_empty(df: DataFrame, on_rows: Callable[[DataFrame], DataFrame], on_empty: Callable[[DataFrame], DataFrame]):
    """Run ``on_rows`` or, when the frame has no rows, ``on_empty``. Reads at most one row to decide."""
    return on_empty(df) if df.isEmpty() else on_rows(df)
