"""Tables: catalog, parquet folder or JDBC."""

from __future__ import annotations

import decimal
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..snapshots import latest, read_snapshot


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Read a catalog table, or a parquet path when ``name`` has a slash; ``columns`` are SQL expressions.

    Of a versioned snapshot the newest version is read.
    """
    if "/" not in name:
        df = spark.table(name)
    else:
        df = read_snapshot(spark, name) if latest(spark, name) else spark.read.parquet(name)
    return df.selectExpr(*columns) if columns else df


@contextmanager
def _footers_answer(spark: SparkSession) -> Iterator[None]:
    """While this lasts, counts over Parquet come from the files' footers where those have them."""
    listed = [s for s in spark.conf.get("spark.sql.sources.useV1SourceList").split(",") if s != "parquet"]
    wanted = {"spark.sql.sources.useV1SourceList": ",".join(listed), "spark.sql.parquet.aggregatePushdown": "true"}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def filled_columns(spark: SparkSession, path: str) -> list[str]:
    """Columns of a Parquet folder that hold a value, in order.

    Plain columns are decided by the null counts in the footers; no data page is read. Only nested columns, whose nulls
    footers do not count, are looked at.
    """
    plain, nested = [], []
    schema = spark.read.parquet(path).schema
    for field in schema.fields:
        (nested if field.dataType.typeName() in ("array", "map", "struct", "variant") else plain).append(field.name)
    filled = set()
    if plain:
        with _footers_answer(spark):
            counts = counted_values(spark, path, plain).first()
        filled |= {c for c, n in zip(plain, counts) if n}
    if nested:
        found = spark.read.parquet(path).agg(*[F.max(F.col(f"`{c}`").isNotNull()) for c in nested]).first()
        filled |= {c for c, some in zip(nested, found) if some}
    return [f.name for f in schema.fields if f.name in filled]


def counted_values(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """One row with the number of values of every column."""
    return spark.read.parquet(path).agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(columns)])


def read_filled(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder without the columns that hold no value."""
    return spark.read.parquet(path).select(*[f"`{c}`" for c in filled_columns(spark, path)])


def jdbc_options(
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    *,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 16,
    fetch_size: int = 10_000,
    single: bool = False,
) -> dict[str, str]:
    """Options of a JDBC read in parallel ranges of ``split_on`` between ``bounds``; the first and last range are open.

    One task reads a whole table only where the caller says so with ``single=True``.
    """
    if (split_on is None) != single:
        raise ValueError("give either split_on with bounds, or single=True")
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **(properties or {})}
    if split_on is not None:
        if bounds is None:
            raise ValueError("split_on needs bounds")
        options |= {
            "partitionColumn": split_on,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, properties=None, **kwargs) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, properties, **kwargs)).load()


def split_query(table: str, column: str, parts: int) -> str:
    """A query for where ``parts`` parts of about equal rows begin in ``column``, whatever its gaps and repeats."""
    return f"SELECT MIN({column}) AS lo FROM (SELECT {column}, NTILE({parts}) OVER (ORDER BY {column}) AS part FROM {table} WHERE {column} IS NOT NULL) s GROUP BY part"


def _literal(value) -> str:
    if isinstance(value, bool) or value is None:
        raise TypeError("split by a number, a text or a date")
    return str(value) if isinstance(value, (int, float, decimal.Decimal)) else "'" + str(value).replace("'", "''") + "'"


def split_predicates(column: str, begins: Sequence) -> list[str]:
    """Conditions that put every row of a table into exactly one part, nulls into the first. A repeated begin is one part."""
    begins = sorted(set(begins))
    if len(begins) < 2:
        return ["1 = 1"]
    cuts = [_literal(b) for b in begins[1:]]
    middle = [f"{column} >= {lo} AND {column} < {hi}" for lo, hi in zip(cuts, cuts[1:])]
    return [f"({column} < {cuts[0]} OR {column} IS NULL)", *middle, f"{column} >= {cuts[-1]}"]


def read_jdbc_even(spark: SparkSession, url: str, table: str, split_on: str, properties: Mapping[str, str] | None = None, *, partitions: int = 16) -> DataFrame:
    """Read a table in parts of about equal rows: the database says where they begin, and every part is a task's query."""
    asked = jdbc_options(url, f"({split_query(table, split_on, partitions)}) q", properties, single=True)
    begins = [r[0] for r in spark.read.format("jdbc").options(**asked).load().toLocalIterator()]  # one value a part
    every = {"fetchsize": "10000", **(properties or {})}
    return spark.read.jdbc(url, table, predicates=split_predicates(split_on, begins), properties=every)
