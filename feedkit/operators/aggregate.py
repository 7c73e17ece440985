"""Grouping operators."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import field


def concat_distinct(df: DataFrame, by: Sequence[str], col: str, to: str, sep: str = ",") -> DataFrame:
    """Distinct values per group in one text, sorted.

    Values are made distinct across the cluster first, so repeated values of a hot group never travel together.
    """
    values = df.select(*by, F.col(col).alias("_value")).filter("_value IS NOT NULL").distinct()
    return values.groupBy(*by).agg(F.array_join(F.sort_array(F.collect_list("_value")), sep).alias(to))


def latest_batch(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest batch. The maximum is a scalar subquery, which also reaches the scan as a filter."""
    newest = df.agg(F.max(date_col)).scalar()
    return df.filter(F.col(date_col) == newest)


def control_totals(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per named frame: name, n_rows."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows") for name, df in frames.items()]
    return reduce(DataFrame.union, parts)


def pivot_cells(
    df: DataFrame, by: Sequence[str], title: str, value: str, titles: Sequence[str], order: Sequence[str] = ()
) -> DataFrame:
    """Key-value cells to a wide table: first value per (row, title).

    ``titles`` fixes the output columns, so no extra job has to find them. ``order`` decides which value is
    first when a title repeats within a row.
    """
    if order:
        pick: Column = F.min_by(F.col(value), F.struct(*order))
    else:
        pick = F.first(F.col(value), ignorenulls=True)
    return df.groupBy(*by).pivot(title, list(titles)).agg(pick)


def flatten_sheet(df: DataFrame, titles: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Nested sheets to a wide table with one row per sheet row.

    Input columns: ``columns`` array<struct<virtualId, title>> and ``rows`` array<struct<rowNumber, cells
    array<struct<value, virtualColumnId>>>>. A sheet carries its own column ids, so titles are found inside the
    record and nothing is shuffled.
    """
    # The ids behind a title are the sheet's, so they are found before its rows are spread out.
    ids = {
        f"_ids{i}": F.transform(F.filter("columns", lambda c: c["title"] == F.lit(t)), lambda c: c["virtualId"])
        for i, t in enumerate(titles)
    }
    rows = df.select(*keep, *[c.alias(n) for n, c in ids.items()], F.explode("rows").alias("_row"))

    def cell(of: str) -> Column:
        return F.get(F.filter("_row.cells", lambda x: F.array_contains(F.col(of), x["virtualColumnId"])), F.lit(0))["value"]

    cells = [cell(of).alias(t) for of, t in zip(ids, titles)]
    return rows.select(*keep, F.col("_row.rowNumber").alias("rowNumber"), *cells)


def explode_cells(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Nested sheets to long form: one row per cell with its row number and title."""
    rows = df.select(*keep, "columns", F.explode("rows").alias("_row"))
    cells = rows.select(*keep, "columns", F.col("_row.rowNumber").alias("rowNumber"), F.explode("_row.cells").alias("_cell"))
    owner = F.get(F.filter("columns", lambda c: c["virtualId"] == F.col("_cell.virtualColumnId")), F.lit(0))
    named = cells.withColumn("title", owner["title"]).filter("title IS NOT NULL")
    return named.select(*keep, "rowNumber", "title", F.col("_cell.value").alias("value"))


def distinct_on(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*[field(c) for c in cols]).distinct()
