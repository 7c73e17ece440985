"""Query registry."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..session import tune

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels")

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLE: dict[str, str] = {}


class Tables:
    """The test tables of one folder, and feed-like inputs derived from them (``inputs.INPUTS``)."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    def input(self, name: str) -> DataFrame:
        from .inputs import INPUTS

        table, exprs = INPUTS[name]
        return getattr(self, table).selectExpr(*exprs)


def sql_input(name: str) -> str:
    """The same derived input as a SQL subquery."""
    from .inputs import INPUTS

    table, exprs = INPUTS[name]
    return f"(SELECT {', '.join(exprs)} FROM {table})"


def with_inputs(names: Sequence[str], body: str) -> str:
    """SQL with each named input as a CTE."""
    ctes = ", ".join(f"{n} AS {sql_input(n)}" for n in names)
    return f"WITH {ctes}{body}" if body.startswith(",") else f"WITH {ctes} {body}"


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under an operator id, with its SQL twin."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in _QUERIES:
            raise ValueError(f"{name} is registered twice")
        _QUERIES[name] = lambda spark, path: fn(Tables(tune(spark), path))
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return register


def expressions(
    name: str,
    table: str,
    keep: Sequence[str],
    inputs: Sequence[str],
    outputs: Callable[[], Mapping[str, Column]],
    sql: Mapping[str, str],
) -> None:
    """Register column expressions over a whole table.

    ``inputs`` are derived in plain SQL that both engines read alike; ``outputs`` are ours, ``sql`` theirs.
    """
    given = [*keep, *inputs]

    @query(
        name,
        f"WITH src AS (SELECT {', '.join(given)} FROM {table}) "
        f"SELECT {', '.join([*keep, *[f'{e} AS {n}' for n, e in sql.items()]])} FROM src",
    )
    def run(t: Tables) -> DataFrame:
        src = getattr(t, table).selectExpr(*given)
        return src.select(*keep, *[c.alias(n) for n, c in outputs().items()])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLE)
