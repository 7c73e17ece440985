"""Run a registered query and its SQL twin and compare names, kinds of types and values.

    python -m tests.compare [sf0.01] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

import duckdb

DATA = os.environ.get("FEEDKIT_TESTDATA", "/root/testdata")
VIEWS = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(path: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in VIEWS:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    return con


def _kind(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    return type(v).__name__


def _plain(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, decimal.Decimal):
        return v.normalize()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((v is not None, str(v)) for v in r))


# Spark type -> engine types with the same rendering.
SAME_TYPES = {
    "bigint": {"BIGINT"},
    "int": {"INTEGER"},
    "string": {"VARCHAR"},
    "double": {"DOUBLE"},
    "boolean": {"BOOLEAN"},
    "date": {"DATE"},
    "timestamp": {"TIMESTAMP", "TIMESTAMP WITH TIME ZONE"},
    "timestamp_ntz": {"TIMESTAMP"},
}


def compare(spark, con, path: str, name: str, fn, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, path)
    mine = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    theirs = cur.fetchall()
    a_names, a = _rows(df.columns, mine)
    b_names, b = _rows([d[0] for d in cur.description], theirs)
    if a_names != b_names:
        return f"columns {a_names} != {b_names}"
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        want = {kind.upper().replace(",", ",")} if kind.startswith("decimal") else SAME_TYPES.get(kind, set())
        if types[f.name] not in want:
            return f"type of {f.name}: {kind} / {types[f.name]}"
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    for x, y in zip(a, b):
        if x != y or [_kind(v) for v in x] != [_kind(v) for v in y]:
            diff = [(n, p, q) for n, p, q in zip(a_names, x, y) if p != q or _kind(p) != _kind(q)]
            return f"values {diff[:4]}"
    return None


def main(argv: list[str]) -> int:
    from feedkit.catalog import oracle_sql, queries
    from feedkit.session import local_session

    scale = argv.pop(0) if argv and argv[0].startswith("sf") else "sf0.001"
    path = f"{DATA}/{scale}"
    spark, con = local_session("8"), connect(path)
    fns, sqls = queries(), oracle_sql()
    bad = 0
    for name in argv or fns:
        t0 = time.time()
        try:
            if name in sqls:
                problem = compare(spark, con, path, name, fns[name], sqls[name])
                n = con.execute(f"SELECT count(*) FROM ({sqls[name]})").fetchall()[0][0]
            else:
                problem, n = None, f"{fns[name](spark, path).count()} (no sql)"
        except Exception as e:  # report and go on with the next query
            problem, n = f"{type(e).__name__}: {str(e)[:600]}", "-"
        bad += problem is not None
        print(f"{'BAD ' if problem else 'ok  '} {name:32} rows={n} {time.time() - t0:.1f}s {problem or ''}", flush=True)
    print(f"{bad} bad of {len(argv or fns)}")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
