"""Mapping and cleaning operators."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from ..operators import mapping as m, relate
from ..operators.routing import length_errors, route
from .inputs import ORDER_DAY
from ..session import scratch_dir
from ..sources.tables import read_filled
from .registry import Tables, query

# Orders as a raw feed brings them: text only, some values unfit for their type.
RAW = [
    "o_orderkey",
    "CASE WHEN o_orderkey % 11 = 0 THEN 'x' || o_orderkey ELSE CAST(o_custkey AS STRING) END AS custkey",
    "CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN o_custkey || '.5' ELSE CAST(o_custkey AS STRING) END AS hours",
    f"CASE WHEN o_orderkey % 5 = 0 THEN 'never' ELSE CAST({ORDER_DAY} AS STRING) END AS day",
    "' ' || o_orderpriority || ' ' AS priority",
    "CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE o_orderstatus END AS status",
]
RAW_SQL = f"(SELECT {', '.join(RAW)} FROM orders)"


def raw(t: Tables):
    return t.orders.selectExpr(*RAW)


MAPPING = [
    ("o_orderkey", "bigint", "orderkey", "string"),
    ("custkey", "string", "personid", "long"),
    ("hours", "string", "hours", "numeric(9,2)"),
    ("DAY", "string", "day", "date"),
    ("status", "string", "status", "string"),
    ("status", "string", "status_again", "string"),
    ("absent", "string", "absent", "string"),
]


@query(
    "apply_mapping",
    f"SELECT CAST(o_orderkey AS VARCHAR) AS orderkey, try_cast(custkey AS BIGINT) AS personid, "
    f"try_cast(hours AS DECIMAL(9,2)) AS hours, try_cast(day AS DATE) AS day, status, status AS status_again FROM {RAW_SQL}",
)
def apply_mapping(t: Tables):
    return m.apply_mapping(raw(t), MAPPING)


@query("select_fields", f"SELECT o_orderkey, status FROM {RAW_SQL}")
def select_fields(t: Tables):
    return m.select_existing(raw(t), ["o_orderkey", "relationshipid", "status", "modified"])


@query(
    "resolve_to_schema",
    f"SELECT try_cast(custkey AS INTEGER) AS custkey, try_cast(day AS DATE) AS day, CAST(NULL AS VARCHAR) AS note, "
    f"o_orderkey FROM {RAW_SQL}",
)
def resolve_to_schema(t: Tables):
    schema = T.StructType.fromDDL("custkey INT, day DATE, note STRING, o_orderkey BIGINT")
    return m.conform(raw(t), schema)


@query(
    "resolve_make_cols",
    f"SELECT o_orderkey, CASE WHEN contains(hours, '.') THEN NULL ELSE try_cast(hours AS BIGINT) END AS hours_bigint, "
    f"CASE WHEN contains(hours, '.') THEN try_cast(hours AS DOUBLE) END AS hours_double, "
    f"CASE WHEN try_cast(hours AS DOUBLE) IS NULL THEN hours END AS hours_string FROM {RAW_SQL}",
)
def resolve_make_cols(t: Tables):
    return m.split_by_type(raw(t).select("o_orderkey", "hours"), "hours", ["bigint", "double", "string"])


@query("drop_null_fields", f"SELECT o_orderkey, status FROM {RAW_SQL}")
def drop_null_fields(t: Tables):
    wide = raw(t).select("o_orderkey", "status")
    wide = m.with_null(m.with_null(wide, "county", "string"), "modified", "timestamp")
    path = scratch_dir(t.spark, "wide")
    wide.write.parquet(path)
    return read_filled(t.spark, path)


@query(
    "blank_to_null",
    f"SELECT o_orderkey, custkey, nullif(hours, '') AS hours, day, priority, nullif(status, '') AS status FROM {RAW_SQL}",
)
def blank_to_null(t: Tables):
    return m.blank_to_null(raw(t))


@query(
    "trim_all",
    f"SELECT o_orderkey, trim(custkey) AS custkey, trim(hours) AS hours, trim(day) AS day, trim(priority) AS priority, "
    f"trim(status) AS status FROM {RAW_SQL}",
)
def trim_all(t: Tables):
    return m.trim_all(raw(t))


@query("rename_columns", 'SELECT c_custkey AS "Student ID", c_name AS "Last Name" FROM customer')
def rename_columns(t: Tables):
    return m.rename(t.customer.select("c_custkey", "c_name"), {"c_custkey": "Student ID", "c_name": "Last Name"})


@query("add_literals", "SELECT c_custkey, 'SHCA' AS categorycode, 'USA' AS country, true AS loaded FROM customer")
def add_literals(t: Tables):
    return m.with_literals(t.customer.select("c_custkey"), {"categorycode": "SHCA", "country": "USA", "loaded": True})


@query("add_null_literal", "SELECT c_custkey, CAST(NULL AS VARCHAR) AS county, CAST(NULL AS BIGINT) AS ref FROM customer")
def add_null_literal(t: Tables):
    return m.with_null(m.with_null(t.customer.select("c_custkey"), "county", "string"), "ref", "long")


@query(
    "computed_flag",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 100000 THEN true ELSE false END AS is_big, "
    "CASE WHEN nullif(o_orderstatus, 'P') = 'O' THEN 'true' ELSE 'false' END AS is_open FROM orders",
)
def computed_flag(t: Tables):
    big = m.flag(t.orders, "is_big", F.col("o_totalprice") > 100000)
    opened = F.nullif(F.col("o_orderstatus"), F.lit("P")) == "O"
    return m.flag(big, "is_open", opened, as_text=True).select("o_orderkey", "is_big", "is_open")


PAIRS = [
    "o_orderkey",
    "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS code",
    "'new ' || o_custkey AS new_name",
    "'old ' || o_custkey AS old_name",
    "'n@' || o_custkey AS new_mail",
    "'o@' || o_custkey AS old_mail",
]


@query(
    "pick_by_status",
    f"SELECT o_orderkey, CASE WHEN code = 'O' THEN new_name WHEN code = 'F' THEN old_name WHEN code IS NULL THEN '' END AS name, "
    f"CASE WHEN code = 'O' THEN new_mail WHEN code = 'F' THEN old_mail WHEN code IS NULL THEN '' END AS mail "
    f"FROM (SELECT {', '.join(PAIRS)} FROM orders)",
)
def pick_by_status(t: Tables):
    choices = {"O": {"name": "new_name", "mail": "new_mail"}, "F": {"name": "old_name", "mail": "old_mail"}}
    return m.pick_by(t.orders.selectExpr(*PAIRS), "code", choices).select("o_orderkey", "name", "mail")


PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "5-LOW": "low"}


@query(
    "code_map",
    "SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' WHEN '5-LOW' THEN 'low' END "
    "AS label, c_mktsegment AS segment FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0",
)
def code_map(t: Tables):
    # Labels of priorities come from a literal table, segments from a code table kept as a frame.
    labelled = m.map_codes(t.orders, "o_orderpriority", PRIORITIES, to="label")
    table = t.customer.filter("c_acctbal > 0").select("c_custkey", "c_mktsegment")
    return m.map_codes(labelled, "o_custkey", table, to="segment").select("o_orderkey", "label", "segment")


@query(
    "filter_predicates",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE (l_quantity BETWEEN 10 AND 30 AND l_discount >= 0.05 "
    "AND l_returnflag <> 'R') OR (l_linestatus = 'F' AND l_tax IS NOT NULL AND l_shipdate < TIMESTAMP '1996-06-01 00:00:00')",
)
def filter_predicates(t: Tables):
    first = F.col("l_quantity").between(10, 30) & (F.col("l_discount") >= 0.05) & (F.col("l_returnflag") != "R")
    second = (
        (F.col("l_linestatus") == "F")
        & F.col("l_tax").isNotNull()
        & (F.col("l_shipdate") < F.lit("1996-06-01").cast("timestamp_ntz"))
    )
    return t.lineitem.filter(first | second).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "filter_in_list",
    "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') "
    "AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)",
)
def filter_in_list(t: Tables):
    urgent = relate.filter_in(t.orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])
    debtors = t.customer.filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return relate.anti(urgent, debtors, ["o_custkey"]).select("o_orderkey", "o_orderpriority")


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def drop_columns(t: Tables):
    return t.orders.drop("o_orderstatus", "o_totalprice", "o_orderpriority", "not_there")


@query(
    "stringify_columns",
    f"SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, CAST({ORDER_DAY} AS VARCHAR) AS day FROM orders",
)
def stringify_columns(t: Tables):
    return m.stringify(t.orders.selectExpr("o_orderkey", "o_custkey", f"{ORDER_DAY} AS day"), ["o_orderkey", "day"])


@query(
    "split_route",
    "SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') = 'O' AND o_totalprice > 50000 THEN 'good' ELSE 'bad' END AS route FROM orders",
)
def split_route(t: Tables):
    cond = (F.nullif(F.col("o_orderstatus"), F.lit("P")) == "O") & (F.col("o_totalprice") > 50000)
    return route(t.orders, cond).select("o_orderkey", "route")


@query(
    "length_check",
    "SELECT o_orderkey, coalesce(length(x) < 3 OR length(x) > 4, false) AS length_error FROM "
    "(SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS x FROM orders)",
)
def length_check(t: Tables):
    src = t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderkey AS STRING) END AS x")
    return length_errors(src, "x", 3, 4).select("o_orderkey", "length_error")
