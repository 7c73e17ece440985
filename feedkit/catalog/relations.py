"""Joins, aggregations, windows, sorts and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators import aggregate as agg, ranking, relate, setops
from .inputs import ORDER_DAY, compact_date
from .registry import Tables, query, with_inputs

# ---- joins


@query(
    "join_inner",
    "SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey",
)
def join_inner(t: Tables):
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name", "c_mktsegment")


@query(
    "join_left",
    "SELECT o_orderkey, c_name, n_name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey "
    "LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def join_left(t: Tables):
    paying = t.customer.filter("c_acctbal > 0")
    named = t.orders.join(paying, F.col("o_custkey") == F.col("c_custkey"), "left")
    return named.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("o_orderkey", "c_name", "n_name")


@query(
    "join_normalized",
    "SELECT o_orderkey, c_nationkey FROM (SELECT o_orderkey, ' CUSTOMER#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') || ' ' AS who FROM orders) "
    "JOIN customer ON lower(trim(who)) = lower(c_name)",
)
def join_normalized(t: Tables):
    named = t.orders.select(
        "o_orderkey",
        F.concat(F.lit(" CUSTOMER#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"), F.lit(" ")).alias("who"),
    )
    pairs = [(F.lower(F.trim("who")), F.lower("c_name"))]
    return relate.join_on_exprs(named, t.customer, pairs).select("o_orderkey", "c_nationkey")


@query(
    "join_star",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, o_orderpriority, c_name, s_name, n_name, r_name FROM lineitem "
    "JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey "
    "JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def join_star(t: Tables):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    star = (
        lines.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return star.select(*lines.columns, "o_orderpriority", "c_name", "s_name", "n_name", "r_name")


@query(
    "join_subquery",
    "SELECT c_custkey, segments FROM customer JOIN (SELECT o_custkey, count(*) AS segments FROM "
    "(SELECT DISTINCT o_custkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F') GROUP BY o_custkey) ON c_custkey = o_custkey",
)
def join_subquery(t: Tables):
    done = t.orders.filter("o_orderstatus = 'F'").select("o_custkey", "o_orderpriority").distinct()
    per_customer = done.groupBy("o_custkey").agg(F.count("*").alias("segments"))
    return t.customer.join(per_customer, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "segments")


@query(
    "join_or",
    with_inputs(["person"], "SELECT o_orderkey, personid FROM orders JOIN person ON o_custkey = personid OR o_custkey = dshsid"),
)
def join_or(t: Tables):
    people = t.input("person").select("personid", "dshsid")
    return relate.join_any_key(t.orders, people, "o_custkey", ["personid", "dshsid"]).select("o_orderkey", "personid")


@query(
    "join_residual",
    with_inputs(
        ["person", "intake_form"],
        "SELECT responseid, personid FROM intake_form JOIN person ON CAST(personid AS VARCHAR) = terminated_person_id "
        "WHERE (upper(terminated_person_firstname) = upper(firstname) OR upper(terminated_person_lastname) = upper(lastname)) "
        "AND (terminated_person_ssn = ssn OR terminated_person_email = coalesce(email1, email2))",
    ),
)
def join_residual(t: Tables):
    form, person = t.input("intake_form"), t.input("person")
    name = (F.upper("terminated_person_firstname") == F.upper("firstname")) | (
        F.upper("terminated_person_lastname") == F.upper("lastname")
    )
    proof = (F.col("terminated_person_ssn") == F.col("ssn")) | (
        F.col("terminated_person_email") == F.coalesce("email1", "email2")
    )
    same = F.col("personid").cast("string") == F.col("terminated_person_id")
    return form.join(person, same & name & proof).select("responseid", "personid")


@query(
    "join_inequality_filter",
    with_inputs(
        ["provider", "crosswalk"],
        "SELECT o_orderkey, p.personid, count(*) AS conflicts FROM provider p LEFT JOIN crosswalk x ON p.ssn = x.ssn "
        "WHERE CAST(p.personid AS BIGINT) <> x.cdwaid GROUP BY o_orderkey, p.personid",
    ),
)
def join_inequality_filter(t: Tables):
    rows = t.input("provider").select("o_orderkey", "personid", "ssn", F.col("personid").cast("bigint").alias("own"))
    conflicts = relate.find_conflicts(rows, t.input("crosswalk"), "ssn", "own", "ssn", "cdwaid")
    return conflicts.select("o_orderkey", "personid", "conflicts")


@query("semi_in", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def semi_in(t: Tables):
    done = t.orders.filter("o_orderstatus = 'F'").withColumnRenamed("o_custkey", "c_custkey")
    return relate.semi(t.customer, done, ["c_custkey"]).select("c_custkey", "c_name")


@query(
    "semi_exists",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l WHERE EXISTS (SELECT 1 FROM lineitem r "
    "WHERE r.l_orderkey = l.l_orderkey AND r.l_suppkey = l.l_suppkey AND r.l_returnflag = 'R')",
)
def semi_exists(t: Tables):
    returned = t.lineitem.filter("l_returnflag = 'R'")
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return relate.semi(t.lineitem.select(*keep), returned, ["l_orderkey", "l_suppkey"]).select(*keep)


@query(
    "semi_left_notnull",
    with_inputs(
        ["person"],
        "SELECT o_orderkey, p.personid AS person_id FROM orders o LEFT JOIN (SELECT DISTINCT personid, cdwaid FROM person) p "
        "ON o.o_custkey + 500000 = p.cdwaid WHERE p.personid IS NOT NULL",
    ),
)
def semi_left_notnull(t: Tables):
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") + 500000).alias("ext"))
    return relate.resolve_id(rows, t.input("person"), "ext", "cdwaid", "personid", "person_id").drop("ext")


_KEYED = "(SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS k FROM orders)"
_DEBTORS = "(SELECT c_custkey AS k FROM customer WHERE c_acctbal < 2000)"


def _keyed(t: Tables) -> DataFrame:
    return t.orders.selectExpr("o_orderkey", "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS k")


@query(
    "anti_not_exists",
    f"SELECT o_orderkey, k FROM {_KEYED} o WHERE NOT EXISTS (SELECT 1 FROM {_DEBTORS} d WHERE d.k = o.k)",
)
def anti_not_exists(t: Tables):
    debtors = t.customer.filter("c_acctbal < 2000").select(F.col("c_custkey").alias("k"))
    return relate.anti(_keyed(t), debtors, ["k"]).select("o_orderkey", "k")


@query(
    "anti_not_in",
    f"SELECT 'plain' AS variant, o_orderkey, k FROM {_KEYED} WHERE k NOT IN (SELECT k FROM {_DEBTORS}) UNION ALL "
    f"SELECT 'with null', o_orderkey, k FROM {_KEYED} WHERE k NOT IN (SELECT nullif(k, 1) FROM (SELECT k FROM {_DEBTORS} UNION ALL SELECT 1)) UNION ALL "
    f"SELECT 'empty', o_orderkey, k FROM {_KEYED} WHERE k NOT IN (SELECT k FROM {_DEBTORS} WHERE k < 0)",
)
def anti_not_in(t: Tables):
    debtors = t.customer.filter("c_acctbal < 2000").select(F.col("c_custkey").alias("k"))
    nulled = debtors.union(t.customer.filter("c_custkey = 1").select(F.lit(None).cast("bigint")))
    others = {"plain": debtors, "with null": nulled, "empty": debtors.filter("k < 0")}
    parts = [relate.not_in(_keyed(t), o, "k").select(F.lit(v).alias("variant"), "o_orderkey", "k") for v, o in others.items()]
    return reduce(DataFrame.union, parts)


@query(
    "anti_left_null",
    "SELECT l_orderkey, l_linenumber, l_partkey, l.l_suppkey FROM lineitem l LEFT JOIN (SELECT DISTINCT ps, pp FROM "
    "(SELECT l_suppkey AS ps, l_partkey AS pp FROM lineitem WHERE l_returnflag = 'R')) p ON l.l_suppkey = ps AND l.l_partkey = pp "
    "WHERE ps IS NULL",
)
def anti_left_null(t: Tables):
    keep = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    returned = t.lineitem.filter("l_returnflag = 'R'")
    return relate.anti(t.lineitem.select(*keep), returned, ["l_suppkey", "l_partkey"]).select(*keep)


# ---- aggregation


@query("distinct_rows", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_rows(t: Tables):
    return agg.distinct_on(t.events, ["user_id", "event_type"])


@query(
    "dedupe_subset",
    "SELECT o_custkey, o_orderpriority, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority "
    "ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1",
)
def dedupe_subset(t: Tables):
    kept = ranking.drop_dups(t.orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])
    return kept.select("o_custkey", "o_orderpriority", "o_orderkey")


@query("group_concat_set", "SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS types FROM events GROUP BY user_id")
def group_concat_set(t: Tables):
    return agg.concat_distinct(t.events, ["user_id"], "event_type", "types")


@query(
    "max_scalar",
    "SELECT DISTINCT 'file-' || CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS filename FROM orders "
    "WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)",
)
def max_scalar(t: Tables):
    named = t.orders.selectExpr("o_orderdate", "concat('file-', CAST(CAST(o_orderdate AS DATE) AS STRING)) AS filename")
    return agg.latest_batch(named, "o_orderdate").select("filename").distinct()


@query(
    "row_count",
    "SELECT 'orders' AS name, count(*) AS n_rows FROM orders UNION ALL SELECT 'open', count(*) FROM orders WHERE o_orderstatus = 'O' "
    "UNION ALL SELECT 'lines', count(*) FROM lineitem",
)
def row_count(t: Tables):
    return agg.control_totals({"orders": t.orders, "open": t.orders.filter("o_orderstatus = 'O'"), "lines": t.lineitem})


@query(
    "pivot_first",
    "SELECT user_id, "
    + ", ".join(f"arg_min(value, event_id) FILTER (event_type = '{e}') AS {e}" for e in ("click", "error", "purchase", "signup", "view"))
    + " FROM events GROUP BY user_id",
)
def pivot_first(t: Tables):
    titles = ["click", "error", "purchase", "signup", "view"]
    return agg.pivot_cells(t.events, ["user_id"], "event_type", "value", titles, order=["event_id"])


# One sheet per order: its own column ids, and two rows of three cells (the second row lacks one).
SHEET = """
    o_orderkey AS sheet,
    array(named_struct('virtualId', o_orderkey * 10 + 1, 'title', 'learner id'),
          named_struct('virtualId', o_orderkey * 10 + 2, 'title', 'class id'),
          named_struct('virtualId', o_orderkey * 10 + 3, 'title', 'attendance')) AS columns,
    array(named_struct('rowNumber', 1, 'cells', array(
              named_struct('value', CAST(o_custkey AS STRING), 'virtualColumnId', o_orderkey * 10 + 1),
              named_struct('value', o_orderpriority, 'virtualColumnId', o_orderkey * 10 + 2),
              named_struct('value', o_orderstatus, 'virtualColumnId', o_orderkey * 10 + 3))),
          named_struct('rowNumber', 2, 'cells', array(
              named_struct('value', o_orderstatus, 'virtualColumnId', o_orderkey * 10 + 3),
              named_struct('value', CAST(o_custkey + 1 AS STRING), 'virtualColumnId', o_orderkey * 10 + 1)))) AS rows
"""


def _sheets(t: Tables) -> DataFrame:
    return t.orders.selectExpr(*_split_top(SHEET))


def _split_top(exprs: str) -> list[str]:
    """Split a select list at its top-level commas."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(exprs):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(exprs[start:i].strip())
            start = i + 1
    return [*out, exprs[start:].strip()]


@query(
    "explode_cells",
    "SELECT o_orderkey AS sheet, CAST(1 AS INTEGER) AS rowNumber, 'learner id' AS title, CAST(o_custkey AS VARCHAR) AS value FROM orders "
    "UNION ALL SELECT o_orderkey, 1, 'class id', o_orderpriority FROM orders "
    "UNION ALL SELECT o_orderkey, 1, 'attendance', o_orderstatus FROM orders "
    "UNION ALL SELECT o_orderkey, 2, 'attendance', o_orderstatus FROM orders "
    "UNION ALL SELECT o_orderkey, 2, 'learner id', CAST(o_custkey + 1 AS VARCHAR) FROM orders",
)
def explode_cells(t: Tables):
    return agg.explode_cells(_sheets(t), keep=["sheet"])


@query(
    "flatten_sheet",
    "SELECT o_orderkey AS sheet, CAST(1 AS INTEGER) AS rowNumber, CAST(o_custkey AS VARCHAR) AS \"learner id\", "
    'o_orderpriority AS "class id", o_orderstatus AS attendance FROM orders '
    "UNION ALL SELECT o_orderkey, 2, CAST(o_custkey + 1 AS VARCHAR), NULL, o_orderstatus FROM orders",
)
def flatten_sheet(t: Tables):
    return agg.flatten_sheet(_sheets(t), ["learner id", "class id", "attendance"], keep=["sheet"])


# ---- first row per key

LINE_ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey"


@query(
    "rn_earliest",
    "SELECT l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey, rn = 1 AS is_first FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY l_partkey ORDER BY {LINE_ORDER}) AS rn FROM lineitem)",
)
def rn_earliest(t: Tables):
    cols = ["l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"]
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return ranking.flag_first(t.lineitem.select(*cols), ["l_partkey"], order)


@query(
    "rn_latest_then_earliest",
    "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
    "ORDER BY CAST(ts AS DATE) DESC NULLS LAST, value ASC NULLS FIRST, event_id) AS rn FROM events) WHERE rn = 1",
)
def rn_latest_then_earliest(t: Tables):
    order = [F.col("ts").cast("date").desc_nulls_last(), F.col("value").asc_nulls_first(), "event_id"]
    return ranking.keep_first(t.events, ["user_id", "event_type"], order).select("user_id", "event_type", "event_id")


@query(
    "rn_latest_multi",
    "SELECT o_custkey, o_orderstatus, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus "
    "ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
)
def rn_latest_multi(t: Tables):
    order = [F.col(c).desc() for c in ("o_orderdate", "o_totalprice", "o_orderkey")]
    return ranking.keep_first(t.orders, ["o_custkey", "o_orderstatus"], order).select("o_custkey", "o_orderstatus", "o_orderkey")


@query(
    "rn_prefer_type",
    "SELECT p_name, p_brand, p_type, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY p_name, p_brand "
    "ORDER BY p_type, p_partkey) AS rn FROM part) WHERE rn = 1",
)
def rn_prefer_type(t: Tables):
    kept = ranking.keep_first(t.part, ["p_name", "p_brand"], ["p_type", "p_partkey"])
    return kept.select("p_name", "p_brand", "p_type", "p_partkey")


_SHEET_NAME = f"'sheet-' || {compact_date(ORDER_DAY)}"


@query(
    "rn_expr_key",
    f"SELECT family, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY family ORDER BY try_strptime(split_part(sheet, '-', 2), '%Y%m%d') DESC, o_orderkey) AS rn "
    f"FROM (SELECT o_orderkey, left(c, length(c) - 4) AS family, {_SHEET_NAME} AS sheet FROM "
    "(SELECT *, 'course' || (o_custkey % 700) || 'V001' AS c FROM orders))) WHERE rn = 1",
)
def rn_expr_key(t: Tables):
    rows = t.orders.selectExpr("o_orderkey", "'course' || (o_custkey % 700) || 'V001' AS c", f"{_SHEET_NAME} AS sheet")
    family = F.expr("substring(c, 1, length(c) - 4)")
    day = F.try_to_date(F.try_element_at(F.split("sheet", "-"), F.lit(2)), "yyyyMMdd")
    kept = ranking.keep_first(rows, [family], [day.desc_nulls_last(), "o_orderkey"])
    return kept.select(family.alias("family"), "o_orderkey")


@query(
    "top1_per_group",
    "SELECT c_nationkey, c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS rn "
    "FROM customer) WHERE rn = 1",
)
def top1_per_group(t: Tables):
    kept = ranking.keep_first(t.customer, ["c_nationkey"], [F.col("c_acctbal").desc(), "c_custkey"])
    return kept.select("c_nationkey", "c_custkey", "c_acctbal")


# ---- sort and limit


@query("limit_one", "SELECT min(c_name) AS c_name FROM customer")
def limit_one(t: Tables):
    return ranking.first_value_of(t.customer, "c_name")


@query("sort_rows", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def sort_rows(t: Tables):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@query("sort_in_cte", "WITH sorted AS (SELECT * FROM orders ORDER BY o_orderdate DESC) SELECT o_orderkey, o_orderdate FROM sorted")
def sort_in_cte(t: Tables):
    # An inner sort orders nothing in the result, so none is made.
    return t.orders.select("o_orderkey", "o_orderdate")


# ---- set operations

_PEOPLE = "SELECT c_nationkey AS nation, c_mktsegment AS label FROM customer"
_FIRMS = "SELECT s_nationkey AS nation, substr(s_name, 1, 8) AS label FROM supplier"


@query("union_distinct", f"{_PEOPLE} UNION {_FIRMS}")
def union_distinct(t: Tables):
    people = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("label"))
    firms = t.supplier.select("s_nationkey", F.substring("s_name", 1, 8))
    return setops.union_distinct(people, firms)


@query(
    "union_all",
    "SELECT c_custkey AS k, CAST(c_acctbal AS DOUBLE) AS amount FROM customer UNION ALL SELECT l_partkey, l_quantity FROM lineitem",
)
def union_all(t: Tables):
    return setops.union_all(
        t.customer.select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("amount")),
        t.lineitem.select("l_partkey", "l_quantity"),
    )


@query("union_many", "SELECT o_orderkey, o_orderpriority FROM orders")
def union_many(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderpriority")
    levels = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    return setops.union_many([rows.filter(F.col("o_orderpriority") == p) for p in levels])


@query(
    "union_by_name",
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer "
    "UNION ALL BY NAME SELECT s_name AS name, s_suppkey AS id FROM supplier",
)
def union_by_name(t: Tables):
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    firms = t.supplier.select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    return setops.union_by_name(people, firms)
