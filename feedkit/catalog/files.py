"""Sources and sinks: write a test table as a feed would come, read it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import dates, text
from ..session import scratch_dir
from ..snapshots import publish
from ..sinks.exports import export_delimited, export_log, export_ordered_file, line_counts, with_export_name
from ..sinks.tables import append, truncate, truncate_load
from ..sources.files import (
    clean_headers,
    if_empty,
    pick_file,
    read_checked,
    read_delimited,
    skip_preamble,
    skip_rows,
)
from ..sources.tables import read_table
from .inputs import ORDER_DAY, compact_date, us_date
from .registry import Tables, expressions, query

CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
CUSTOMER_TEXT = "SELECT " + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in CUSTOMER) + " FROM customer"
CUSTOMER_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in CUSTOMER])


def _dropped(t: Tables, df: DataFrame, label: str, **options) -> str:
    """Write a frame as a delimited drop and return its folder."""
    path = scratch_dir(t.spark, label)
    export_delimited(df, path, **options)
    return path


@query("src_csv_header", CUSTOMER_TEXT)
def src_csv_header(t: Tables):
    path = _dropped(t, t.customer, "csv", quote_all=True)
    return read_delimited(t.spark, path, CUSTOMER_SCHEMA)


@query(
    "src_csv_native",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, 'say "' || c_name || '", twice' AS note FROM customer""",
)
def src_csv_native(t: Tables):
    noted = t.customer.selectExpr("c_custkey", "concat('say \"', c_name, '\", twice') AS note")
    return read_delimited(t.spark, _dropped(t, noted, "csv-quotes"), escape='"')


# Lines of the drop that are not as they should be: a field too many, fields too few, a number that is none.
DAMAGE = {"c_custkey % 50 = 0": "c_custkey || ',x,' || c_nationkey || ',more'", "c_custkey % 77 = 0": "'' || c_custkey", "c_custkey % 91 = 0": "c_custkey || ',x,none'"}
DAMAGED = " OR ".join(DAMAGE)
LINE = "CASE " + " ".join(f"WHEN {c} THEN {x}" for c, x in DAMAGE.items()) + " ELSE c_custkey || ',x,' || c_nationkey END"


@query(
    "rejected_lines",
    f"SELECT 'row' AS route, CAST(c_custkey AS BIGINT) AS c_custkey, 'x' AS note, CAST(c_nationkey AS INTEGER) AS c_nationkey, CAST(NULL AS VARCHAR) AS text, "
    f"CAST(NULL AS BIGINT) AS line, 'customers.csv' AS filename FROM customer WHERE NOT ({DAMAGED}) "
    f"UNION ALL SELECT 'reject', NULL, NULL, NULL, text, line, 'customers.csv' FROM (SELECT *, {LINE} AS text, "
    f"1 + row_number() OVER (ORDER BY c_custkey) AS line FROM customer) WHERE {DAMAGED}",
)
def rejected_lines(t: Tables):
    path = scratch_dir(t.spark, "damaged")
    lines = t.customer.select("c_custkey", F.expr(LINE).alias("c_custkey,note,c_nationkey"))
    # The lines hold separators of their own, so they are written with one that they don't hold.
    export_ordered_file(lines, path, "customers.csv", ["c_custkey"], columns=[lines.columns[1]], sep="\t")
    checked = read_checked(t.spark, path, "c_custkey BIGINT, note STRING, c_nationkey INT")
    good = checked.rows.select(F.lit("row").alias("route"), "*").withColumns({"text": F.lit(None).cast("string"), "line": F.lit(None).cast("long")})
    return good.unionByName(checked.rejects.withColumn("route", F.lit("reject")), allowMissingColumns=True)


@query("src_csv_infer", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_infer(t: Tables):
    read = read_delimited(t.spark, _dropped(t, t.customer, "csv-infer"), infer=True)
    return read.select(F.col("c_custkey").cast("bigint"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("src_pipe", CUSTOMER_TEXT)
def src_pipe(t: Tables):
    return read_delimited(t.spark, _dropped(t, t.customer, "pipe", sep="|"), CUSTOMER_SCHEMA, sep="|")


@query(
    "src_headerless",
    "SELECT CAST(c_custkey AS VARCHAR) AS col0, c_name AS col1, CAST(c_nationkey AS VARCHAR) AS col2, "
    "CAST(c_acctbal AS VARCHAR) AS col3, c_mktsegment AS col4 FROM customer",
)
def src_headerless(t: Tables):
    path = _dropped(t, t.customer, "headerless", header=False)
    return read_delimited(t.spark, path, names=[f"col{i}" for i in range(5)])


@query("src_fixed_schema", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_fixed_schema(t: Tables):
    path = _dropped(t, t.customer, "fixed", header=False)
    schema = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    return read_delimited(t.spark, path, schema, header=False)


@query("src_dir", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def src_dir(t: Tables):
    # One sub-folder per segment, as drops of several days would lie below one prefix.
    path = scratch_dir(t.spark, "dir")
    t.customer.select("c_custkey", "c_name", "c_mktsegment").write.partitionBy("c_mktsegment").option("header", True).csv(path)
    return read_delimited(t.spark, path, "c_custkey STRING, c_name STRING", recursive=True)


@query("src_table", "SELECT * FROM customer")
def src_table(t: Tables):
    t.customer.createOrReplaceTempView("feedkit_customer")
    return read_table(t.spark, "feedkit_customer")


@query(
    "src_pruned_table",
    "SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS nation, upper(c_mktsegment) AS segment FROM customer",
)
def src_pruned_table(t: Tables):
    columns = ["c_custkey", "CAST(c_nationkey AS BIGINT) AS nation", "upper(c_mktsegment) AS segment"]
    return read_table(t.spark, f"{t.path}/customer.parquet", columns)


# Rows per report file in the check: each file holds one block of customers in key order.
REPORT_BLOCK = 1000


@query(
    "skip_preamble",
    f"SELECT CAST(c_custkey AS VARCHAR) AS col0, c_name AS col1 FROM (SELECT *, row_number() OVER "
    f"(PARTITION BY c_custkey // {REPORT_BLOCK} ORDER BY c_custkey) AS rn FROM customer) WHERE rn > 7",
)
def skip_preamble_files(t: Tables):
    path = scratch_dir(t.spark, "preamble")
    blocks = t.customer.selectExpr("c_custkey", "c_name", f"floor(c_custkey / {REPORT_BLOCK}) AS block")
    ordered = blocks.repartition("block").sortWithinPartitions("block", "c_custkey")
    ordered.write.partitionBy("block").csv(path)
    read = read_delimited(t.spark, path, names=["col0", "col1"], recursive=True)
    return skip_preamble(read, 7)


@query(
    "skip_preamble_table",
    "SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders) WHERE rn > 7",
)
def skip_preamble_table(t: Tables):
    return skip_rows(t.orders.select("o_orderkey", "o_custkey"), 7, ["o_orderkey"])


expressions(
    "file_lineage",
    "orders",
    ["o_orderkey"],
    [f"'bucket://feeds/in/raw/forms/Intake data' || {compact_date(ORDER_DAY)} || '101500.csv' AS uri"],
    lambda: {
        "by_pattern": text.file_name_of("uri"),
        "by_offset": F.expr("substring(uri, 27, length(uri))"),
        "by_replace": F.regexp_replace("uri", "^bucket://feeds/in/raw/forms/", ""),
    },
    {
        "by_pattern": "regexp_extract(uri, '([^/]+)$', 1)",
        "by_offset": "substring(uri, 27, length(uri))",
        "by_replace": "replace(uri, 'bucket://feeds/in/raw/forms/', '')",
    },
)
expressions(
    "file_date",
    "orders",
    ["o_orderkey"],
    [
        f"'Intake' || {compact_date(ORDER_DAY)} || '101500.csv' AS a",
        f"'providers-' || CASE WHEN o_orderkey % 5 = 0 THEN 'latest' ELSE CAST({ORDER_DAY} AS STRING) END || '.csv' AS b",
        f"'exam_' || {compact_date(ORDER_DAY)} || '_235959.TXT' AS c",
        f"'moves ' || replace({us_date(ORDER_DAY)}, '/', '') || '.csv' AS d",
    ],
    lambda: {
        "a_text": F.date_format(dates.file_date("a", "Intake", "yyyyMMddHHmmss"), "yyyy-MM-dd HH:mm:ss"),
        "b_day": dates.file_date("b", "providers-", "yyyy-MM-dd"),
        "c_text": F.date_format(dates.file_date("c", "exam_", "yyyyMMdd_HHmmss"), "yyyy-MM-dd HH:mm:ss"),
        "d_day": dates.file_date("d", "moves ", "MMddyyyy"),
    },
    {
        "a_text": "strftime(try_strptime(substr(a, 7, 14), '%Y%m%d%H%M%S'), '%Y-%m-%d %H:%M:%S')",
        "b_day": "CAST(try_strptime(substr(b, 11, 10), '%Y-%m-%d') AS DATE)",
        "c_text": "strftime(try_strptime(substr(c, 6, 15), '%Y%m%d_%H%M%S'), '%Y-%m-%d %H:%M:%S')",
        "d_day": "CAST(try_strptime(substr(d, 7, 8), '%m%d%Y') AS DATE)",
    },
)
expressions(
    "export_name",
    "orders",
    ["o_orderkey"],
    ["CAST(o_orderdate AS TIMESTAMP) AS run", "'providers-' || o_orderkey || '.csv' AS loaded"],
    lambda: {
        "us": dates.export_name("Students_", F.col("run"), "MM_dd_yyyy", "_1.txt"),
        "iso": dates.export_name("Status-", F.col("run"), "yyyy-MM-dd"),
        "stamp": dates.export_name("Ids_", F.col("run"), "yyyyMMdd_HHmmss", "_All.txt"),
        "errors": dates.error_name("loaded"),
    },
    {
        "us": "'Students_' || strftime(run, '%m_%d_%Y') || '_1.txt'",
        "iso": "'Status-' || strftime(run, '%Y-%m-%d') || '.csv'",
        "stamp": "'Ids_' || strftime(run, '%Y%m%d_%H%M%S') || '_All.txt'",
        "errors": "left(loaded, length(loaded) - 4) || '-error.csv'",
    },
)

# A file listing as list_files gives it, one file per order.
LISTING = [
    "CASE WHEN o_orderkey % 4 = 0 THEN 'transition ' ELSE 'feed-' END || o_orderkey || "
    "CASE WHEN o_orderkey % 3 = 0 THEN '.txt' ELSE '.csv' END AS name",
    f"CAST({ORDER_DAY} AS TIMESTAMP) AS modified",
    "o_custkey AS size",
]


def _listing(t: Tables) -> DataFrame:
    return t.orders.selectExpr(*LISTING)


def _picked(order: str, where: str = "true", skip: int = 0) -> str:
    return (
        f"SELECT name, CAST(modified AS DATE) AS day, size FROM (SELECT {', '.join(LISTING)} FROM orders) "
        f"WHERE {where} ORDER BY modified {order}, name LIMIT 1 OFFSET {skip}"
    )


def _file_row(df: DataFrame) -> DataFrame:
    return df.select("name", F.col("modified").cast("date").alias("day"), "size")


@query("pick_oldest_file", f"({_picked('ASC', skip=0)}) UNION ALL ({_picked('ASC', skip=1)})")
def pick_oldest(t: Tables):
    return _file_row(pick_file(_listing(t))).union(_file_row(pick_file(_listing(t), nth=1)))


@query("pick_newest_file", _picked("DESC"))
def pick_newest(t: Tables):
    return _file_row(pick_file(_listing(t), order="desc"))


NAMED = "name LIKE '%.csv' AND contains(name, 'transition')"


@query("pick_named_file", _picked("ASC", NAMED))
def pick_named(t: Tables):
    return _file_row(pick_file(_listing(t), suffix=".csv", contains="transition"))


@query(
    "empty_input_guard",
    "SELECT c_custkey, 'loaded' AS outcome FROM customer UNION ALL SELECT s_suppkey, 'kept' FROM supplier",
)
def empty_input_guard(t: Tables):
    def load(df: DataFrame) -> DataFrame:
        return df.select("c_custkey", F.lit("loaded").alias("outcome"))

    def keep(df: DataFrame) -> DataFrame:
        return t.supplier.select(F.col("s_suppkey").alias("c_custkey"), F.lit("kept").alias("outcome"))

    return if_empty(t.customer, load, keep).union(if_empty(t.customer.filter("c_custkey < 0"), load, keep))


@query("header_cleanup", 'SELECT c_custkey AS "Client ID", c_name AS "Name" FROM customer')
def header_cleanup(t: Tables):
    return clean_headers(t.customer.select("c_custkey", "c_name").toDF(' "Client ID" ', '"Name"'))


# Files handed out, by the sign of the balance.
OUTBOUND = {"c_acctbal < 0": "Students_06_30_2024_1.txt", "c_acctbal >= 0": "Students_06_30_2024_2.txt"}


@query(
    "outbound_file_log",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, 'students' AS category, DATE '2024-06-30' AS processed_date, count(*) AS numberofrows, true AS has_size, "
        f"true AS is_recent FROM customer WHERE {part}"
        for part, name in OUTBOUND.items()
    ),
)
def outbound_file_log(t: Tables):
    path = scratch_dir(t.spark, "outbound")
    sent = {
        name: export_ordered_file(t.customer.filter(part), f"{path}/{i}", name, ["c_custkey"], sep="|")
        for i, (part, name) in enumerate(OUTBOUND.items())
    }
    log = export_log(t.spark, sent, path, "students", F.lit("2024-06-30").cast("date"), suffix=".txt")
    recent = F.col("modified") > F.current_timestamp() - F.expr("INTERVAL 1 DAY")
    return log.select("name", "category", "processed_date", "numberofrows", (F.col("size") > 0).alias("has_size"), recent.alias("is_recent"))


@query("line_count", "SELECT count(*) AS n_lines FROM orders")
def line_count(t: Tables):
    path = _dropped(t, t.orders, "lines", header=False)
    return line_counts(t.spark, path).agg(F.sum("n_lines").alias("n_lines"))


@query("sink_truncate_load", "SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_truncate_load(t: Tables):
    target = scratch_dir(t.spark, "truncate-load")
    publish(t.customer, target)
    truncate_load(t.customer.withColumn("c_name", F.upper("c_name")), target)
    return read_table(t.spark, target)


@query("sink_append", "SELECT * FROM customer")
def sink_append(t: Tables):
    target = scratch_dir(t.spark, "append")
    append(t.customer.filter("c_acctbal < 0"), target)
    append(t.customer.filter("c_acctbal >= 0"), target)
    return read_table(t.spark, target)


_VARIANTS = {
    "pipe_header": {"sep": "|"},
    "pipe_plain": {"sep": "|", "header": False},
    "comma_quoted": {"quote_all": True},
    "comma_plain": {},
    "comma_bom": {"quote_all": True, "bom": True},
}


@query(
    "sink_export",
    " UNION ALL ".join(
        f"SELECT '{v}' AS variant, CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name || ', \"x\"' AS note FROM supplier"
        for v in _VARIANTS
    ),
)
def sink_export(t: Tables):
    rows = t.supplier.selectExpr("s_suppkey", "concat(s_name, ', \"x\"') AS note")
    out = None
    for variant, options in _VARIANTS.items():
        path = _dropped(t, rows, f"export-{variant}", **options)
        read = read_delimited(
            t.spark, path, "s_suppkey STRING, note STRING" if not options.get("header", True) else None,
            sep=options.get("sep", ","), header=options.get("header", True), escape='"',
        )
        part = read.toDF("s_suppkey", "note").select(F.lit(variant).alias("variant"), "s_suppkey", "note")
        out = part if out is None else out.union(part)
    return out


@query("sink_truncate", "SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def sink_truncate(t: Tables):
    target = scratch_dir(t.spark, "truncate")
    truncate_load(t.customer, target)
    truncate(t.spark, [target])
    append(t.customer.withColumn("c_name", F.upper("c_name")), target)
    return read_table(t.spark, target)


@query(
    "sent_rows_log",
    "SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 'Status-2024-06-30.csv' ELSE 'Status-2024-07-01.csv' END AS filename FROM customer",
)
def sent_rows_log(t: Tables):
    target = scratch_dir(t.spark, "sent")
    for part, day in (("c_acctbal < 0", "2024-06-30"), ("c_acctbal >= 0", "2024-07-01")):
        sent = t.customer.filter(part).select("c_custkey", "c_name")
        append(with_export_name(sent, dates.export_name("Status-", day, "yyyy-MM-dd")), target)
    return read_table(t.spark, target)


