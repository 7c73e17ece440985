"""Routed rows in their stored tables, read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..plans import completions as c, targets as g, transfers as tr
from ..session import scratch_dir
from ..sinks.exports import export_ordered_file
from ..sources.files import read_delimited
from ..sources.tables import read_table
from .jobs import _FEED_OK, _FIRST, _KEYS, _ROUTED, _RULE_INPUTS, _SAFETY_SQL, _case, _rules
from .registry import Tables, query, with_inputs

_TRANSFER_ROUTES = (
    f", {_FIRST}, marked AS (SELECT *, {_FEED_OK} AS ok, {_case(tr.PROGRAM_CODES, 'trainingprogram')} AS trainingprogramcode, "
    "EXISTS (SELECT 1 FROM transfer_history h WHERE h.personid = f.personid AND h.trainingprogram = f.trainingprogram "
    "AND CAST(h.transferhours AS DECIMAL(5,2)) = try_cast(f.credithours AS DECIMAL(5,2))) AS held FROM firsts f), "
    "fresh AS (SELECT * FROM marked WHERE rn = 1 AND ok AND NOT held), "
    f"ruled AS ({_rules('fresh', 'trainingprogram', 'completeddate')}), routed AS ({_ROUTED} "
    "UNION ALL SELECT event_id, NULL, 'logged', NULL FROM marked WHERE NOT (rn = 1 AND ok AND NOT held)) "
)
_TRANSFER_COLUMNS = "CAST(t.employeeid AS BIGINT) AS employeeid, CAST(t.personid AS BIGINT) AS personid, t.trainingprogram, t.classname, t.completeddate, t.filename"


@query(
    "store_transfers",
    with_inputs(
        [*_RULE_INPUTS, "transfer_history"],
        f"{_TRANSFER_ROUTES} SELECT 'staging' AS target, {_TRANSFER_COLUMNS}, {_case(tr.PROGRAM_CODES, 't.trainingprogram')} AS trainingprogramcode, "
        "try_cast(t.credithours AS DOUBLE) AS transferhours, NULL AS credithours, NULL AS error_message FROM routed JOIN transfer t USING (event_id) WHERE route = 'staging' "
        f"UNION ALL SELECT 'log', {_TRANSFER_COLUMNS}, NULL, NULL, t.credithours, error_message FROM routed JOIN transfer t USING (event_id) WHERE route <> 'staging'",
    ),
)
def store_transfers(t: Tables):
    routed = tr.feed_transfers(t.input("transfer"), t.input("person"), t.input("requirement"), t.input("transfer_history"), ["event_id"])
    staging, log = scratch_dir(t.spark, "staged-transfers"), scratch_dir(t.spark, "transfer-log")
    rejected = ("rule_error", "duplicate", "rejected_hours", "in_history")
    for _ in range(2):  # a run that is repeated replaces its rows
        g.store_routes(routed, [g.Target(["staging"], g.STAGED_TRANSFERS, staging), g.Target(rejected, g.TRANSFER_LOG, log)], "2024-06-30")
    both = read_table(t.spark, staging).withColumn("target", F.lit("staging"))
    both = both.unionByName(read_table(t.spark, log).withColumn("target", F.lit("log")), allowMissingColumns=True)
    return both.select(
        "target", "employeeid", "personid", "trainingprogram", "classname", "completeddate", "filename", "trainingprogramcode",
        "transferhours", "credithours", "error_message",
    )


@query(
    "store_safety_history",
    with_inputs(
        ["transfer", "person", "requirement"],
        ", need AS (SELECT DISTINCT p.personid FROM person p JOIN requirement r ON p.personid = r.personid WHERE r.trainingprogramcode = '100' "
        "AND r.status = 'active' AND p.cdwaid IS NOT NULL), ranked AS (SELECT *, row_number() OVER (PARTITION BY personid, trainingprogram "
        "ORDER BY completeddate NULLS FIRST, event_id) AS rn FROM transfer WHERE isvalid = 'true'), "
        "routed AS (SELECT *, rn = 1 AND personid IN (SELECT personid FROM need) AS kept FROM ranked) "
        f"SELECT CASE WHEN coalesce(kept, false) THEN 'history' ELSE 'log' END AS target, personid, completeddate, {_SAFETY_SQL}, 'FEED' AS trainingsource FROM routed",
    ),
)
def store_safety_history(t: Tables):
    routed = c.safety_from_transfers(t.input("transfer"), t.input("person"), t.input("requirement"), ["event_id"], "FEED")
    history, log = scratch_dir(t.spark, "history"), scratch_dir(t.spark, "history-log")
    g.store_routes(routed, [g.Target(["history"], g.TRAINING_HISTORY, history), g.Target(["log"], g.TRAINING_HISTORY_LOG, log)], "2024-06-30")
    kept = read_table(t.spark, history).withColumn("target", F.lit("history"))
    both = kept.unionByName(read_table(t.spark, log).withColumns({"target": F.lit("log"), "credithours": F.col("credithours").cast("double")}), allowMissingColumns=True)
    return both.select("target", "personid", "completeddate", "coursename", "credithours", "courseid", "trainingprogramcode", "trainingsource")


_ERRORS_SQL = (
    ", known AS (SELECT DISTINCT lower(lastname) AS ln, lower(coalesce(email1, email2)) AS em, CAST(personid AS VARCHAR) AS id FROM person "
    "WHERE coalesce(email1, email2) IS NOT NULL), flagged AS (SELECT n.*, id IS NOT NULL AS ok FROM named_completion n LEFT JOIN known ON "
    "lower(trim(last_name)) = ln AND lower(trim(learner_email)) = em AND trim(learner_id) = id), "
    "ranked AS (SELECT *, row_number() OVER (PARTITION BY learner_id, class_title, ok ORDER BY date NULLS FIRST, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rn FROM flagged) "
)


@query(
    "completions_error_export",
    with_inputs(
        ["named_completion", "person"],
        _ERRORS_SQL + "SELECT 'file' AS target, CAST(date AS VARCHAR) AS \"Date\", learner_id AS \"Learner ID\", last_name AS \"Last Name\", class_title AS \"Class Title\", "
        "learner_email AS \"Learner Email\", CAST(NULL AS BIGINT) AS personid FROM ranked WHERE NOT ok OR rn > 1 "
        "UNION ALL SELECT 'log', CAST(date AS VARCHAR), NULL, NULL, class_title, NULL, CAST(learner_id AS BIGINT) FROM ranked WHERE NOT ok OR rn > 1",
    ),
)
def completions_error_export(t: Tables):
    routed = c.validate_completions(t.input("named_completion"), t.input("person"), _KEYS)
    file, errors = g.completion_errors(g.stage_rejected(routed.drop(*_KEYS)))
    path, log = scratch_dir(t.spark, "completion-errors"), scratch_dir(t.spark, "completion-log")
    export_ordered_file(file, path, "completion_error_20240630.csv", ["Learner ID", "Class Title"], sep="|", quote_all=True, keep_blanks=True)
    errors.write.parquet(f"{log}/run=2024-06-30")
    sent = read_delimited(t.spark, path, sep="|").withColumns({"target": F.lit("file"), "personid": F.lit(None).cast("long")})
    logged = read_table(t.spark, log).select(
        F.col("completeddate").cast("string").alias("Date"), F.col("coursename").alias("Class Title"), F.lit("log").alias("target"), "personid"
    )
    names = ["target", "Date", "Learner ID", "Last Name", "Class Title", "Learner Email", "personid"]
    return sent.unionByName(logged, allowMissingColumns=True).select(*[F.col(f"`{n}`") for n in names])


@query(
    "load_transfer_texts",
    with_inputs(
        ["transfer"],
        "SELECT CAST(employeeid AS VARCHAR) AS employeeid, CAST(personid AS VARCHAR) AS personid, trainingprogram, classname, coursecode AS dshscoursecode, credithours, "
        "strftime(completeddate, '%Y%m%d') AS completeddate, CAST(employeeid AS VARCHAR) AS createddate, filename, CAST(substr(filename, 11, 10) AS DATE) AS filemodifieddate FROM transfer",
    ),
)
def load_transfer_texts(t: Tables):
    raw = t.input("transfer").select(
        F.col("employeeid").cast("string").alias("Employee Id"),
        F.col("personid").cast("string").alias("Person ID"),
        F.col("trainingprogram").alias("training program"),
        F.col("classname").alias("Class Name"),
        F.col("coursecode").alias("DSHS Course Code"),
        F.col("credithours").alias("Credit Hours"),
        F.date_format("completeddate", "yyyyMMdd").alias("Completed Date"),
        F.concat(F.lit('"'), F.col("employeeid").cast("string"), F.lit('"')).alias("CreatedDate"),
        "filename",
    )
    return g.load_transfer_texts(raw, "transfers-").select(
        "employeeid", "personid", "trainingprogram", "classname", "dshscoursecode", "credithours", "completeddate", "createddate", "filename", "filemodifieddate"
    )
