"""Stored targets: projections, repeated runs, routes that nobody takes."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from feedkit.operators.ranking import flag_first
from feedkit.plans import targets as g

from .conftest import rows

ROUTED = "employeeid string, personid long, trainingprogram string, credithours string, completeddate string, error_message string, route string"


def routed(spark, *more):
    data = [
        ("7", 1, "Continuing Education", "12", "2024-01-02", None, "staging"),
        ("x", 2, "Basic Training 9 Hours", "n/a", "bad", "late", "rule_error"),
        ("9", None, None, None, None, None, "duplicate"),
    ]
    return spark.createDataFrame([*data, *more], ROUTED)


def test_each_target_takes_its_routes_and_columns(spark, folder):
    staging, log = folder("staging"), folder("log")
    targets = [g.Target(["staging"], g.STAGED_TRANSFERS, staging), g.Target(["rule_error", "duplicate"], g.TRANSFER_LOG, log)]
    for run in ("a", "a", "b"):  # the first run is repeated
        g.store_routes(routed(spark), targets, run)
    kept = spark.read.parquet(staging)
    assert [c for c in kept.columns if c != "run"] == [m[2] for m in g.STAGED_TRANSFERS]
    assert [(r["employeeid"], r["transferhours"], str(r["completeddate"]), r["filename"], r["run"]) for r in kept.orderBy("run").collect()] == [
        (7, 12.0, "2024-01-02", None, "a"), (7, 12.0, "2024-01-02", None, "b"),
    ]
    logged = spark.read.parquet(log).filter("run = 'a'")
    assert rows(logged, "employeeid", "personid", "credithours", "completeddate", "error_message") == [(None, 2, "n/a", None, "late"), (9, None, None, None, None)]


@pytest.mark.parametrize("route", ["staged", None])
def test_a_route_that_no_target_takes_is_an_error(spark, folder, route):
    more = ("1", 1, "p", "1", None, None, route)
    with pytest.raises(ValueError, match="no target"):
        g.store_routes(routed(spark, more), [g.Target(["staging", "rule_error", "duplicate"], g.TRANSFER_LOG, folder("log"))], "a")


def test_error_file_has_headings_of_the_columns_there_are(spark):
    schema = "learner_id string, Last_Name string, class_title string, duration string, route string, extra int"
    df = spark.createDataFrame([("1", "A", "c", "2.5", "valid", 0), ("2x", "B", "d", "n/a", "unmatched", 0), ("3", "C", "e", "1", "duplicate", 0)], schema)
    file, log = g.completion_errors(df)
    assert file.columns == ["Learner ID", "Last Name", "Class Title", "Duration"]
    assert rows(file) == [("2x", "B", "d", "n/a"), ("3", "C", "e", "1")]
    assert rows(log, "personid", "coursename", "credithours", "instructorname") == [(None, "d", None, None), (3, "e", 1.0, None)]


def test_logs_of_histories():
    assert [m[2] for m in g.TRAINING_HISTORY_LOG] == [m[2] for m in g.TRAINING_HISTORY][:-1]
    assert dict((m[2], m[3]) for m in g.TRAINING_HISTORY_LOG)["credithours"] == "int"
    assert {m[2] for m in g.UNIQUE_LOG} - {m[2] for m in g.TRAINING_HISTORY} == {"recordcreateddate", "recordmodifieddate", "qual_person_id", "dshscourseid"}


def test_rejected_rows_are_ranked_once_and_then_read(spark):
    schema = "learner_id string, last_name string, class_title string, route string"
    df = spark.createDataFrame([("1", "A", "c", "valid"), ("2x", " B", "d", "unmatched"), ("3", None, "e", "duplicate")], schema)
    marked = flag_first(df, ["learner_id", "class_title", F.upper("last_name")], ["route"])
    copies = {f"_key{i}" for i in range(3) if f"_key{i}#" in marked._jdf.queryExecution().analyzed().toString()}
    assert copies == {"_key2"}  # only computed keys travel beside their row
    staged = g.stage_rejected(marked)
    assert staged.columns == [*df.columns, "is_first"]
    plan = staged._jdf.queryExecution().toString()
    assert "Window" not in plan and "Exchange" not in plan
    assert rows(staged, "learner_id", "last_name", "is_first") == [("2x", " B", True), ("3", None, True)]
