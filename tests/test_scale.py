"""Plan shapes and skew: what must hold when the tables are a million times larger."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedkit import catalog
from feedkit.operators import delta, ranking, relate
from feedkit.session import RUNTIME_SETTINGS, scratch_dir

from .compare import DATA

PATH = f"{DATA}/sf0.001"
QUERIES = catalog.queries()
# Queries that only read and write files; their plan is one scan.
WRITERS = re.compile("^(src_|sink_|stream_|archive_|skip_preamble$|sent_rows|outbound|line_count|.*_export$|.*_load$)")


def plan_of(df, mode: str = "simple") -> str:
    spark = df.sparkSession
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


@pytest.fixture()
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not WRITERS.match(n)))
def test_plans_scale(spark, no_broadcast, name):
    """With no side small enough to broadcast, no plan compares all rows with all rows or leaves the JVM."""
    plan = plan_of(QUERIES[name](spark, PATH))
    for word in ("BroadcastNestedLoopJoin", "CartesianProduct", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert word not in plan
    if name != "skip_preamble_table":  # its other side has seven rows
        assert "BroadcastHashJoin" not in plan
    # Nothing but totals, listings and one-row subqueries is gathered in one task.
    if "Window [" in plan:
        assert "Exchange SinglePartition" not in plan.split("Subquery")[0]


def test_scans_are_pruned(spark):
    plan = plan_of(QUERIES["completions_enrich"](spark, PATH))
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan
    pushed = plan_of(QUERIES["filter_predicates"](spark, PATH), "formatted")
    assert "PushedFilters: [Or(" in pushed


def test_first_rows_are_cut_before_the_shuffle(spark):
    plan = plan_of(QUERIES["rn_latest_multi"](spark, PATH))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_hot_key_is_spread(spark):
    """A key with a third of the rows must not end up in one task."""
    n = 30_000
    df = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 7).alias("v"), "id"
    )
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        marked = ranking.flag_first(df, ["k"], ["v", "id"])
        # With the mark in the output both windows stay in the plan, each after an exchange.
        hot = marked.filter("k = 0").select(F.spark_partition_id().alias("task"), "is_first")
        assert plan_of(hot).count("Exchange hashpartitioning") == 2
        rows = hot.collect()
        placed = Counter(r["task"] for r in rows)
        assert sum(placed.values()) == n / 3 and sum(r["is_first"] for r in rows) == 1
        assert max(placed.values()) < n / 3 * 0.35
        for salts in (1, 5, 400):  # the result does not depend on the number of groups
            assert [r[0] for r in ranking.flag_first(df, ["k"], ["v", "id"], salts=salts).filter("k = 0 AND is_first").select("id").collect()] == [0]
        # Copies of one row spread as well: the salt also depends on the task that read them.
        copies = ranking.flag_first(df.select(F.lit(1).alias("k"), F.lit(1).alias("v")), ["k"], ["v"])
        placed = Counter(r["task"] for r in copies.select(F.spark_partition_id().alias("task"), "is_first").collect())
        assert sum(placed.values()) == n
        assert max(placed.values()) < n * 0.6
        assert copies.filter("is_first").count() == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", RUNTIME_SETTINGS["spark.sql.adaptive.coalescePartitions.enabled"])


@pytest.fixture()
def small_skew_limits(spark, no_broadcast):
    """Let adaptive execution see skew in test-sized data."""
    names = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in old.items():
        spark.conf.set(n, v)


def test_hot_join_key_is_split(spark, small_skew_limits):
    """Joins with a grouped side stay open to skew splitting."""
    df = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50_000).alias("k"), "id", F.col("id").cast("string").alias("pad")
    )
    other = spark.range(0, 100_000, 1, 4).select((F.col("id") % 40_000).alias("k"), (F.col("id") % 3).alias("held"))
    flagged = relate.with_partner_flag(df, other, "k", "k", "hit")
    owned = relate.has_other_id(df, other, "k", "id", "k", "held", "other")
    marked = delta.flag_delta(df, other.select("k"), key="k")
    for out in (flagged, owned, marked):
        assert out.count() == 200_000
        qe = out._jdf.queryExecution()
        qe.executedPlan().execute().count()
        assert "skew=true" in qe.executedPlan().toString()


def test_a_drop_is_shuffled_once(spark, no_broadcast):
    """The snapshot's identities are grouped and spread; the drop itself moves once, copies are removed where it lies."""
    cur = spark.range(100).selectExpr("CAST(id AS STRING) AS k", "id % 3 AS v")
    plan = plan_of(delta.flag_delta(cur, cur.select("k"), key="k").select("*"))
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 3


def test_requirements_are_read_once(spark, no_broadcast):
    plan = plan_of(QUERIES["students_late_or_open"](spark, PATH))
    assert plan.split("Initial Plan")[-1].count("max_by") > 0


def test_wide_projections_compile(spark):
    """No stage may outgrow generated code: Spark would then interpret it, after logging a failed compile."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    try:
        for name in ("person_standardize_form", "employment_from_form", "person_standardize_feed"):
            df = QUERIES[name](spark, PATH)
            sizes = [int(s) for s in re.findall(r"maxMethodCodeSize:(-?\d+)", plan_of(df, "codegen"))]
            assert sizes and max(sizes) < 30_000
            df.write.format("noop").mode("overwrite").save()
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")


def test_shared_folder_is_the_clusters(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    path = scratch_dir(spark, "x")
    assert path != scratch_dir(spark, "x")
    if shared:
        assert path.startswith(shared.rstrip("/") + "/")


def test_code_keeps_to_dataframes():
    """No RDDs, no Python functions per row, no data gathered on the driver, no checkpoint that dies with a machine."""
    root = Path(__file__).parent.parent / "feedkit"
    code = {p: p.read_text() for p in root.rglob("*.py") if "llm" not in p.parts}  # the corpus operators choose their own means
    for word in (".rdd", "toPandas", "pandas_udf", "F.udf", "applyInPandas", "mapInPandas", "localCheckpoint", ".collect()", "crossJoin"):
        assert [str(p) for p, text in code.items() if word in text] == []
