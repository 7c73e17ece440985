from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F, types as T

from feedkit.operators import aggregate as agg, delta, mapping as m, ranking, relate, setops
from feedkit.operators.routing import length_errors, route, split_routes

from .conftest import rows


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


# ---- mapping


def test_apply_mapping(spark):
    df = frame(spark, [("1", "2.5", "x"), ("n/a", "", None)], ["Employee Id", "hours", "drop me"])
    mapping = [
        ("employee id", "string", "employeeid", "long"),
        ("hours", "string", "hours", "numeric(5,2)"),
        ("hours", "string", "hours_text", "string"),
        ("gone", "string", "gone", "string"),
    ]
    out = m.apply_mapping(df, mapping)
    assert out.dtypes == [("employeeid", "bigint"), ("hours", "decimal(5,2)"), ("hours_text", "string")]
    assert [(r[0], r[2]) for r in out.collect()] == [(1, "2.5"), (None, "")]
    assert m.apply_mapping(df, mapping, missing="null").columns[-1] == "gone"
    with pytest.raises(ValueError):
        m.apply_mapping(df, mapping, missing="error")


def test_mapping_date_to_timestamp(spark):
    df = spark.sql("SELECT DATE '2020-01-02' AS d, TIMESTAMP '2020-01-02 10:00:00' AS t")
    out = m.apply_mapping(df, [("d", "date", "a", "timestamp"), ("t", "timestamp", "b", "date")])
    assert out.selectExpr("CAST(a AS STRING)", "CAST(b AS STRING)").first() == ("2020-01-02 00:00:00", "2020-01-02")


def test_conform_and_select(spark):
    df = frame(spark, [("7", "x")], "a string, b string")
    schema = T.StructType.fromDDL("b STRING, a INT, c DATE")
    assert m.conform(df, schema).first() == ("x", 7, None)
    assert m.select_existing(df, ["B", "nope", "a"]).columns == ["B", "a"]


def test_split_by_type(spark):
    df = frame(spark, [("5",), ("5.5",), ("x",), (None,)], "v string")
    assert rows(m.split_by_type(df, "v", ["bigint", "double", "string"])) == [
        (None, None, None), (None, None, "x"), (None, 5.5, None), (5, None, None),
    ]


def test_drop_all_null_columns(spark):
    df = frame(spark, [(1, None, ""), (2, None, None)], "a int, b string, c string")
    assert m.drop_all_null_columns(df).columns == ["a", "c"]


def test_blank_trim_and_literals(spark):
    df = frame(spark, [("", " x ", 1)], "a string, b string, n int")
    assert m.blank_to_null(df).first() == (None, " x ", 1)
    assert m.blank_to_null(df, ["b"]).first() == ("", " x ", 1)
    assert m.trim_all(df).first() == ("", "x", 1)
    assert m.with_null(df, "z", "long").dtypes[-1] == ("z", "bigint")
    assert m.with_literals(df, {"k": "v"}).first()[-1] == "v"


def test_flag_pick_codes(spark):
    df = frame(spark, [("1", "n", "o"), ("2", "n", "o"), (None, "n", "o"), ("9", "n", "o")], "s string, new string, old string")
    assert rows(m.flag(df, "f", F.col("s") == "1"), "s", "f") == [(None, False), ("1", True), ("2", False), ("9", False)]
    picked = m.pick_by(df, "s", {"1": {"name": "new"}, "2": {"name": "old"}})
    assert rows(picked, "s", "name") == [(None, ""), ("1", "n"), ("2", "o"), ("9", None)]
    assert rows(m.map_codes(df, "s", {"1": "one"}, "l"), "s", "l") == [(None, None), ("1", "one"), ("2", None), ("9", None)]
    table = frame(spark, [("1", "uno")], "code string, label string")
    assert rows(m.map_codes(df, "s", table), "s") == [(None,), (None,), (None,), ("uno",)]


def test_route_counts_unknown_as_bad(spark):
    df = frame(spark, [(1,), (None,), (5,)], "x int")
    routed = route(df, F.col("x") > 2)
    good, bad = split_routes(routed, ["good", "bad"])
    assert rows(good) == [(5,)] and rows(bad) == [(None,), (1,)]
    assert good.count() + bad.count() == df.count()


def test_length_errors(spark):
    df = frame(spark, [("123456",), ("1234567",), ("123456789",), ("1234567890",), (None,)], "s string")
    assert [r[1] for r in rows(length_errors(df, "s", 7, 9))] == [False, True, False, False, True]


# ---- joins


@pytest.mark.parametrize(
    ("right", "kept"),
    [([2, 3], [1]), ([2, None], []), ([], [None, 1, 2])],
    ids=["plain", "null on the right", "empty right"],
)
def test_not_in(spark, right, kept):
    left = frame(spark, [(1,), (2,), (None,)], "k int")
    other = frame(spark, [(v,) for v in right], "k int")
    got = [r[0] for r in rows(relate.not_in(left, other, "k"))]
    assert got == kept
    left.createOrReplaceTempView("not_in_left")
    other.createOrReplaceTempView("not_in_right")
    assert got == [r[0] for r in rows(spark.sql("SELECT * FROM not_in_left WHERE k NOT IN (SELECT k FROM not_in_right)"))]


def test_anti_and_semi_with_nulls(spark):
    left, other = frame(spark, [(1,), (2,), (None,)], "k int"), frame(spark, [(2,), (None,)], "k int")
    assert rows(relate.anti(left, other, ["k"])) == [(None,), (1,)]
    assert rows(relate.semi(left, other, ["k"])) == [(2,)]
    assert rows(relate.with_partner_flag(left, other, "k", "k", "hit")) == [(None, False), (1, False), (2, True)]


def test_join_any_key(spark):
    left = frame(spark, [(1, "a"), (2, "b"), (3, "c"), (1, "a"), (None, "n")], "id int, tag string")
    right = frame(spark, [(1, 9), (8, 2), (3, 3), (4, 1), (None, 3), (None, None)], "p int, q int")
    got = rows(relate.join_any_key(left, right, "id", ["p", "q"]), "tag", "p", "q")
    left.createOrReplaceTempView("any_left")
    right.createOrReplaceTempView("any_right")
    assert got == rows(spark.sql("SELECT tag, p, q FROM any_left JOIN any_right ON id = p OR id = q"))


def test_resolve_id(spark):
    xref = frame(spark, [(10, 1), (10, 1), (11, 2), (None, 3)], "ext int, pid int")
    df = frame(spark, [(10,), (12,), (None,)], "e int")
    assert rows(relate.resolve_id(df, xref, "e", "ext", "pid", "p")) == [(10, 1)]
    assert rows(relate.resolve_id(df, xref, "e", "ext", "pid", "p", how="left")) == [(None, None), (10, 1), (12, None)]


def test_conflicts_without_pairs(spark):
    random.seed(7)
    df = frame(spark, [(random.randint(0, 6) or None, random.randint(0, 9) or None) for _ in range(80)], "k int, i int")
    ref = frame(spark, [(random.randint(0, 6) or None, random.randint(0, 9) or None) for _ in range(60)], "rk int, ri int")
    df.createOrReplaceTempView("conf_df")
    ref.createOrReplaceTempView("conf_ref")
    distinct = df.distinct()
    want = spark.sql("SELECT k, i, count(*) FROM (SELECT DISTINCT * FROM conf_df) JOIN conf_ref ON k = rk WHERE i <> ri GROUP BY k, i")
    assert rows(relate.find_conflicts(distinct, ref, "k", "i", "rk", "ri")) == rows(want)
    flagged = relate.has_other_id(distinct, ref, "k", "i", "rk", "ri", "other").filter("other").drop("other")
    assert rows(flagged) == rows(want.drop("count(1)"))


def test_join_on_exprs(spark):
    left, right = frame(spark, [(" A ", 1), ("b", 2)], "n string, x int"), frame(spark, [("a", 9)], "m string, y int")
    out = relate.join_on_exprs(left, right, [(F.lower(F.trim("n")), F.lower("m"))], "left")
    assert rows(out, "x", "y") == [(1, 9), (2, None)]


# ---- first row per key


def brute_first(data):
    """(key, order value, id): the id of the smallest (order value, id) per key, nulls first."""
    best = {}
    for k, v, i in data:
        rank = (v is not None, v or 0, i)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, i)
    return {i for _, i in best.values()}


@pytest.mark.parametrize("salts", [1, 4, 32])
def test_flag_first_with_a_hot_key(spark, salts):
    random.seed(3)
    data = [(0 if i % 3 == 0 else random.choice([None, *range(1, 40)]), random.choice([None, *range(9)]), i) for i in range(3000)]
    df = frame(spark, data, "k int, v int, id int").repartition(6)
    marked = ranking.flag_first(df, ["k"], ["v", "id"], salts=salts)
    assert marked.columns == ["k", "v", "id", "is_first"]
    got = {r.id for r in marked.filter("is_first").collect()}
    assert got == brute_first(data)
    assert marked.count() == len(data)
    assert {r.id for r in ranking.keep_first(df, ["k"], ["v", "id"]).collect()} == got


def test_flag_first_marks_one_of_many_copies(spark):
    df = frame(spark, [(1, 1)] * 500 + [(2, 1)], "k int, v int").repartition(5)
    first, rest = ranking.split_first(df, ["k"], ["v"])
    assert rows(first) == [(1, 1), (2, 1)]
    assert rest.count() == 499


def test_keep_first_on_expressions_and_directions(spark):
    df = frame(spark, [("ab1", 1, "x"), ("ab2", 3, "y"), ("cd1", 2, None)], "c string, v int, t string")
    kept = ranking.keep_first(df, [F.substring("c", 1, 2)], [F.col("v").desc(), "t"])
    assert rows(kept, "c") == [("ab2",), ("cd1",)]
    assert kept.columns == df.columns


# ---- aggregation and unions


def test_concat_distinct(spark):
    df = frame(spark, [(1, "b"), (1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert rows(agg.concat_distinct(df, ["k"], "v", "vs")) == [(1, "a,b")]


def test_latest_batch_and_totals(spark):
    df = frame(spark, [(1, "a"), (2, "b"), (2, "c"), (None, "d")], "d int, f string")
    assert rows(agg.latest_batch(df, "d"), "f") == [("b",), ("c",)]
    assert rows(agg.control_totals({"all": df, "none": df.filter("false")})) == [("all", 4), ("none", 0)]


def test_pivot_takes_the_first_value(spark):
    df = frame(spark, [(1, "t", "late", 2), (1, "t", "early", 1), (1, "other", "x", 1)], "r int, t string, v string, o int")
    assert rows(agg.pivot_cells(df, ["r"], "t", "v", ["t", "u"], order=["o"])) == [(1, "early", None)]


SHEET = (
    "struct<columns:array<struct<virtualId:bigint,title:string>>,"
    "rows:array<struct<rowNumber:int,cells:array<struct<value:string,virtualColumnId:bigint>>>>>"
)


def test_sheets(spark):
    sheet = ([(1, "a"), (2, "b")], [(1, [("x", 1), ("y", 2)]), (2, [("z", 2), ("lost", 7)]), (3, [])])
    df = frame(spark, [sheet], SHEET[len("struct<") : -1].replace("columns:", "columns ").replace(",rows:", ", rows "))
    assert rows(agg.flatten_sheet(df, ["a", "b"])) == [(1, "x", "y"), (2, None, "z"), (3, None, None)]
    assert rows(agg.explode_cells(df)) == [(1, "a", "x"), (1, "b", "y"), (2, "b", "z")]


def test_unions(spark):
    a, b = frame(spark, [(1, "x"), (1, "x")], "k int, v string"), frame(spark, [("y", 2.5)], "v string, w double")
    assert rows(setops.union_by_name(a, b)) == [(None, "y", 2.5), (1, "x", None), (1, "x", None)]
    assert rows(setops.union_distinct(a, a)) == [(1, "x")]
    assert setops.union_all(a, a).count() == 4
    assert setops.union_many([a, a.select("v", "k"), a]).count() == 6


# ---- change detection


def test_flag_delta(spark):
    cur = frame(spark, [(" a", 1), ("b", 2), ("b", 2), (None, 3)], "id string, x int")
    prev = frame(spark, [("a ", 9), (None, 9)], "id string, x int")
    assert rows(delta.flag_delta(cur, prev, key="id")) == [(None, 3, True), (" a", 1, False), ("b", 2, True)]
    # A second run over its own output finds nothing new among rows with a key.
    again = delta.flag_delta(cur, cur, key="id").filter("isdelta AND id IS NOT NULL")
    assert again.count() == 0
    assert delta.flag_delta(cur, cur, cols=["id", "x"]).filter("isdelta").count() == 0
    assert delta.flag_delta(cur, prev, cols=["id", "x"]).filter("isdelta").count() == 3
    assert delta.flag_delta(cur, prev.limit(0), key="id").filter("NOT isdelta").count() == 0
    with pytest.raises(ValueError):
        delta.flag_delta(cur, prev)


def test_new_rows_are_idempotent(spark):
    cur = frame(spark, [(1, "a"), (1, "a"), (2, "b"), (None, "n")], "k int, v string")
    target = frame(spark, [(2, "other")], "k int, v string")
    new = delta.new_by_key(cur, target, ["k"])
    assert rows(new) == [(None, "n"), (1, "a")]
    assert rows(delta.new_by_key(cur, target.union(new), ["k"])) == [(None, "n")]
    hashed = delta.new_by_hash(cur, target, ["k", "v"])
    assert hashed.count() == 4
    assert delta.new_by_hash(cur, target.union(hashed), ["k", "v"]).count() == 0


def test_filter_in(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    values = spark.createDataFrame([(2, "a"), (2, "b"), (None, "c")], "other long, k string")
    assert [r["k"] for r in relate.filter_in(df, "k", values).collect()] == [2, 2]
    assert [r["k"] for r in relate.filter_in(df, "k", [2, 7]).collect()] == [2, 2]
    assert relate.filter_in(df, "k", []).count() == 0
