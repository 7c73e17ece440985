"""One ordered file from many tasks, listings with empty files, lines set aside with their numbers."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedkit.sinks.exports import counted, export_delimited, export_log, export_ordered_file, file_log
from feedkit.sinks.tables import write_jdbc
from feedkit.sources import files, tables
from feedkit.sources.listing import FileListing, _Reader

from .conftest import rows


def write(path: Path, content: str, mtime: int | None = None) -> None:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)
    if mtime is not None:
        os.utime(path, (mtime, mtime))


@pytest.mark.parametrize("options", [{}, {"sep": "|", "header": False}, {"quote_all": True, "bom": True}])
def test_ordered_file_equals_a_sorted_single_write(spark, folder, options):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.concat(F.lit('say "x", '), F.col("id").cast("string")).alias("v")).repartition(6)
    export_ordered_file(df, folder("many"), "rows.csv", ["k"], parts=9, **options)
    export_delimited(df.coalesce(1).sortWithinPartitions("k"), folder("one"), single=False, **options)
    single = [p for p in Path(folder("one")).iterdir() if p.suffix == ".csv"]
    assert len(single) == 1
    made = Path(folder("many"))
    assert (made / "rows.csv").read_bytes() == single[0].read_bytes()
    assert [p.name for p in made.iterdir() if not p.name.startswith(("_", "."))] == ["rows.csv"]
    assert sum(p.stat().st_size for p in made.rglob("*.csv")) == single[0].stat().st_size  # the parts gave their space back


def test_ordered_file_gathers_its_rows_in_no_task(spark, folder):
    """Every part has its own range; without rows there is a heading, without both an empty file."""
    df = spark.range(10_000).withColumn("at", F.rand(3))
    export_ordered_file(df, folder("f"), "a.txt", ["at"], columns=["id"], parts=8)
    assert Path(folder("f"), "a.txt").read_text().splitlines()[0] == "id"
    shares = [r[1] for r in df.repartitionByRange(8, "at").groupBy(F.spark_partition_id()).count().collect()]
    assert len(shares) == 8 and max(shares) < 2 * 10_000 / 8
    export_ordered_file(df.limit(0), folder("f"), "b.txt", ["at"], columns=["id"])
    export_ordered_file(df.limit(0), folder("f"), "c.txt", ["at"], header=False)
    assert [Path(folder("f"), n).read_text() for n in ("b.txt", "c.txt")] == ["id\n", ""]
    with pytest.raises(NotImplementedError):
        export_ordered_file(df, "s3a://bucket/x", "a.txt", ["id"])


def test_listing_has_empty_files_and_all_levels(spark, tmp_path):
    root = tmp_path / "in"
    write(root / "a b+1%.csv", "xy\n", 2000)
    write(root / "empty.csv", "", 1000)
    for i in range(90):
        write(root / f"d{i % 3}" / f"e{i}" / f"{i}.csv", "x" * i, 3000 + i)
    write(root / "_hidden" / "no.csv", "x")
    write(root / ".crc", "x")
    listing = files.list_files(spark, str(root))
    got = {r["path"]: (r["name"], r["size"], int(r["modified"].timestamp())) for r in listing.collect()}
    assert len(got) == 92 and got[f"file:{root}/empty.csv"] == ("empty.csv", 0, 1000)
    assert got[f"file:{root}/a b+1%.csv"] == ("a b+1%.csv", 3, 2000) and got[f"file:{root}/d2/e8/8.csv"] == ("8.csv", 8, 3008)
    assert [r["name"] for r in files.pick_file(listing).collect()] == ["empty.csv"]
    assert listing.rdd.getNumPartitions() > 8
    assert rows(files.list_files(spark, f"file://{root}/empty.csv"), "name", "size") == [("empty.csv", 0)]
    (tmp_path / "none").mkdir()
    assert files.list_files(spark, str(tmp_path / "none")).count() == 0
    with pytest.raises(Exception, match="missing"):
        files.list_files(spark, str(tmp_path / "missing")).collect()
    assert not files.can_list("viewfs://x/y") and FileListing.name() == "file_listing"


def test_listing_opens_no_file(tmp_path):
    write(tmp_path / "in" / "locked.csv", "x")
    os.chmod(tmp_path / "in" / "locked.csv", 0)
    reader = _Reader(str(tmp_path / "in"))
    assert [r[1] for p in reader.partitions() for r in reader.read(p)] == ["locked.csv"]


def test_log_has_a_row_for_an_empty_file(spark, tmp_path):
    write(tmp_path / "out" / "a.txt", "id\n1\n2\n")
    write(tmp_path / "out" / "none left.txt", "")
    log = file_log(spark, str(tmp_path / "out"), "ids", F.lit("2024-06-30").cast("date"))
    assert rows(log, "name", "numberofrows", "size") == [("a.txt", 2, 7), ("none left.txt", 0, 0)]


SCHEMA = "id INT, name STRING, d DATE"


def test_lines_set_aside_with_file_and_number(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", 'id,name,d\n1,x,2024-01-01\n2,y\n\n3,"a, b",\n4,z,2024-01-02,more\nno,w,\n,,\n')
    write(tmp_path / "in" / "b.csv", "id,name,d\n")
    write(tmp_path / "in" / "c.csv", "")
    write(tmp_path / "in" / "d 1.csv", "id,name,d\nx\n9,last,2024-13-01")
    got = files.read_checked(spark, str(tmp_path / "in"), SCHEMA)
    assert [(r["id"], r["name"], str(r["d"]), r["filename"]) for r in got.rows.orderBy("filename", F.desc_nulls_last("id")).collect()] == [
        (3, "a, b", "None", "a.csv"), (1, "x", "2024-01-01", "a.csv"), (None, None, "None", "a.csv"),
    ]
    assert rows(got.rejects, "filename", "line", "text") == [
        ("a.csv", 3, "2,y"), ("a.csv", 6, "4,z,2024-01-02,more"), ("a.csv", 7, "no,w,"), ("d 1.csv", 2, "x"), ("d 1.csv", 3, "9,last,2024-13-01"),
    ]
    plain = files.read_delimited(spark, str(tmp_path / "in" / "b.csv"), SCHEMA)
    assert got.rows.drop("filename").dtypes == plain.dtypes


def test_line_numbers_of_a_split_file(spark, tmp_path):
    body = "".join(f"{i},x,\n" if i % 100 else f"{i}\n" for i in range(1, 4001))
    write(tmp_path / "big.csv", body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = files.read_checked(spark, str(tmp_path / "big.csv"), SCHEMA, header=False)
        assert sorted((r["line"], r["text"]) for r in got.rejects.collect()) == [(i, str(i)) for i in range(100, 4001, 100)]
        assert got.rows.count() == 3960
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_rows_and_checksum_are_counted_while_writing(spark, tmp_path):
    df = spark.range(700).selectExpr("id", "CAST(id % 9 AS STRING) AS v").repartition(5)
    one = export_ordered_file(df, str(tmp_path / "a"), "a.csv", ["id"])
    two = export_ordered_file(df.repartition(3), str(tmp_path / "b"), "b.csv", ["v"], parts=2)
    none = export_ordered_file(df.limit(0), str(tmp_path / "c"), "c.csv", ["id"])
    assert one.n_rows == two.n_rows == 700 and one.checksum == two.checksum != 0 and (none.n_rows, none.checksum) == (0, 0)
    other = counted(df.withColumn("v", F.lit("x")))
    other.df.write.format("noop").mode("overwrite").save()
    assert other.checksum != one.checksum
    log = export_log(spark, {"a.csv": one, "c.csv": none}, str(tmp_path), "ids", F.lit("2024-06-30").cast("date"))
    assert rows(log, "name", "numberofrows", "checksum") == [("a.csv", 700, str(one.checksum)), ("c.csv", 0, "0")]


def test_filled_columns_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "wide")
    wide = spark.range(3000).selectExpr(
        "id", "CAST(NULL AS STRING) AS none", "IF(id = 2999, 'x', NULL) AS one", "CAST(NULL AS DATE) AS `no day`", "CAST(NULL AS ARRAY<INT>) AS list", "named_struct('a', CAST(NULL AS INT)) AS s"
    )
    wide.repartition(4).write.parquet(path)
    assert tables.filled_columns(spark, path) == ["id", "one", "s"]
    assert tables.read_filled(spark, path).columns == ["id", "one", "s"]
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with tables._footers_answer(spark):
        plan = tables.counted_values(spark, path, ["id", "none", "no day"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(id), COUNT(none), COUNT(no day)]" in plan.replace("`", "")
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    spark.createDataFrame([], "a int, b string").write.parquet(str(tmp_path / "empty"))
    assert tables.filled_columns(spark, str(tmp_path / "empty")) == []


def test_measured_splits_hold_every_row_once(spark):
    df = spark.createDataFrame([(v,) for v in [None, None, -5, 0, 0, 0, 0, 7, 7, 9, 1000, 10**9]], "k long")
    for begins in ([-5, 0, 0, 7, 1000], [0], [], [-5, 10**9], [9, 7]):
        parts = tables.split_predicates("k", begins)
        assert sum(df.filter(p).count() for p in parts) == 12, parts
    assert tables.split_predicates("d", ["a", "b'c"]) == ["(d < 'b''c' OR d IS NULL)", "d >= 'b''c'"]
    with pytest.raises(TypeError):
        tables.split_predicates("k", [True, False])
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT CASE WHEN i < 900 THEN 5 ELSE i * i END AS k FROM range(1000) r(i)")
    begins = [r[0] for r in con.execute(tables.split_query("t", "k", 10)).fetchall()]
    sizes = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in tables.split_predicates("k", begins)]
    assert sum(sizes) == 1000 and sizes == [900, 100]


def test_a_table_is_exchanged_only_after_its_rows_are_there():
    """The order of what the database is asked, on a stand-in for the frame."""
    from unittest.mock import MagicMock

    df = MagicMock()
    df.columns = ["a", "b"]
    writer = df.repartition.return_value.write.format.return_value
    writer.mode.return_value = writer
    writer.options.return_value = writer
    write_jdbc(df, "jdbc:x", "raw.t", {"user": "u"}, replace=True)
    (staged,) = writer.options.call_args_list
    assert staged.kwargs["dbtable"] == "raw.t__new" and "truncate" not in staged.kwargs
    reader = df.sparkSession.read.format.return_value
    asked = reader.options.call_args.kwargs
    assert asked["sessionInitStatement"] == "BEGIN; DELETE FROM raw.t; INSERT INTO raw.t (a, b) SELECT a, b FROM raw.t__new; COMMIT"
    assert "numPartitions" not in asked  # one connection
    order = [c[0] for c in df.mock_calls]
    assert order.index("repartition().write.format().save") < order.index("sparkSession.read.format")
    writer.save.side_effect = RuntimeError("died")
    df.sparkSession.read.reset_mock()
    with pytest.raises(RuntimeError):
        write_jdbc(df, "jdbc:x", "raw.t", replace=True)
    assert not df.sparkSession.read.mock_calls
