from __future__ import annotations

import gzip
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from feedkit.operators.mapping import blank_to_null
from feedkit.sinks.exports import export_delimited, file_log, line_counts, name_parts
from feedkit.sinks.tables import append, jdbc_write_options, truncate, truncate_load
from feedkit.sources import files, tables

from .conftest import rows


def write(path: Path, content: str, mtime: int | None = None) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content)
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return str(path)


def test_header_quotes_and_blanks(spark, tmp_path):
    p = write(tmp_path / "f.csv", 'id,name\n1,"a, b"\n2,""\n3,\n')
    df = blank_to_null(files.read_delimited(spark, p, "id STRING, name STRING"))
    assert rows(df) == [("1", "a, b"), ("2", None), ("3", None)]


def test_moved_columns_are_refused(spark, tmp_path):
    p = write(tmp_path / "f.csv", "name,id\na,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        files.read_delimited(spark, p, "id STRING, name STRING").collect()


def test_doubled_quotes(spark, tmp_path):
    p = write(tmp_path / "f.csv", 'id,name\n1,"say ""x"", twice"\n')
    assert rows(files.read_delimited(spark, p, escape='"')) == [("1", 'say "x", twice')]


def test_pipe_headerless_infer(spark, tmp_path):
    p = write(tmp_path / "f.txt", "1|a\n2|b\n")
    assert rows(files.read_delimited(spark, p, names=["c0", "c1"], sep="|")) == [("1", "a"), ("2", "b")]
    p = write(tmp_path / "g.csv", "id,x\n1,2.5\n")
    assert files.read_delimited(spark, p, infer=True).dtypes == [("id", "int"), ("x", "double")]


def test_lineage_of_names_with_blanks(spark, tmp_path):
    write(tmp_path / "in" / "Report w 06302024.csv", "id\n1\n")
    write(tmp_path / "in" / "sub" / "a+b 100%.csv", "id\n2\n")
    df = files.with_file_name(files.read_delimited(spark, str(tmp_path / "in"), "id STRING", recursive=True))
    assert rows(df) == [("1", "Report w 06302024.csv"), ("2", "a+b 100%.csv")]


def preamble(n: int, body: int, tag: str) -> str:
    return "".join(f"head{i},\n" for i in range(n)) + "".join(f"{tag}{i},x\n" for i in range(body))


def test_preamble_is_cut_per_file(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", preamble(7, 3, "a"))
    write(tmp_path / "in" / "b.csv", preamble(7, 2, "b"))
    write(tmp_path / "in" / "c.csv", preamble(7, 0, "c"))
    write(tmp_path / "in" / "d.csv", preamble(4, 0, "d"))
    write(tmp_path / "in" / "e.csv", "")
    df = files.read_delimited(spark, str(tmp_path / "in"), names=["k", "v"])
    assert [r[0] for r in rows(files.skip_preamble(df, 7))] == ["a0", "a1", "a2", "b0", "b1"]


def test_preamble_of_packed_files(spark, tmp_path):
    with gzip.open(tmp_path / "a.csv.gz", "wt") as out:
        out.write(preamble(7, 3, "a"))
    with gzip.open(tmp_path / "b.csv.gz", "wt") as out:
        out.write(preamble(5, 0, "b"))
    df = files.with_file_name(files.read_delimited(spark, str(tmp_path), names=["k", "v"]))
    assert rows(files.skip_preamble(df, 7), "k", "filename") == [(f"a{i}", "a.csv.gz") for i in range(3)]
    assert files.skip_preamble(df, 0).count() == 15


def test_named_parts(spark, tmp_path):
    for folder, parts in (("one", 1), ("two", 2)):
        path = str(tmp_path / folder)
        export_delimited(spark.range(10).repartition(parts), path)
        name_parts(spark, path, "Ids_1.txt")
    names = {f: sorted(p.name for p in (tmp_path / f).glob("*.txt")) for f in ("one", "two")}
    assert names == {"one": ["Ids_1.txt"], "two": ["Ids_1_1.txt", "Ids_1_2.txt"]}
    assert spark.read.option("header", True).csv(str(tmp_path / "two")).count() == 10


def test_preamble_of_a_split_file(spark, tmp_path):
    """A file read in several splits loses its first rows only once."""
    write(tmp_path / "big.csv", preamble(7, 5000, "r"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = files.read_delimited(spark, str(tmp_path / "big.csv"), names=["k", "v"])
        assert df.rdd.getNumPartitions() > 4
        kept = files.skip_preamble(df, 7)
        assert kept.count() == 5000
        assert kept.filter("k LIKE 'head%'").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_skip_rows(spark):
    df = spark.range(20).repartition(4)
    assert rows(files.skip_rows(df, 7, ["id"])) == sorted(((i,) for i in range(7, 20)), key=str)


def test_listing_and_picking(spark, tmp_path):
    d = tmp_path / "in"
    write(d / "b.csv", "x\n", 1000)
    write(d / "a.csv", "xy\n", 2000)
    write(d / "c.txt", "xyz\n", 500)
    listing = files.list_files(spark, str(d))
    assert rows(listing, "name", "size") == [("a.csv", 3), ("b.csv", 2), ("c.txt", 4)]

    def name(**kw):
        return [r.name for r in files.pick_file(listing, **kw).collect()]

    assert name() == ["c.txt"]
    assert name(suffix=".csv") == ["b.csv"]
    assert name(nth=1) == ["b.csv"]
    assert name(order="desc") == ["a.csv"]
    assert name(contains="a.") == ["a.csv"]
    assert name(nth=9) == []


def test_if_empty(spark, tmp_path):
    p = write(tmp_path / "f.csv", "id,name\n")
    df = files.read_delimited(spark, p, "id STRING, name STRING")
    assert files.if_empty(df, lambda d: "rows", lambda d: "empty") == "empty"
    assert files.if_empty(spark.range(1), lambda d: "rows", lambda d: "empty") == "rows"


def test_clean_headers(spark):
    df = spark.createDataFrame([(1, 2)], ['" a b "', "c"])
    assert files.clean_headers(df).columns == ["a b", "c"]


def parts(path: str) -> list[Path]:
    return sorted(Path(path).glob("*.csv"))


def test_export_variants(spark, folder):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string").coalesce(1)
    export_delimited(df, folder("p"), sep="|", single=True)
    assert parts(folder("p"))[0].read_text() == "id|name\n1|a\n2|\n"
    export_delimited(df, folder("h"), sep="|", header=False, single=True)
    assert parts(folder("h"))[0].read_text() == "1|a\n2|\n"
    export_delimited(df, folder("q"), quote_all=True, single=True)
    assert parts(folder("q"))[0].read_text().splitlines()[:2] == ['"id","name"', '"1","a"']
    export_delimited(df, folder("b"), quote_all=True, bom=True, single=True)
    raw = parts(folder("b"))[0].read_bytes()
    assert "﻿".encode() in raw[:8]
    with pytest.raises(ValueError):
        export_delimited(df, folder("x"), header=False, bom=True)


def test_export_is_partitioned_by_default(spark, folder):
    export_delimited(spark.range(0, 100, 1, 4), folder("many"))
    assert len(parts(folder("many"))) == 4
    export_delimited(spark.range(0, 100, 1, 4), folder("one"), single=True)
    assert len(parts(folder("one"))) == 1


def test_file_log(spark, tmp_path):
    d = tmp_path / "out"
    write(d / "a.txt", "id|x\n1|a\n2|b\n")
    write(d / "sub" / "a.txt", "id|x\n1|a\n")
    write(d / "empty.txt", "")
    log = file_log(spark, str(d), "students", F.lit("2024-06-30").cast("date"))
    assert rows(log, "name", "numberofrows", "size", "category") == [
        ("a.txt", 1, 9, "students"),
        ("a.txt", 2, 13, "students"),
        ("empty.txt", 0, 0, "students"),
    ]
    bare = file_log(spark, str(d), "ids", F.lit("2024-06-30").cast("date"), has_header=False)
    assert rows(bare, "name", "numberofrows") == [("a.txt", 2), ("a.txt", 3), ("empty.txt", 0)]
    assert rows(line_counts(spark, str(d)), "n_lines") == [(2,), (3,)]


def test_path_tables(spark, folder):
    target = folder("t")
    truncate_load(spark.range(5), target)
    truncate_load(spark.range(3), target)
    append(spark.range(3, 5), target)
    assert rows(tables.read_table(spark, target)) == [(i,) for i in range(5)]
    truncate(spark, [target])
    empty = tables.read_table(spark, target)
    assert empty.count() == 0 and empty.columns == ["id"]


def test_catalog_tables(spark, folder):
    name = "feedkit_catalog_test"
    spark.sql(f"CREATE TABLE {name} (id BIGINT, label STRING) USING parquet LOCATION '{folder('cat')}'")
    try:
        truncate_load(spark.createDataFrame([("a", 1)], "label string, id bigint"), name)
        append(spark.createDataFrame([(2, "b")], "id bigint, label string"), name)
        assert rows(tables.read_table(spark, name)) == [(1, "a"), (2, "b")]
        truncate_load(spark.createDataFrame([(9, "z")], "id bigint, label string"), name)
        assert rows(tables.read_table(spark, name, ["id", "upper(label) AS up"])) == [(9, "Z")]
        truncate(spark, [name])
        assert spark.table(name).count() == 0 and spark.table(name).columns == ["id", "label"]
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_jdbc_options():
    plain = tables.jdbc_options("jdbc:x", "raw.t", {"user": "u"}, single=True)
    assert plain["dbtable"] == "raw.t" and plain["user"] == "u" and "numPartitions" not in plain
    split = tables.jdbc_options("jdbc:x", "raw.t", split_on="id", bounds=(1, 100), partitions=8)
    assert (split["partitionColumn"], split["lowerBound"], split["upperBound"], split["numPartitions"]) == ("id", "1", "100", "8")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t", split_on="id")
    with pytest.raises(ValueError):
        tables.jdbc_options("jdbc:x", "t")  # one task for a whole table only on request
    assert jdbc_write_options("jdbc:x", "t", truncate=True)["truncate"] == "true"
    assert "truncate" not in jdbc_write_options("jdbc:x", "t", truncate=False)


def test_truncate_load_of_a_frame_that_reads_its_target(spark, folder):
    target = folder("snapshot")
    truncate_load(spark.range(5), target)
    truncate_load(spark.read.parquet(target).selectExpr("id + 1 AS id"), target)  # map only
    held = spark.read.parquet(target)
    truncate_load(held.join(spark.range(3, 100), "id"), target)
    assert sorted(r[0] for r in spark.read.parquet(target).collect()) == [3, 4, 5]
    with pytest.raises(Exception):
        truncate_load(spark.read.parquet(target).selectExpr("IF(id = 5, raise_error('dies'), id) AS id"), target)
    assert sorted(r[0] for r in spark.read.parquet(target).collect()) == [3, 4, 5]


def test_truncate_load_of_a_catalog_table_that_reads_itself(spark):
    name = "self_read"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    truncate_load(spark.range(4), name)
    try:
        truncate_load(spark.table(name).selectExpr("id * 2 AS id"), name)
        assert sorted(r[0] for r in spark.table(name).collect()) == [0, 2, 4, 6]
        assert not [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}__new")]
    finally:
        spark.sql(f"DROP TABLE {name}")
