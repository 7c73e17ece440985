from __future__ import annotations

import os
from pathlib import Path

from feedkit.streaming.feeds import delta_batch, load_stream, stream_delta, stream_feed
from feedkit.streaming.keys import KeyIndex

from .conftest import rows

SCHEMA = "id STRING, v STRING"


def drop(folder: Path, name: str, body: str, mtime: int) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("id,v\n" + body)
    os.utime(folder / name, (mtime, mtime))


def test_feed_loads_each_file_once_and_archives(spark, tmp_path):
    inbox, archive = tmp_path / "in", tmp_path / "archive"
    target, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        query = load_stream(stream_feed(spark, str(inbox), SCHEMA, str(archive), files_per_batch=1), target, state)
        query.awaitTermination()
        return query

    drop(inbox, "b.csv", "1,x\n", 1000)
    drop(inbox, "a.csv", "2,y\n", 2000)
    assert run().lastProgress["batchId"] == 1  # one file per batch
    assert rows(spark.read.parquet(target)) == [("1", "x", "b.csv"), ("2", "y", "a.csv")]
    drop(inbox, "c.csv", "3,z\n", 3000)
    run()
    run()
    assert spark.read.parquet(target).count() == 3
    archived = {p.name for p in archive.rglob("*.csv")}
    assert "b.csv" in archived


def test_oldest_file_comes_first(spark, tmp_path):
    inbox = tmp_path / "in"
    drop(inbox, "z.csv", "1,old\n", 1000)
    drop(inbox, "a.csv", "1,new\n", 2000)
    target = str(tmp_path / "out")
    stream_delta(stream_feed(spark, str(inbox), SCHEMA, files_per_batch=1), target, "id", ["v"], str(tmp_path / "state")).awaitTermination()
    assert rows(spark.read.parquet(target), "id", "v", "filename") == [("1", "old", "z.csv")]


def test_delta_adds_only_new_keys(spark, tmp_path):
    inbox, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        stream_delta(stream_feed(spark, str(inbox), SCHEMA, files_per_batch=1), target, "id", ["v"], state).awaitTermination()
        return rows(spark.read.parquet(target), "id", "v")

    drop(inbox, "a.csv", "1,b\n1,a\n2,c\n,n\n", 1000)
    assert run() == [(None, "n"), ("1", "a"), ("2", "c")]
    drop(inbox, "b.csv", "2,later\n3,d\n", 2000)
    assert run() == [(None, "n"), ("1", "a"), ("2", "c"), ("3", "d")]
    assert run() == [(None, "n"), ("1", "a"), ("2", "c"), ("3", "d")]


def test_delta_batch_can_run_again(spark, tmp_path):
    """A batch that failed after writing is repeated from its plan and must not add or lose rows."""
    inbox, target = tmp_path / "in", str(tmp_path / "out")
    drop(inbox, "a.csv", "1,a\n2,b\n", 1000)
    drop(inbox, "b.csv", "2,c\n3,d\n", 2000)

    def run(state: str):
        stream_delta(stream_feed(spark, str(inbox), SCHEMA, files_per_batch=1), target, "id", ["v"], state).awaitTermination()
        return rows(spark.read.parquet(target), "id", "v")

    first = run(str(tmp_path / "state1"))
    # The same batches again over the same target, as after a lost checkpoint entry.
    assert run(str(tmp_path / "state2")) == first == [("1", "a"), ("2", "b"), ("3", "d")]


def test_batches_read_the_buckets_of_their_own_keys_only(spark, tmp_path):
    """Many batches of new keys with a few old ones among them: what is read follows the batch, not what came before."""
    target, index = str(tmp_path / "out"), KeyIndex(spark, str(tmp_path / "keys"), "id", buckets=64)
    read, total = [], 0
    for n in range(16):
        ids = [f"k{n}-{i}" for i in range(80)] + ([f"k{n - 1}-3", f"k{n // 2}-5"] if n else [])
        rows_in = spark.createDataFrame([(k, str(v)) for v, k in enumerate(ids)] + [(None, "n")], SCHEMA)
        delta_batch(rows_in, n, target, "id", ["v"], index)
        read.append(sum(spark.read.option("basePath", f"{index.root}/keys").parquet(f"{index.root}/keys/bucket={b}").count() for b in index.opened))
        total += 80
    got = spark.read.schema(SCHEMA + ", batch LONG").parquet(target)
    assert got.filter("id IS NOT NULL").count() == got.select("id").distinct().count() - 1 == total
    assert got.filter("id IS NULL").count() == 16
    assert read[0] == 0 and max(read) < 6 * total / 64  # of 64 buckets a few, not all keys
    # The last batch again: the same rows, and the index as it was.
    before = rows(got.filter("batch = 15"), "id", "v")
    delta_batch(rows_in, 15, target, "id", ["v"], index)
    again = spark.read.schema(SCHEMA + ", batch LONG").parquet(target).filter("batch = 15")
    assert rows(again, "id", "v") == before
    assert spark.read.parquet(f"{index.root}/keys").count() == total


def test_a_target_without_an_index_gets_one(spark, tmp_path):
    target, index = str(tmp_path / "out"), KeyIndex(spark, str(tmp_path / "keys"), "id", buckets=4)
    spark.createDataFrame([("a", "1"), (None, "2")], SCHEMA).write.parquet(f"{target}/batch=0")
    spark.createDataFrame([("b", "1")], SCHEMA).write.parquet(f"{target}/batch=1")
    delta_batch(spark.createDataFrame([("a", "9"), ("c", "9"), ("b", "9")], SCHEMA), 2, target, "id", ["v"], index)
    assert rows(spark.read.parquet(target), "id", "v", "batch") == [(None, "2", 0), ("a", "1", 0), ("b", "1", 1), ("c", "9", 2)]
    assert index.covers(3) and not index.covers(7)
