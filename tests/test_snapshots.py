"""Replaces that die, readers that go on reading, conflicts, dropped versions."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest

from feedkit import snapshots
from feedkit.plans.feeds import refresh_snapshot
from feedkit.sinks.tables import append, truncate, truncate_load
from feedkit.sources.tables import read_table

from .conftest import rows


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_versions_follow_each_other(spark, folder):
    root = folder("s")
    assert snapshots.latest(spark, root) is None
    with pytest.raises(LookupError):
        snapshots.read_snapshot(spark, root)
    assert [snapshots.publish(spark.range(n), root) for n in (5, 3)] == [1, 2]
    assert ids(snapshots.read_snapshot(spark, root)) == [0, 1, 2]
    assert ids(snapshots.read_snapshot(spark, root, 1)) == [0, 1, 2, 3, 4]
    assert rows(snapshots.versions(spark, root), "version", "n_rows", "dropped") == [(1, 5, False), (2, 3, False)]


def test_a_reader_keeps_its_version_while_it_is_replaced(spark, folder):
    root = folder("s")
    snapshots.publish(spark.range(1000).repartition(8), root)
    before = snapshots.read_snapshot(spark, root)
    stream = before.toLocalIterator()
    first = next(stream)
    snapshots.publish(before.selectExpr("id + 5000 AS id"), root)  # reads what it replaces
    assert sorted([first["id"], *[r["id"] for r in stream]]) == list(range(1000))
    assert ids(before) == list(range(1000))
    assert ids(snapshots.read_snapshot(spark, root)) == list(range(5000, 6000))


def test_a_job_that_dies_at_any_step_leaves_the_version(spark, folder, monkeypatch):
    root = folder("s")
    snapshots.publish(spark.range(4), root)
    with pytest.raises(Exception, match="dies"):  # while rows are written
        snapshots.publish(spark.range(4).selectExpr("IF(id = 3, raise_error('dies'), id) AS id"), root)
    assert ids(snapshots.read_snapshot(spark, root)) == [0, 1, 2, 3]

    def die(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:  # rows are there, the entry is not
        m.setattr(snapshots, "_announce", die)
        with pytest.raises(KeyboardInterrupt):
            snapshots.publish(spark.range(9), root)
    assert ids(snapshots.read_snapshot(spark, root)) == [0, 1, 2, 3]
    # The entry's file was begun, or finished but not committed: Spark writes it below _temporary, which no reader opens.
    for step, text in (("_temporary/attempt_0", '{"version":2,"fol'), ("task_0", '{"version":2,"folder":"data-0","n_rows":9,"dropped":false}\n')):
        begun = Path(root) / "versions" / "0000000002-0" / "_temporary" / "0" / step
        begun.mkdir(parents=True)
        (begun / "part-0.json").write_text(text)
    assert ids(snapshots.read_snapshot(spark, root)) == [0, 1, 2, 3]
    assert snapshots.publish(spark.range(2), root) == 2
    assert ids(snapshots.read_snapshot(spark, root)) == [0, 1]


def test_nothing_is_renamed(spark, folder):
    """What was published can be copied file by file, the log last, as a store without renames would."""
    root, copy = folder("s"), folder("copy")
    for n in (3, 6):
        snapshots.publish(spark.range(n), root)
    for part in sorted(Path(root).iterdir(), key=lambda p: p.name == "versions"):
        assert snapshots.latest(spark, copy) is None
        shutil.copytree(part, Path(copy) / part.name)
    assert ids(snapshots.read_snapshot(spark, copy)) == list(range(6))


def test_two_writers(spark, folder, monkeypatch):
    root = folder("s")
    snapshots.publish(spark.range(1), root)
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark.range(2), root, base=0)
    announce = snapshots._announce

    def meanwhile(spark, root, entry):
        """Another writer's entry of the same number, of a smaller folder, comes just before."""
        spark.range(7).write.parquet(f"{root}/data-0")
        announce(spark, root, entry._replace(folder="data-0", n_rows=7))
        announce(spark, root, entry)

    monkeypatch.setattr(snapshots, "_announce", meanwhile)
    with pytest.raises(snapshots.Conflict):
        snapshots.publish(spark.range(3), root)
    assert ids(snapshots.read_snapshot(spark, root)) == list(range(7))


def test_dropped_versions(spark, folder):
    root = folder("s")
    for n in (9, 2, 3, 4):
        snapshots.publish(spark.range(n), root)
    assert snapshots.drop_old(spark, root, keep=2) == [1, 2] and snapshots.drop_old(spark, root, keep=2) == []
    assert ids(snapshots.read_snapshot(spark, root, 3)) == [0, 1, 2]
    with pytest.raises(LookupError):
        snapshots.read_snapshot(spark, root, 1)
    assert snapshots.publish(spark.range(1), root) == 5
    with pytest.raises(ValueError):
        snapshots.drop_old(spark, root, keep=0)


def test_table_functions_know_snapshots(spark, folder):
    root = folder("s")
    snapshots.publish(spark.range(3), root)
    truncate_load(read_table(spark, root).selectExpr("id * 2 AS id"), root)
    assert ids(read_table(spark, root)) == [0, 2, 4] and ids(snapshots.read_snapshot(spark, root, 1)) == [0, 1, 2]
    with pytest.raises(ValueError):
        append(spark.range(1), root)
    truncate(spark, [root])
    assert read_table(spark, root).columns == ["id"] and read_table(spark, root).count() == 0


def test_refresh_marks_what_the_version_before_lacks(spark, folder):
    root, schema = folder("s"), "responseid string, v string"
    days = [[("a", "1"), ("b", "2"), ("b", "2")], [("b", "9"), (" c ", "3"), (None, "4")], []]
    for day in days:
        refresh_snapshot(spark.createDataFrame(day, schema), root, key="responseid")
    assert rows(snapshots.read_snapshot(spark, root, 1)) == [("a", "1", True), ("b", "2", True)]
    assert rows(snapshots.read_snapshot(spark, root, 2)) == [(None, "4", True), (" c ", "3", True), ("b", "9", False)]
    assert snapshots.read_snapshot(spark, root).count() == 0
