"""Hard negatives against brute force: equal vectors, ties, rows that take no part, negative scores, several groups."""

from __future__ import annotations

import math

import numpy as np
import pytest

from feedkit.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, score string, ref string"


def brute(rows, positives=5, k=5):
    kept = []
    dims = {}
    for i, v, y in rows:
        if i is not None and y is not None and v and all(x is not None and math.isfinite(x) for x in v):
            dims[len(v)] = dims.get(len(v), 0) + 1
            kept.append((i, [math.floor(256 * float(np.float32(x))) for x in v], y))
    if not dims:
        return []
    width = max(dims, key=lambda d: (dims[d], d))
    kept = [r for r in kept if len(r[1]) == width]
    out = []
    for at, (i, v, y) in enumerate(kept):
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, n, z) for n, (j, w, z) in enumerate(kept))
        for p, j, _, _ in [s for s in scored if s[3] == y and s[2] != at][:positives]:
            good = [s for s in scored if s[3] != y and 80 * -p <= 100 * -s[0] <= 100 * -p]
            out += [(i, j, rank, s[1], -p, -s[0]) for rank, s in enumerate(good[:k], 1)]
    return sorted(out)


def _rows(n=900, dims=8, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.4, (6, dims))
    rows = []
    for i in range(n):
        v = (centres[rng.integers(6)] + rng.normal(0, 0.1, dims)).astype(np.float32)
        rows.append((i, [float(x) for x in v], int(rng.integers(4))))
    for i in range(0, n, 3):  # a third of all rows are one vector, under two labels
        rows[i] = (i, rows[1][1], i % 2)
    for i in (50, 150, 250, 350):  # near ties after flooring
        rows[i] = (i, [x + 1e-4 for x in rows[1][1]], 2)
    nan = float("nan")
    rows += [(n, None, 1), (n + 100, [0.1] * dims, None), (None, [0.1] * dims, 1), (1000, [nan] + [0.1] * (dims - 1), 1), (1100, [0.1] * (dims - 1) + [None], 1)]
    rows += [(1200, [float("inf")] * dims, 1), (1300, [0.5] * (dims + 1), 1), (1400, [], 1), (1500, [-x for x in rows[1][1]], 77), rows[100], rows[100], rows[7]]
    return rows


@pytest.mark.parametrize("dims", [8, 1])
def test_same_as_brute_force(spark, monkeypatch, dims):
    monkeypatch.setattr(negatives, "GROUP_ROWS", 64)
    monkeypatch.setattr(negatives, "FIRST_ROWS", 20)
    monkeypatch.setattr(negatives, "TOGETHER", 2)
    rows = _rows(dims=dims)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    got = sorted(tuple(r) for r in negatives.mine(df, "vec_id % 100 = 0").collect())
    want = brute(rows)
    assert got == want and len(want) > 50


def test_heap_falls_and_lists_every_cell_once():
    rng = np.random.default_rng(1)
    books = rng.normal(size=(7, 3)), rng.normal(size=(5, 4))
    index = negatives.Index(books, (rng.random(7), rng.random(5)), np.ones(35, int), np.zeros(35, int), np.ones(35, int), "<i2", True, 3)
    seen = list(index.cells(rng.normal(size=7)))
    assert sorted(c for _, c in seen) == list(range(35))
    assert all(a[0] >= b[0] - 1e-9 for a, b in zip(seen, seen[1:]))


def test_empty_and_unusable_tables(spark):
    assert negatives.mine(spark.createDataFrame([], SCHEMA), "vec_id % 100 = 0").collect() == []
    lone = spark.createDataFrame([(100, [0.5, 0.5], 1, "", ""), (200, None, 1, "", "")], SCHEMA)
    assert negatives.mine(lone, "vec_id % 100 = 0").collect() == []
    huge = spark.createDataFrame([(100, [1e30, 1.0], 1, "", "")], SCHEMA)
    with pytest.raises(ValueError):
        negatives.mine(huge, "vec_id % 100 = 0")
