"""Reading tokens by rank at scale, and the ids of the registered queries against the library's plain call."""

from __future__ import annotations

import time
import zlib
from pathlib import Path

import numpy as np
import pytest

from feedkit.llm import packing, token_store
from feedkit.llm.queries import QUERIES, vocabulary
from tests.compare import DATA


def test_many_places_as_one(folder):
    rng = np.random.default_rng(1)
    ids = np.concatenate((rng.integers(0, 300, 3000), rng.integers(0, 2**32, 500), rng.integers(0, 70_000, 9000))).astype(np.uint32)
    coded = token_store.encode(ids)
    at = rng.integers(0, len(ids), 4000)
    assert (token_store.tokens_at(*coded, at) == ids[at]).all()
    assert [token_store.token_at(*coded, int(i)) for i in at[:300]] == ids[at[:300]].tolist()
    assert len(token_store.tokens_at(*coded, at[:0])) == 0


def test_one_segment_of_many_short_documents(spark, folder):
    """Work and memory follow documents and requests, not their squares."""
    docs = spark.range(60_000).selectExpr("id AS doc_id", "'a' AS text").coalesce(1)
    token_store.write_store(docs, folder("store"), vocabulary(), end_id=None, segment_tokens=1 << 18)
    assert spark.read.parquet(folder("store")).agg({"size": "max"}).first()[0] >= 6000
    asked = spark.range(200_000).selectExpr("id % 60000 AS doc_id", "id % 2 AS at")
    began = time.time()
    got = token_store.read_tokens(spark, folder("store"), asked).groupBy("at").agg({"token": "count", "*": "count"}).collect()
    assert sorted((r["at"], r["count(token)"]) for r in got) == [(0, 100_000), (1, 0)] and time.time() - began < 120


def test_nulls_repeats_and_one_id_for_two_documents(spark, folder):
    docs = spark.createDataFrame([(1, "one two"), (1, "six"), (None, "x"), (2, None)], "doc_id long, text string")
    token_store.write_store(docs, folder("store"), vocabulary(), end_id=0)
    asked = spark.createDataFrame([(1, 0), (1, 0), (None, 0), (2, 0), (2, None), (1, -1)], "doc_id long, at long")
    got = [tuple(r) for r in token_store.read_tokens(spark, folder("store"), asked).collect()]
    assert sum(r[:2] == (1, 0) and r[2] is not None for r in got) == 4  # two requests, two documents
    assert {r[:2] for r in got if r[2] is None} == {(None, 0), (2, None), (1, -1)}
    assert [r[2] for r in got if r[0] == 2 and r[1] == 0] == [0]


def _plain(texts):
    from tokenizers import Tokenizer

    return [e.ids for e in Tokenizer.from_file(vocabulary()).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_added_tokens_on_request(spark, folder):
    texts = ["x <|endoftext|> y", "a  <|endoftext|><|endoftext|>b", "<|endoftext|>", "<|endoftext", "plain"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_store.write_store(docs, folder("store"), vocabulary(), end_id=None, added=True)
    got = {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_store.read_documents(spark, folder("store")).collect()}
    assert [got[i] for i in range(len(texts))] == _plain(texts)
    pieces = packing.pack(docs, vocabulary(), capacity=64, end_id=2, added=True).pieces.collect()
    assert {r["doc_id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in pieces} == {i: x + [2] for i, x in enumerate(_plain(texts))}


@pytest.mark.skipif(not Path(f"{DATA}/sf0.001").exists(), reason="no test tables")
def test_queries_over_the_whole_table(spark):
    path = f"{DATA}/sf0.001"
    rows = sorted(spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect())
    ids = _plain([r["text"] for r in rows])
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    want, start = [], 0
    for r, x in zip(rows, ids):
        want.append((r["doc_id"], start, len(x) + 1, crc(x + [0])))
        start += len(x) + 1
    assert sorted(tuple(r) for r in QUERIES["op1_token_store"](spark, path).collect()) == want
    packed = QUERIES["op6_pack"](spark, path).collect()
    whole = {r["doc_id"]: x + [2] for r, x in zip(rows, ids)}
    used = {}
    for r in packed:
        part = whole[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert len(part) == r["length"] <= 1024 and crc(part) == r["ids_crc32"]
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sum(r["length"] for r in packed) == sum(map(len, whole.values())) and len({(r["doc_id"], r["piece"]) for r in packed}) == len(packed)
    for places in used.values():
        places.sort()
        assert places[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(places, places[1:])) and sum(places[-1]) <= 1024
    assert len(used) <= 1.02 * -(-sum(map(len, whole.values())) // 1024) + 1
