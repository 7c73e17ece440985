"""The compiled automaton against the tokenizers library, and against merging by hand."""

from __future__ import annotations

import hashlib
import itertools
import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from feedkit.llm import automaton
from feedkit.llm.queries import QUERIES, vocabulary
from tests.compare import DATA

ODD = [
    "", " ", "a  b", " \n x", "<|endoftext|> x", "foo <|endoftext|><|endoftext|> bar<|endoftext|>", "é x　y z", "it's 12 's don'T", "\x1c\x1d a",
    "a" * 900, "=" * 777, "ab" * 3000, "\x00\x7f\x80 z", "漢字かな交じり文 🙂🙂", "a\tb\r\n\r\n  c", "ﬁ ǅ ½ ² ٣", "﻿x",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary())


def _texts() -> list[str]:
    rng = random.Random(7)
    alphabets = ("ab ce\tt'srdlm  \n.,é漢1²🙂 　ing", "etaoinshrdlu THEing", "aaab  ")
    return ODD + ["".join(rng.choice(a) for _ in range(rng.randint(1, 60))) for a in alphabets for _ in range(1500)]


def _split(values, counts):
    return [x.tolist() for x in np.split(values, np.cumsum(counts)[:-1])]


def test_same_ids_and_texts_as_the_library(library):
    texts = _texts()
    coder = automaton.Codec(vocabulary(), words=2000)  # so few that the memory begins anew many times
    got = []
    for at in range(0, len(texts), 400):
        got += _split(*coder.encode(pa.array(texts[at : at + 400])))
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert got == want
    flat, counts = np.array([i for x in want for i in x], np.uint32), np.array([len(x) for x in want])
    assert coder.decode(flat, counts).to_pylist() == [library.decode(x, skip_special_tokens=False) for x in want]


def test_decoding_of_ids_that_no_text_has(library):
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 50_300, (800, 9)).astype(np.uint32)
    got = automaton.Codec(vocabulary()).decode(ids.ravel(), np.full(800, 9)).to_pylist()
    assert got == [library.decode([int(i) for i in x if i < 50_257], skip_special_tokens=False) for x in ids]


def _by_hand(word: bytes, merges: list[tuple[bytes, bytes]]) -> list[bytes]:
    parts = [bytes([b]) for b in word]
    for u, v in merges:
        out = []
        for p in parts:
            if out and out[-1] == u and p == v and not getattr(out, "done", False):
                out[-1] = _Joined(u + v)
            else:
                out.append(p)
        parts = [bytes(p) for p in out]
    return parts


class _Joined(bytes):
    """A result of the merge that is being done: it does not take part in it again."""

    def __eq__(self, other):
        return False

    __hash__ = bytes.__hash__


@pytest.mark.parametrize("seed", range(12))
def test_gadgets_accept_exactly_what_merging_gives(seed):
    """All words up to eight letters of a small alphabet, for random lists of merges."""
    rng = random.Random(seed)
    letters = [b"a", b"b", b"c"][: 2 + seed % 2]
    tokens, merges = list(letters), []
    while len(merges) < 9:
        u, v = rng.choice(tokens), rng.choice(tokens)
        if u + v not in tokens:
            tokens.append(u + v)
            merges.append((u, v))
    ids = {t: i for i, t in enumerate(tokens)}
    machine = automaton.Automaton(tokens, [(ids[u], ids[v]) for u, v in merges])
    words = [b"".join(w) for n in range(1, 9 if len(letters) == 2 else 7) for w in itertools.product(letters, repeat=n)]
    want = [[ids[t] for t in _by_hand(w, merges)] for w in words]
    got = machine.encode_words(np.frombuffer(b"".join(words), np.uint8), np.array([len(w) for w in words]))
    assert _split(*got) == want
    accepted = {tuple(w) for w in want}
    for n in (1, 2, 3):
        for path in itertools.product(range(len(tokens)), repeat=n):
            if len(b"".join(tokens[i] for i in path)) < (9 if len(letters) == 2 else 7):
                assert machine.accepts(path) == (path in accepted)


def test_merges_that_make_no_new_id_are_refused():
    with pytest.raises(ValueError):
        automaton.Automaton([b"a", b"b", b"ab"], [(0, 1), (0, 1)])
    with pytest.raises(ValueError):
        automaton.Automaton([b"a", b"b"], [(0, 1)])


def test_rows_columns_and_empty_tables(spark, documents, nothing, corpus, library):
    clash = documents.withColumnsRenamed({"words": "ids", "n_words": "decoded"})
    got = automaton.decode(automaton.encode(clash, vocabulary()), vocabulary())
    assert got.columns == ["doc_id", "text", "ids", "decoded"]
    want = sorted((d, t or "", np.array(library.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()) for d, t in corpus)
    assert sorted((r["doc_id"], r["decoded"], bytes(r["ids"])) for r in got.collect()) == want
    assert automaton.decode(automaton.encode(nothing, vocabulary()), vocabulary()).count() == 0
    none = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted(r["decoded"] for r in automaton.decode(automaton.encode(none, vocabulary()), vocabulary()).collect()) == ["", "a b"]
    empty = spark.createDataFrame([(1, None)], "k long, ids binary")
    assert automaton.decode(empty, vocabulary()).collect()[0]["decoded"] == ""


@pytest.mark.skipif(not Path(f"{DATA}/sf0.001").exists(), reason="no test tables")
def test_query_over_the_whole_table(spark, library):
    path = f"{DATA}/sf0.001"
    want = []
    for doc, text in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        coded = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want.append((doc, len(ids), coded, hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = [tuple(r) for r in QUERIES["op12_bpe_automaton"](spark, path).collect()]
    assert sorted(got) == sorted(want)
