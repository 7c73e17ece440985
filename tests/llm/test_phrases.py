"""Phrases against brute force on small least counts: waves, chunks and blocks of a few words, nulls, overlaps, ties."""

from __future__ import annotations

import collections
import random
import re
import string

import pytest

from feedkit.llm import phrases

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
SCHEMA = "text string, lang string, phrase string, score double"


def brute(rows, least, limit):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        often = {q: a for q, a in f.items() if len(q) > 1 and a >= least}
        gone = {q[i:j] for q, a in often.items() for i in range(len(q)) for j in range(i + 2, len(q) + 1) if j - i < len(q) and 100 * a >= 100 * f[q[i:j]]}
        scored = []
        for q, a in often.items():
            if q not in gone:
                s, k = min((1000 * a * totals[lang] // (f[q[:k]] * f[q[k:]]), k) for k in range(1, len(q)))
                scored.append((-s, -a, " ".join(q).encode(), f[q[:k]], f[q[k:]]))
        for rank, (s, a, q, l, r) in enumerate(sorted(scored)[:limit], 1):
            out.append((lang, rank, q.decode(), -a, l, r, totals[lang], -s))
    return sorted(out)


def _rows():
    rng = random.Random(9)
    words = ["the", "The", "of", "a", "Été", "naïve", "b c", "x-y", "it's"] + [f"w{i}" for i in range(40)]
    weights = [60, 20, 40, 30] + [4] * 5 + [60 / (i + 3) for i in range(40)]
    fixed = [("new york city", 30), ("a a a", 25), ("once upon a time there", 40), ("upon a time", 9), ("once upon a time there was one", 22), ("x y", 12), ("Naïve Été", 18)]
    rows = []
    for i in range(260):
        text = []
        for _ in range(rng.randint(0, 12)):
            text += rng.choices(words, weights, k=rng.randint(1, 9))
            text.append(rng.choice(["", "", ",", ".", "\n", "\t", " ;", "!?", "\r\n"]))
        rows.append((" ".join(text), rng.choice(["en", "en", "en", "fr", None, "und"])))
    rows += [(f"{p}. {p} {rng.choice(words)}" if n % 2 else p, lang) for p, times in fixed for n in range(times) for lang in ("en", "de")]
    rows += [(None, "en"), ("", None), (" \t,,", "zz"), ("q " * 3000, "long"), ("once", "en"), rows[0], rows[0]]
    return rows


@pytest.fixture(scope="module")
def small():
    return _rows()


@pytest.mark.parametrize("least, limit, cap, rise", [(8, 12, 1, 4), (20, 2000, 16, 32)])
def test_same_as_brute_force(spark, monkeypatch, small, least, limit, cap, rise):
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 1500)
    monkeypatch.setattr(phrases, "FIRST_CAP", cap)
    monkeypatch.setattr(phrases, "RISE", rise)
    docs = spark.createDataFrame([(t, x, "clash", 0.5) for t, x in small], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(docs, least=least, limit=limit, chunk_bytes=2000).collect())
    want = brute(small, least, limit)
    assert got == want and len(want) > 8


def test_empty_tables(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None, "", 0.0), ("a b", "en", "", 0.0)], SCHEMA)).collect() == []


