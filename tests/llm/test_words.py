"""Hashes of byte and word ranges: equal ranges agree, and pairs that beat a polynomial modulo a power of two do not."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest

from feedkit.llm import jaccard, quality, substrings
from feedkit.llm.queries import vocabulary
from feedkit.llm.tokens import Encoder
from feedkit.llm.words import BASES, PRIME, Texts, powers, ranges


def thue_morse(n: int, letters: str) -> tuple[str, str]:
    """The word of length ``n`` over two letters and the one with the letters exchanged."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return "".join(letters[b] for b in bits), "".join(letters[1 - b] for b in bits)


def test_powers():
    up, down = powers(12345, 3000)
    assert [int(x) for x in up[:5]] == [pow(12345, i, PRIME) for i in range(5)]
    assert int(up[600_000 % len(up)]) == pow(12345, 600_000 % len(up), PRIME)
    assert all(int(a) * int(b) % PRIME == 1 for a, b in zip(up[::997], down[::997]))


@pytest.mark.parametrize("kind", [np.uint8, np.uint64])
def test_equal_ranges_agree_wherever_they_stand(kind):
    rng = np.random.default_rng(2)
    part = rng.integers(0, 250, 700).astype(kind)
    data = np.concatenate([rng.integers(0, 250, 5000).astype(kind), part, rng.integers(0, 250, 90).astype(kind), part, part])
    starts = np.array([5000, 5790, 6490])
    for base in BASES:
        assert len(set(ranges(data, starts, starts + 700, base).tolist())) == 1
        cuts = np.arange(0, 5000)
        for width in (9, 64, 65, 300):
            assert len(set(ranges(data, cuts, cuts + width, base).tolist())) == 5000
        mixed = ranges(data, np.append(starts, 5000), np.append(starts + 700, 5005), base)
        assert len(set(mixed[:3].tolist())) == 1 and mixed[3] == ranges(data, np.array([5000]), np.array([5005]), base)[0]
    assert (ranges(data, starts, starts + 700, BASES[0]) != ranges(data, starts, starts + 700, BASES[1])).all()
    zeros = np.zeros(50, kind)
    assert len(set(ranges(zeros, np.zeros(50, int), np.arange(50), BASES[0]).tolist())) == 50  # lengths count


def test_long_ranges_do_not_overflow(monkeypatch):
    from feedkit.llm import words

    data = np.full(300_000, 255, np.uint8)
    want = ranges(data, np.array([0, 7]), np.array([300_000, 299_000]), BASES[0])
    monkeypatch.setattr(words, "_SMALL", 1000)
    assert (ranges(data, np.array([0, 7]), np.array([300_000, 299_000]), BASES[0]) == want).all()


@pytest.mark.parametrize("n", [1024, 4096])
@pytest.mark.parametrize("letters", ["ab", "xé"])
def test_thue_morse_words_differ_at_every_level(spark, n, letters):
    one, two = thue_morse(n, letters)
    words = Texts(pa.array([f"{one} {two} {one}"])).hashes()
    assert words[0] != words[1] and words[0] == words[2]
    both = pa.array([one, two])
    t = Texts(both)
    assert len({tuple(int(ranges(t.data, t.bounds[:-1], t.bounds[1:], b)[i]) for b in BASES) for i in range(2)}) == 2
    # Windows of words, also where the words themselves follow the pattern.
    filler = " ".join(f"w{i}" for i in range(60))
    rows = [(1, f"{one} {filler}"), (2, f"{two} {filler.replace('w', 'v')}"), (3, " ".join(one)), (4, " ".join(two))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r["doc_id"]: r["n_removed"] for r in substrings.remove_repeats(docs, size=50).collect()}
    assert left[1] == left[2] == 0
    five = spark.createDataFrame([(1, f"{one} b c d e"), (2, f"{two} b c d e")], "doc_id long, text string")
    assert sorted(r["component_id"] for r in jaccard.linked(five, size=5, percent=80).collect()) == [1, 2]
    encoder = Encoder(vocabulary())
    first, second = encoder.encode(pa.array([one])), encoder.encode(pa.array([two]))
    fresh = Encoder(vocabulary()).encode(pa.array([two]))
    assert second[0].tolist() == fresh[0].tolist() and first[0].tolist() != second[0].tolist()


def test_thue_morse_lines_and_words_are_counted_apart(spark):
    one, two = thue_morse(1024, "ab")
    docs = spark.createDataFrame([(1, f"{one}\n{two}"), (2, f"{one}\n{one}")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["n_dup_lines"] for r in quality.rate(docs, labels).collect()}
    assert got == {1: 0, 2: 1}
