"""Language proportions of whole documents: a mixture of languages fitted by expectation-maximisation."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import column, release, text_slices

BUCKETS = 1 << 16
UNDETERMINED = "und"
SCHEMA = "lang_pred string, score double, languages array<string>, proportions array<double>"

# Letters stay, in lower case (also the two-byte Latin ones); other ASCII characters become a space.
_FOLD = np.full(256, 0x20, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


def grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all three-byte grams, and the first one of each text; grams of spaces alone are left out."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8)[int(bounds[0]) : int(bounds[-1])] if data is not None else np.zeros(0, np.uint8)
    bounds = bounds - bounds[0]
    b = _FOLD[data]
    upper = np.flatnonzero((b[:-1] == 0xC3) & (b[1:] >= 0x80) & (b[1:] < 0x9F)) + 1 if len(b) > 1 else np.zeros(0, np.int64)
    b[upper] += 0x20
    # A space before and after each text, so that words at its ends look as others do.
    out = np.full(len(b) + 2 * len(texts), 0x20, np.uint8)
    place = np.arange(len(b)) + np.repeat(2 * np.arange(len(texts)) + 1, np.diff(bounds))
    out[place] = b
    ends = bounds + 2 * np.arange(len(texts) + 1)
    code = out[:-2].astype(np.uint32) << 16 | out[1:-1].astype(np.uint32) << 8 | out[2:] if len(out) > 2 else np.zeros(0, np.uint32)
    good = code != 0x202020
    # Two consecutive spaces say nothing, and grams must not cross from one text into the next.
    good &= (code & 0xFFFF) != 0x2020
    good &= (code >> 8) != 0x2020
    cross = (ends[1:-1, None] - [1, 2]).reshape(-1)
    good[cross[(cross >= 0) & (cross < len(good))]] = False
    upto = np.concatenate(([0], np.cumsum(good)))
    bucket = (code[good] * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return bucket.astype(np.int64), upto[np.minimum(ends, len(good))]


@dataclass
class Model:
    """``likelihood``: probability of each bucket in each language."""

    languages: list[str]
    likelihood: np.ndarray


def count_grams(docs: DataFrame) -> DataFrame:
    """lang, bucket, n over all ``docs`` (text, lang); each task sends one row per language and bucket that it saw."""

    def run(batches):
        seen: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = column(batch, "text"), column(batch, "lang").dictionary_encode()
            names, codes = langs.dictionary.to_pylist(), langs.indices.to_numpy(zero_copy_only=False)
            for a, b in text_slices(texts):
                bucket, first = grams(texts.slice(a, b - a))
                of = np.repeat(codes[a:b], np.diff(first))
                for i in np.unique(of):
                    total = seen.setdefault(names[int(i)], np.zeros(BUCKETS, np.int64))
                    total += np.bincount(bucket[of == i], minlength=BUCKETS)
        for lang, total in seen.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(total[at])], ["lang", "bucket", "n"])

    return docs.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, smoothing: float = 0.5) -> Model:
    """Gram probabilities per language from every document with a language. What comes back is languages * BUCKETS rows at most."""
    counts = count_grams(docs.filter("lang IS NOT NULL AND text IS NOT NULL")).toPandas()
    languages = sorted(counts["lang"].unique())
    table = np.full((len(languages), BUCKETS), smoothing)
    code = counts["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(np.int64)
    np.add.at(table, (code, counts["bucket"].to_numpy(np.int64)), counts["n"].to_numpy(np.float64))
    return Model(languages, (table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def proportions(p: np.ndarray, n: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Mixture weights of languages with gram probabilities ``p`` (language x gram) for gram counts ``n``, and the log-likelihood."""
    w = np.full(len(p), 1 / len(p))
    total = n.sum()
    for _ in range(rounds):
        mixed = w @ p
        new = w * (p @ (n / mixed)) / total
        done = np.abs(new - w).max() < 1e-4
        w = new
        if done:
            break
    return w, float(n @ np.log(np.maximum(w @ p, 1e-30)))


def choose(p: np.ndarray, n: np.ndarray, penalty: float) -> tuple[list[int], np.ndarray]:
    """Languages whose presence pays for itself, and their weights.

    From all languages, the least one goes for as long as the log-likelihood falls by less than ``penalty`` * log(grams).
    """
    own = list(range(len(p)))
    w, fit = proportions(p, n)
    fee = penalty * np.log(max(n.sum(), 2))
    while len(own) > 1:
        least = int(np.argmin(w))
        rest = own[:least] + own[least + 1 :]
        w2, fit2 = proportions(p[rest], n)
        if fit - fit2 > fee:
            break
        own, w, fit = rest, w2, fit2
    return own, w


def _letters(text: str | None) -> bool:
    return bool(text) and any(c.isalpha() for c in text)


def identify(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",), penalty: float = 3.0) -> DataFrame:
    """``carry`` columns of ``docs`` with ``lang_pred``, its share of the text as ``score``, and all chosen languages with theirs.

    The prediction reads the text alone. A null text, one without a letter, and any text under a model without languages
    is ``und`` with score 0. Ties go to the language first in the alphabet.
    """
    def run(batches):
        for batch in batches:
            texts = column(batch, "text")
            for a, b in text_slices(texts):
                part = texts.slice(a, b - a)
                bucket, first = grams(part)
                ascii_letter = pc.fill_null(pc.match_substring_regex(part, "[A-Za-z]"), False).to_numpy(zero_copy_only=False)
                lang, score, all_langs, shares = [], [], [], []
                for i in range(b - a):
                    own = bucket[first[i] : first[i + 1]]
                    if not len(own) or not model.languages or not (ascii_letter[i] or _letters(part[i].as_py())):
                        lang.append(UNDETERMINED), score.append(0.0), all_langs.append([]), shares.append([])
                        continue
                    u, n = np.unique(own, return_counts=True)
                    chosen, w = choose(model.likelihood[:, u], n.astype(np.float32), penalty)
                    order = np.argsort(-w, kind="stable")
                    all_langs.append([model.languages[chosen[k]] for k in order])
                    shares.append([min(1.0, float(w[k])) for k in order])
                    lang.append(all_langs[-1][0]), score.append(shares[-1][0])
                carried = [column(batch, c).slice(a, b - a) for c in carry]
                made = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(all_langs, pa.list_(pa.string())), pa.array(shares, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays([*carried, *made], [*carry, "lang_pred", "score", "languages", "proportions"])
        release()

    own = docs.select(*dict.fromkeys([*carry, "text"]))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.select(*carry).schema.fields)
    return own.mapInArrow(run, f"{schema}, {SCHEMA}")
