"""Quality rules: document statistics, and gradient-boosted trees over them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import keep
from .words import Texts, column, mix, ranges, text_slices

SYMBOLS = b"#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_chars_all", "n_upper", "n_digits", "n_punct", "n_distinct")
STATS = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)

#: Model features and the direction a score may move as each grows (0: free).
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols": -1,
    "dup_lines": -1,
    "repeats": -1,
    "upper": 0,
    "digits": 0,
    "punct": 0,
    "distinct": 0,
    "line_words": 0,
}


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_SYMBOL, _UPPER, _DIGIT = _table(SYMBOLS), _table(bytes(range(65, 91))), _table(bytes(range(48, 58)))
_PUNCT = _table(b".,;:!?'\"()-")


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Counts per text, over whole texts; a null text has zeros."""
    t = Texts(texts)
    docs = len(t.bounds) - 1

    def per_doc(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return np.diff(total[at])

    points = (t.data & 0xC0) != 0x80
    upto = np.concatenate(([0], np.cumsum(points)))
    chars = upto[t.ends] - upto[t.starts]
    words = t.hashes()
    owner = t.owner()
    mark = mix(owner.astype(np.uint64) + np.uint64(1))
    distinct = np.zeros(docs, np.int64)
    if len(words):
        _, one = np.unique(words ^ mark[...], return_index=True)
        distinct = np.bincount(owner[one], minlength=docs)
    at, window = t.windows(3)
    covered = np.zeros(len(words) + 1, np.int64)
    if len(at):
        _, back, many = np.unique(window ^ mark[at], return_inverse=True, return_counts=True)
        twice = at[many[back] > 1]
        for k in range(3):
            covered[twice + k] = 1
    # Lines: cut at line feeds and at document ends.
    feeds = np.flatnonzero(t.data == 10)
    ends = np.sort(np.concatenate((feeds, t.bounds[1:])))
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    starts = starts + (np.isin(starts, feeds) & (np.arange(len(starts)) > 0)) if len(starts) else starts
    has = np.searchsorted(t.starts, ends) > np.searchsorted(t.starts, starts)
    starts, ends = starts[has], ends[has]
    of = np.searchsorted(t.bounds, starts, "right") - 1
    lines = np.bincount(of, minlength=docs)
    if len(starts):
        _, one = np.unique(ranges(t.data, starts, ends, 0x9E3779B97F4A7C15) ^ mix(of.astype(np.uint64) + np.uint64(1)), return_index=True)
        unlike = np.bincount(of[one], minlength=docs)
    else:
        unlike = lines
    return {
        "n_words": t.counts,
        "word_chars": np.diff(np.concatenate(([0], np.cumsum(chars)))[t.first]),
        "n_symbols": per_doc(_SYMBOL[t.data], t.bounds),
        "n_dup_lines": lines - unlike,
        "n_repeat_words": np.diff(np.concatenate(([0], np.cumsum(covered[:-1])))[t.first]),
        "n_lines": lines,
        "n_chars_all": per_doc(points, t.bounds),
        "n_upper": per_doc(_UPPER[t.data], t.bounds),
        "n_digits": per_doc(_DIGIT[t.data], t.bounds),
        "n_punct": per_doc(_PUNCT[t.data], t.bounds),
        "n_distinct": distinct,
    }


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of its text."""

    def run(batches):
        for batch in batches:
            texts = column(batch, "text")
            for a, b in text_slices(texts):
                got = statistics(texts.slice(a, b - a))
                ids = column(batch, "doc_id").slice(a, b - a).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([ids, *[pa.array(got[c], pa.int64()) for c in COUNTS]], ["doc_id", *COUNTS])

    return docs.select("doc_id", "text").mapInArrow(run, STATS)


def features(c: dict[str, np.ndarray]) -> np.ndarray:
    """Feature matrix of counts, one column per ``FEATURES``."""
    c = {k: np.asarray(v, np.float64) for k, v in c.items()}
    words, chars, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_chars_all"], 1), np.maximum(c["n_lines"], 1)
    return np.stack(
        [
            np.log1p(c["n_words"]),
            c["word_chars"] / words,
            c["n_symbols"] / chars,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            c["n_upper"] / chars,
            c["n_digits"] / chars,
            c["n_punct"] / chars,
            c["n_distinct"] / words,
            c["n_words"] / lines,
        ],
        axis=1,
    )


@dataclass
class Trees:
    """All trees in five flat arrays; a leaf has itself as both children."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of the positive label per row."""
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit(
    x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64, least: int = 20, l2: float = 1.0
) -> Trees:
    """Boost regression trees on the logistic loss.

    A feature with a direction is split only where the children's values follow it, and each child's values stay on its
    side of the middle, so the score is monotonic in that feature over all of its range.
    """
    n, k = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    coded = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(k)], axis=1)  # bin b: x <= edges[b]
    rate_of_ones = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(rate_of_ones / (1 - rate_of_ones)))
    total = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        i = len(feature)
        feature.append(0), threshold.append(0.0), left.append(i), right.append(i), value.append(v)
        return i

    def weight(g, h):
        return -g / (h + l2)

    def grow(rows: np.ndarray, grad, hess, deep: int, lo: float, hi: float) -> int:
        g, h = grad[rows].sum(), hess[rows].sum()
        own = float(np.clip(weight(g, h), lo, hi))
        best = (1e-6, None)
        if deep < depth and len(rows) >= 2 * least:
            for j in range(k):
                size = len(edges[j]) + 1
                if size < 2:
                    continue
                code = coded[rows, j]
                gl = np.cumsum(np.bincount(code, grad[rows], size))[:-1]
                hl = np.cumsum(np.bincount(code, hess[rows], size))[:-1]
                nl = np.cumsum(np.bincount(code, minlength=size))[:-1]
                wl, wr = np.clip(weight(gl, hl), lo, hi), np.clip(weight(g - gl, h - hl), lo, hi)
                loss = lambda a, b, w: a * w + 0.5 * (b + l2) * w * w
                gain = loss(g, h, own) - loss(gl, hl, wl) - loss(g - gl, h - hl, wr)
                gain[(nl < least) | (len(rows) - nl < least) | (directions[j] * (wr - wl) < 0)] = -1
                b = int(np.argmax(gain))
                if gain[b] > best[0]:
                    best = (gain[b], (j, b, float(wl[b]), float(wr[b])))
        if best[1] is None:
            return leaf(rate * own)
        j, b, wl, wr = best[1]
        i = leaf(0.0)
        middle = (wl + wr) / 2
        down, up = ((lo, middle), (middle, hi)) if directions[j] > 0 else ((middle, hi), (lo, middle)) if directions[j] < 0 else ((lo, hi), (lo, hi))
        goes = coded[rows, j] <= b
        feature[i], threshold[i] = j, float(edges[j][b])
        left[i], right[i] = grow(rows[goes], grad, hess, deep + 1, *down), grow(rows[~goes], grad, hess, deep + 1, *up)
        return i

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(n), p - y, p * (1 - p), 0, -np.inf, np.inf))
        made = Trees(*map(np.array, (feature, threshold, left, right, value)), np.array(roots[-1:]), depth, 0.0)
        node = np.full(n, roots[-1])
        for _ in range(depth):
            node = np.where(x[np.arange(n), made.feature[node]] <= made.threshold[node], made.left[node], made.right[node])
        total += made.value[node]
    return Trees(np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), np.array(roots), depth, base)


def train(stats: DataFrame, labels: DataFrame, most: int = 20_000) -> Trees | None:
    """Fit on at most ``most`` labelled documents, those of the smallest hash of doc_id; None without both labels.

    ``labels`` has doc_id and quality (1: good). Null ids and labels are left out; a document labelled twice takes the
    smaller label. Rows of one id count as one document, the one of smallest counts.
    """
    known = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    each = stats.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct(*COUNTS)).alias("counts"))
    rows = each.select("quality", "doc_id", "counts.*").toPandas()  # ``most`` rows at most
    rows = rows.sort_values("doc_id")
    y = (rows["quality"].to_numpy() > 0).astype(float)
    if not len(y) or y.min() == y.max():
        return None
    return fit(features({c: rows[c].to_numpy() for c in COUNTS}), y, list(FEATURES.values()))


def rate(docs: DataFrame, labels: DataFrame, most: int = 20_000, least: float = 0.5) -> DataFrame:
    """Statistics, ``base_failed``, ``score`` and ``kept`` per document.

    ``base_failed``: under 50 words, or more than half of the words in repeated three-word windows. A document is kept
    if it passes that and the model's probability of good quality is ``least`` or more; without labels of both kinds
    there is no model, scores are null and the base rules decide. Null and empty texts have no words and fail.
    """
    stats = keep(document_statistics(docs), "statistics")
    model = train(stats, labels, most)
    names = ["doc_id", *COUNTS]

    def score(batches):
        for batch in batches:
            x = features({c: column(batch, c).to_numpy() for c in COUNTS})
            p = pa.array(model.score(x)) if model else pa.nulls(batch.num_rows, pa.float64())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], p], [*names, "score"])

    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = stats.mapInArrow(score, STATS + ", score double").withColumn("base_failed", failed)
    return scored.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= least, F.lit(True)))
