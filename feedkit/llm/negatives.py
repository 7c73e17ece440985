"""Hard negatives by an inverted multi-index that is searched until the result is certain.

Vectors are halved, and each half has a codebook; a pair of codewords is a cell. A vector's score with a query is at
most the score of its codeword plus the codeword's radius times the query's length, in each half. The queries visit
cells in falling order of the sum of the two half bounds, which a heap over the two sorted codebooks gives without
listing all cells, and stop when the next cell's bound lies below what every window of scores still needs: what was not
visited then can't be in the result. Codebooks are fitted on a bounded sample, every row is indexed, scores are exact.

On Spark the cells are laid out in groups of a bounded number of rows, large cells over several. In each round the open
queries ask for their next cells, requests meet the groups, and only the best few rows per query and window come back;
a round visits eight times as many rows per query as the one before.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .chunks import packed, unpacked
from .scratch import keep, keep_bucketed
from .words import column, mix, release

CODEWORDS = 32  # per half; at most their square in cells
SAMPLE = 20_000  # rows that the codebooks are fitted on
GROUP_ROWS = 8192  # rows of a group of cells, about
FIRST_ROWS = 4096  # rows that a query visits in the first round
TOGETHER = 2048  # queries in one request to a group, about
ANY = 1 << 62

OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


class Index(NamedTuple):
    """What every search needs to know of the index; its size depends on the number of codewords only."""

    books: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray  # per pair of codewords
    base: np.ndarray  # first group of a cell
    parts: np.ndarray  # groups that a cell is spread over
    dtype: str  # of components
    exact: bool  # whether float64 holds every score
    half: int

    def cells(self, vector: np.ndarray) -> Iterator[tuple[float, int]]:
        """(bound, cell) in falling order of the bound, from a heap of the next pairs of codewords."""
        sums = []
        for book, radius, part in zip(self.books, self.radii, (vector[: self.half], vector[self.half :])):
            part = part.astype(np.float64)
            bound = book @ part + radius * np.sqrt(part @ part)
            order = np.argsort(-bound, kind="stable")
            sums.append((bound[order].tolist(), order.tolist()))
        (one, first), (two, second) = sums
        width = len(second)
        heap = [(-(one[0] + two[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            yield -bound, first[i] * width + second[j]
            if j + 1 < len(two):
                heapq.heappush(heap, (-(one[i] + two[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(one):
                heapq.heappush(heap, (-(one[i + 1] + two[0]), i + 1, 0))


def _fit(sample: np.ndarray, codewords: int, seed: int) -> np.ndarray:
    """Codewords of one half by Lloyd's rounds."""
    distinct = np.unique(sample, axis=0).astype(np.float64)
    rng = np.random.default_rng(seed)
    book = distinct[rng.permutation(len(distinct))[:codewords]]
    data = sample.astype(np.float64)
    for _ in range(8):
        near = _nearest(data, book)[0]
        counts = np.bincount(near, minlength=len(book))
        sums = np.zeros_like(book)
        np.add.at(sums, near, data)
        book = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], book)
    return book


def _nearest(data: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest codeword and the distance to it."""
    near = np.argmin((book * book).sum(1)[None, :] - 2 * (data @ book.T), axis=1)
    return near, np.sqrt(((data - book[near]) ** 2).sum(1))


def _matrix(values: pa.Array, dtype: str) -> np.ndarray:
    """Binary vectors of one length as a matrix."""
    data = b"".join(values.to_pylist())
    return np.frombuffer(data, dtype).reshape(len(values), -1)


def _assign(books: tuple[np.ndarray, np.ndarray], half: int, dtype: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, GROUP_ROWS):
                batch = whole.slice(at, GROUP_ROWS)
                lists = column(batch, "q")
                q = lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                (c1, d1), (c2, d2) = _nearest(q[:, :half].astype(np.float64), books[0]), _nearest(q[:, half:].astype(np.float64), books[1])
                coded = pa.array([row.tobytes() for row in np.ascontiguousarray(q.astype(dtype))], pa.binary())
                kept = [batch.column(n) for n in ("ref", "vec_id", "label")]
                cells = [pa.array(c1.astype(np.int32)), pa.array(c2.astype(np.int32)), pa.array(d1), pa.array(d2)]
                yield pa.RecordBatch.from_arrays([*kept, coded, *cells], names=["ref", "vec_id", "label", "q", "c1", "c2", "d1", "d2"])

    return run


def _layout(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First group and number of groups of every cell: small cells share one, large ones are spread."""
    base, parts = np.zeros(len(counts), np.int64), np.ones(len(counts), np.int64)
    group, room = 0, GROUP_ROWS
    for cell, n in enumerate(counts.tolist()):
        if n > GROUP_ROWS:
            base[cell], parts[cell] = group + 1, -(-n // GROUP_ROWS)
            group, room = group + int(parts[cell]) + 1, GROUP_ROWS
            continue
        if n > room:
            group, room = group + 1, GROUP_ROWS
        base[cell] = group
        room -= n
    return base, parts


def _build(rows: DataFrame, dims: int, top: int) -> tuple[Index, DataFrame]:
    """The index, and its groups as a table (group, blob)."""
    half = dims // 2
    dtype = "<i2" if top < 1 << 15 else "<i4"
    chosen = rows.select("q", F.xxhash64("ref").alias("_at")).orderBy("_at").limit(SAMPLE).toArrow()
    sample = column(chosen, "q").flatten().to_numpy(zero_copy_only=False).reshape(chosen.num_rows, -1)
    books = _fit(sample[:, :half], CODEWORDS, 1), _fit(sample[:, half:], CODEWORDS, 2)
    coded = keep(rows.mapInArrow(_assign(books, half, dtype), "ref long, vec_id long, label long, q binary, c1 int, c2 int, d1 double, d2 double"), "cells")
    width = len(books[1])
    # At most CODEWORDS ** 2 rows come back.
    seen = coded.groupBy("c1", "c2").agg(F.count("*").alias("n"), F.max("d1").alias("d1"), F.max("d2").alias("d2")).toArrow().to_pylist()
    radii, counts = (np.zeros(len(books[0])), np.zeros(width)), np.zeros(len(books[0]) * width, np.int64)
    for r in seen:
        counts[r["c1"] * width + r["c2"]] = r["n"]
        radii[0][r["c1"]], radii[1][r["c2"]] = max(radii[0][r["c1"]], r["d1"]), max(radii[1][r["c2"]], r["d2"])
    base, parts = _layout(counts)
    index = Index(books, radii, counts, base, parts, dtype, dims * top * top < 1 << 53, half)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = column(batch, "c1").to_numpy().astype(np.int64) * width + column(batch, "c2").to_numpy()
            spread = mix(column(batch, "ref").to_numpy().astype(np.uint64)) % parts[cell].astype(np.uint64)
            kept = [batch.column(n) for n in ("ref", "vec_id", "label", "q")]
            yield pa.RecordBatch.from_arrays([pa.array(base[cell] + spread.astype(np.int64)), pa.array(cell), *kept], names=["group", "cell", "ref", "vec_id", "label", "q"])

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([packed(table.drop_columns(["group"]))], pa.binary())], names=["group", "blob"])

    placed = coded.mapInArrow(place, "group long, cell long, ref long, vec_id long, label long, q binary")
    return index, keep_bucketed(placed.groupBy("group").applyInArrow(pack, "group long, blob binary"), "group", "cell_groups")


ASKED = "group long, query long, label long, q binary, cells binary, his array<bigint>, floors array<bigint>, popped long, bound double"


def _ask(index: Index, budget: int):
    """For every open query one row per group with the cells to visit there, and one (group -1) with how far it has come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                vector = np.frombuffer(r["q"], index.dtype)
                need, popped, visited, asked, bound = min(r["floors"]), 0, 0, {}, -np.inf
                for bound, cell in index.cells(vector):
                    bound += 1 + 1e-9 * abs(bound)  # rounding must not cut off a cell
                    if popped >= r["popped"]:
                        if bound < need or visited >= budget:
                            break
                        if index.rows[cell]:
                            visited += int(index.rows[cell])
                            for g in range(int(index.base[cell]), int(index.base[cell] + index.parts[cell])):
                                asked.setdefault(g, []).append(cell)
                    popped += 1
                else:
                    bound = -np.inf
                same = dict(query=r["query"], label=r["label"], his=r["his"], floors=r["floors"], q=r["q"])
                out += [same | dict(group=g, cells=np.array(c, "<i4").tobytes()) for g, c in asked.items()]
                out.append(same | dict(group=-1, popped=popped, bound=float(bound)))
            yield pa.RecordBatch.from_pylist(out, _ASKED)

    return run


_ASKED = pa.schema(
    [("group", pa.int64()), ("query", pa.int64()), ("label", pa.int64()), ("q", pa.binary()), ("cells", pa.binary())]
    + [("his", pa.list_(pa.int64())), ("floors", pa.list_(pa.int64())), ("popped", pa.int64()), ("bound", pa.float64())]
)
FOUND = "query long, hi long, score long, vec_id long, ref long"


def _score(index: Index, same_label: bool, best: int):
    """The best rows per query and window among the asked cells of a group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, asked in zip(column(batch, "blob"), column(batch, "asked")):
                rows, asks = unpacked(blob.as_py()), unpacked(asked.as_py())
                number = np.float64 if index.exact else np.int64
                data = _matrix(column(rows, "q"), index.dtype).astype(number)
                cell, label, ids, refs = (column(rows, n).to_numpy() for n in ("cell", "label", "vec_id", "ref"))
                out = []
                for at in range(0, asks.num_rows, 128):
                    part = asks.slice(at, 128)
                    scores = (_matrix(column(part, "q"), index.dtype).astype(number) @ data.T).astype(np.int64)
                    for s, r in zip(scores, part.select(["query", "label", "cells", "his", "floors"]).to_pylist()):
                        wanted = np.zeros(len(index.rows), bool)
                        wanted[np.frombuffer(r["cells"], "<i4")] = True
                        usable = np.flatnonzero(wanted[cell] & ((label == r["label"]) == same_label))
                        for hi, floor in zip(r["his"], r["floors"]):
                            i = usable[(s[usable] <= hi) & (s[usable] >= floor)]
                            if len(i) > best:
                                i = i[s[i] >= np.partition(s[i], len(i) - best)[len(i) - best]]
                            i = i[np.lexsort((refs[i], ids[i], -s[i]))[:best]]
                            out.append((np.full(len(i), r["query"]), np.full(len(i), hi), s[i], ids[i], refs[i]))
                arrays = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)]
                yield pa.RecordBatch.from_arrays(arrays, names=["query", "hi", "score", "vec_id", "ref"])
        release()

    return run


def _search(index: Index, groups: DataFrame, queries: DataFrame, windows: DataFrame, same_label: bool, best: int) -> DataFrame:
    """The ``best`` rows of every query (query, label, q) and window (query, hi, lo), certain ones only: query, hi, score, vec_id, ref."""
    spark = queries.sparkSession
    found = spark.createDataFrame([], FOUND)
    floors = windows.select("query", "hi", F.col("lo").alias("floor"))
    budget, state = FIRST_ROWS, queries.select("query", "label", "q", F.lit(0).cast("long").alias("popped"))

    def listed(floors: DataFrame) -> DataFrame:
        ends = floors.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("hi", "floor"))).alias("w"))
        return ends.select("query", F.col("w.hi").alias("his"), F.col("w.floor").alias("floors"))

    while True:
        asked = keep(state.join(listed(floors), "query").mapInArrow(_ask(index, budget), ASKED), "asked")
        asks = asked.filter("group >= 0")
        n = asks.count()
        if not n:
            return found
        spread = -(-n // (TOGETHER * max(1, int(index.base.max()) + 1)))

        def pack(key: tuple, table: pa.Table) -> pa.Table:
            blob = packed(table.select(["query", "label", "q", "cells", "his", "floors"]))
            return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([blob], pa.binary())], names=["group", "asked"])

        packs = asks.groupBy("group", F.pmod(F.xxhash64("query"), F.lit(spread)).alias("_part")).applyInArrow(pack, "group long, asked binary")
        scored = packs.join(groups, "group").select("blob", "asked").mapInArrow(_score(index, same_label, best), FOUND)
        order = Window.partitionBy("query", "hi").orderBy(F.desc("score"), "vec_id", "ref")
        ranked = found.unionAll(scored).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= best)
        found = keep(ranked.drop("_n"), "found")
        full = found.groupBy("query", "hi").agg(F.count("*").alias("n"), F.min("score").alias("least")).filter(F.col("n") == best)
        floors = windows.join(full, ["query", "hi"], "left").select("query", "hi", F.coalesce("least", "lo").alias("floor"))
        need = floors.groupBy("query").agg(F.min("floor").alias("need"))
        # A cell whose bound equals the need may hold a tie of smaller id, so it is visited too.
        state = asked.filter("group < 0").join(need, "query").filter(F.col("bound") >= F.col("need")).select("query", "label", "q", "popped")
        budget *= 8


def mine(
    rows: DataFrame,
    is_anchor: Column | str,
    *,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
) -> DataFrame:
    """Hard negatives of every anchor and each of its first ``positives`` rows of the same label.

    A component ``x`` counts as ``floor(scale * x)``, a row's score is its exact inner product with the anchor; higher
    scores come first, ties by smaller id. For each positive the first ``negatives`` rows of another label follow whose
    score lies between ``low`` percent of the positive's and all of it: anchor_id, positive_id, rank (from 1),
    negative_id, positive_score, negative_score. A pair without such a row, and so every positive of negative score,
    gives no row.

    Rows with a null id, label or vector, with a null or non-finite component, or with another number of components than
    most rows take no part. Repeated rows are rows of their own: a copy of an anchor may be its positive, and each copy
    of an anchor gives its own rows. Of equal vectors with one label only ``max(positives + 1, negatives)`` of smallest
    id are indexed, as no result holds more, and equal anchors are searched once. Other columns are ignored. An empty
    table gives an empty one. Components of 2 ** 31 and more, and scores that may pass 64 bits, raise ValueError.
    """
    spark = rows.sparkSession
    anchor = F.expr(is_anchor) if isinstance(is_anchor, str) else is_anchor
    usable = rows.select(
        F.col(id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(anchor, F.lit(False)).alias("is_anchor")
    ).filter("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    usable = usable.filter(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    every = keep(usable.select(F.monotonically_increasing_id().alias("ref"), "vec_id", "label", "is_anchor", F.transform("v", lambda x: F.floor(x * scale)).alias("q")), "vectors")
    ends = F.min(F.array_min("q")).alias("low"), F.max(F.array_max("q")).alias("high")
    common = every.groupBy(F.size("q").alias("dims")).agg(F.count("*").alias("n"), *ends).orderBy(F.desc("n"), F.desc("dims")).first()
    if common is None:
        return spark.createDataFrame([], OUT)
    dims, top = common["dims"], max(abs(common["low"]), abs(common["high"]))
    if top >= 1 << 31 or dims * top * top >= 1 << 63:
        raise ValueError("scores of these vectors may not fit in 64 bits")
    every = every.filter(F.size("q") == dims).withColumn("q", F.col("q").cast("array<int>"))

    first = Window.partitionBy("label", "q").orderBy("vec_id", "ref")
    distinct = every.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= max(positives + 1, negatives))
    index, groups = _build(keep(distinct.select("ref", "vec_id", "label", "q"), "distinct_vectors"), dims, top)

    anchors = every.filter("is_anchor").select("ref", "vec_id", "label", "q")
    heads = keep(anchors.groupBy("label", "q").agg(F.min("ref").alias("query")), "queries")
    asking = keep(anchors.join(heads, ["label", "q"]).select("ref", F.col("vec_id").alias("anchor_id"), "query"), "anchors")
    dtype = index.dtype

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = [np.array(v, dtype).tobytes() for v in column(batch, "q").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("label"), pa.array(q, pa.binary())], names=["query", "label", "q"])

    queries = keep(heads.select("query", "label", "q").mapInArrow(coded, "query long, label long, q binary"), "coded_queries")
    own = _search(index, groups, queries, queries.select("query", F.lit(ANY).alias("hi"), F.lit(-ANY).alias("lo")), True, positives + 1)
    least = F.expr(f"(score * {low} + 99) div 100")
    windows = own.filter("score >= 0").select("query", F.col("score").alias("hi"), least.alias("lo")).distinct()
    windows = keep(windows, "windows")
    others = _search(index, groups, queries, windows, False, negatives)

    def best(found: DataFrame, by: list[str], to: str) -> DataFrame:
        return found.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("down"), "vec_id", "ref"))).alias(to))

    own_lists = keep(best(own, ["query"], "own"), "positives")
    other_lists = keep(best(others, ["query", "hi"], "others"), "negatives")
    pairs = asking.join(own_lists, "query").select("query", "anchor_id", F.explode(F.slice(F.filter("own", lambda p: p["ref"] != F.col("ref")), 1, positives)).alias("p"))
    pairs = pairs.select("query", "anchor_id", F.col("p.vec_id").alias("positive_id"), (-F.col("p.down")).alias("hi"))
    full = pairs.join(other_lists, ["query", "hi"]).select("anchor_id", "positive_id", F.col("hi").alias("positive_score"), F.posexplode("others").alias("at", "o"))
    return full.select(
        "anchor_id", "positive_id", (F.col("at") + 1).alias("rank"), F.col("o.vec_id").alias("negative_id"), "positive_score", (-F.col("o.down")).alias("negative_score")
    )
