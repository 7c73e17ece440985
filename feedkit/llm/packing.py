"""Packing documents into sequences by minimum bin slack.

Which lengths share a sequence depends only on how many pieces there are of each length, a histogram of at most
``capacity`` entries however large the corpus is. The histogram alone is planned on the driver: the fullest
combination around the longest length left is found by subset sums on a bitset, and repeated while its lengths last.
Pieces are then numbered within their length and take their places from the plan, all on the executors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .scratch import keep
from .tokens import encoder
from .words import column, text_slices

PIECES = "doc_id long, piece int, start long, length long, ids binary, task int, nth long"


@dataclass
class Plan:
    """Runs of equal sequences, one entry per length in a run, sorted by ``key`` = length * 2**40 + first rank served."""

    key: np.ndarray
    rank: np.ndarray  # first rank of the length that the run takes
    times: np.ndarray  # pieces of the length in each sequence
    sequence: np.ndarray  # first sequence of the run
    offset: np.ndarray  # place of the length's first piece in the sequence
    sequences: int


def _fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[tuple[int, int]]:
    """The combination of available lengths that fills ``room`` best; among equals the one with the longest pieces.

    Bit s of a set says that the lengths so far can add up to s.
    """
    reach, full = [1], (1 << (room + 1)) - 1
    used = [n for n in lengths if n <= room]
    for n in used:
        bits, left = reach[-1], min(counts[n], room // n)
        step = 1
        while left:  # doubling: any number up to the count is a sum of these steps
            take = min(step, left)
            bits |= (bits << (n * take)) & full
            left -= take
            step *= 2
        reach.append(bits)
    want, out = reach[-1].bit_length() - 1, []
    for i in range(len(used), 0, -1):
        n, times = used[i - 1], 0
        while not reach[i - 1] >> want & 1 or (times < counts[n] and want >= n and reach[i - 1] >> (want - n) & 1):
            want, times = want - n, times + 1
        if times:
            out.append((n, times))
    return out


def plan(histogram: dict[int, int], capacity: int) -> Plan:
    """Sequences for ``histogram`` (length -> pieces), fullest first around the longest length left."""
    left = {n: c for n, c in histogram.items() if c > 0}
    lengths = sorted(left)
    served = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while lengths:
        top = lengths[-1]
        left[top] -= 1
        combination = dict(_fullest(lengths, left, capacity - top))
        left[top] += 1
        combination[top] = combination.get(top, 0) + 1
        runs = min(left[n] // k for n, k in combination.items())
        offset = 0
        for n, k in sorted(combination.items(), reverse=True):
            rows.append((n, served[n], k, sequence, offset))
            offset += n * k
            served[n] += runs * k
            left[n] -= runs * k
        sequence += runs
        lengths = [n for n in lengths if left[n]]
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return Plan((table[:, 0] << 40) + table[:, 1], table[:, 1], table[:, 2], table[:, 3], table[:, 4], sequence)


def cut(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, added: bool = False) -> DataFrame:
    """Encode whole documents, add ``end_id`` and cut those over ``capacity``; the first piece takes the remainder.

    ``task`` and ``nth`` number the pieces of one length within the task that made them; written once, they stay.
    """

    def run(batches):
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        with encoder(tokenizer, added=added) as enc:
            for batch in batches:
                texts, keys = column(batch, "text"), column(batch, "doc_id")
                for a, b in text_slices(texts, 1 << 20):
                    flat, counts = enc.encode(texts.slice(a, b - a))
                    flat, counts = np.insert(flat, np.cumsum(counts), end_id).astype("<u4"), counts + 1
                    pieces = (counts + capacity - 1) // capacity
                    doc = np.repeat(np.arange(b - a), pieces)
                    piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                    head = counts - (pieces - 1) * capacity
                    length = np.where(piece == 0, head[doc], capacity)
                    start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                    ends = np.cumsum(length)
                    order = np.argsort(length, kind="stable")
                    sizes, first, many = np.unique(length[order], return_index=True, return_counts=True)
                    nth = np.empty(len(length), np.int64)
                    nth[order] = np.arange(len(length)) - np.repeat(first, many) + np.repeat(seen[sizes], many)
                    seen[sizes] += many
                    bounds = pa.py_buffer((np.concatenate(([0], ends)) * 4).astype(np.int32))
                    payload = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, bounds, pa.py_buffer(flat.tobytes())])
                    yield pa.RecordBatch.from_arrays(
                        [
                            keys.slice(a, b - a).take(pa.array(doc)).cast(pa.int64()),
                            pa.array(piece, pa.int32()),
                            pa.array(start, pa.int64()),
                            pa.array(length, pa.int64()),
                            payload,
                            pa.array(np.full(len(doc), task), pa.int32()),
                            pa.array(nth, pa.int64()),
                        ],
                        ["doc_id", "piece", "start", "length", "ids", "task", "nth"],
                    )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


@dataclass
class Packed:
    """``pieces`` (doc_id, piece, start, length, ids, task, nth) and their ``places``, linked by (task, length, nth)."""

    pieces: DataFrame
    places: DataFrame
    sequences: int


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, added: bool = False) -> Packed:
    """Give every piece of ``docs`` (doc_id, text) a ``sequence_id`` and an ``offset`` in that sequence.

    ``places`` also has the checksum of the piece's ids, as little-endian unsigned 32-bit integers. A null text is empty
    and still has its end id. Repeated doc_ids are separate documents. An empty table gives an empty result. Only
    doc_id and text are read, so other columns may have any name. With ``added`` the names of added tokens in a text
    become their ids.
    """
    pieces = keep(cut(docs, tokenizer, end_id, capacity, added), "pieces")
    counts = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    p = plan(histogram, capacity)
    upto = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("task", "length", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "nth"]

    def place(batches):
        for batch in batches:
            length = column(batch, "length").to_numpy()
            rank = column(batch, "rank").to_numpy()
            i = np.searchsorted(p.key, (length << 40) + rank, "right") - 1
            k = rank - p.rank[i]
            sequence, offset = p.sequence[i] + k // p.times[i], p.offset[i] + k % p.times[i] * length
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], [*names, "sequence_id", "offset"]
            )

    narrow = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "task", "nth")
    ranked = narrow.join(base, ["task", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    places = ranked.mapInArrow(
        place,
        "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long, sequence_id long, offset long",
    )
    return Packed(pieces, places, p.sequences)


def sequences(packed: Packed) -> DataFrame:
    """One row per sequence: its ``ids`` end to end, and the ``parts`` (offset, doc_id, start, length) in it.

    A sequence has at most ``capacity`` pieces, so no group is large.
    """
    keys = ["task", "length", "nth"]
    placed = packed.places.select(*keys, "sequence_id", "offset").join(packed.pieces, keys)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "length", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id",
        F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"),
        F.transform("p", lambda x: F.struct(*[x[c].alias(c) for c in ("offset", "doc_id", "start", "length")])).alias("parts"),
    )
