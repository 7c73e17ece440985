"""Token ids in directly addressable codes.

An id is split into bytes, lowest first. Level 0 holds the first byte of every id; a bitmap tells which ids go on, and
level 1 holds the second bytes of those alone, and so on. A rank directory counts the set bits before every 512th
position, so the place of any id's next byte is one lookup and a few bit counts away: any token is read without
decoding those before it. Segments of whole documents are rows of a Parquet table, in ascending document order.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tokens import encoder
from .words import column, text_slices

BLOCK = 512  # bits between two entries of a rank directory
SEGMENT_TOKENS = 1 << 18
STRETCH = 1 << 16  # ids of a segment whose requests are gathered together

SCHEMA = (
    "part int, segment int, first long, size long, doc_ids array<long>, lengths array<long>, "
    "levels array<binary>, more array<binary>, ranks array<binary>"
)


def encode(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """Levels, continuation bitmaps and rank directories of ids below 2**32."""
    levels, more, ranks = [], [], []
    rest = np.asarray(ids, np.uint32)
    while True:
        levels.append((rest & np.uint32(0xFF)).astype(np.uint8).tobytes())
        rest = rest >> np.uint32(8)
        goes_on = rest > 0
        bits = np.packbits(goes_on, bitorder="little")
        more.append(bits.tobytes())
        per = np.add.reduceat(goes_on, np.arange(0, len(goes_on), BLOCK), dtype=np.int64) if len(goes_on) else np.zeros(0, np.int64)
        ranks.append((np.cumsum(per) - per).astype(np.uint32).tobytes())
        rest = rest[goes_on]
        if not len(rest):
            return levels, more, ranks


def decode(levels: list[bytes], more: list[bytes]) -> np.ndarray:
    """All ids of a segment."""
    out = None
    for level, bits in zip(reversed(levels), reversed(more)):
        here = np.frombuffer(level, np.uint8).astype(np.uint32)
        if out is not None:
            on = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(here), bitorder="little").astype(bool)
            here[on] |= out << np.uint32(8)
        out = here
    return out


def token_at(levels: list[bytes], more: list[bytes], ranks: list[bytes], at: int) -> int:
    """One id, by rank alone."""
    value = 0
    for depth, (level, bits, rank) in enumerate(zip(levels, more, ranks)):
        value |= level[at] << (8 * depth)
        if not bits[at >> 3] >> (at & 7) & 1:
            break
        lo = at // BLOCK * (BLOCK // 8)
        before = int.from_bytes(bits[lo : at >> 3], "little").bit_count() + (bits[at >> 3] & ((1 << (at & 7)) - 1)).bit_count()
        at = int.from_bytes(rank[at // BLOCK * 4 : at // BLOCK * 4 + 4], "little") + before
    return value


def tokens_at(levels: list[bytes], more: list[bytes], ranks: list[bytes], at: np.ndarray) -> np.ndarray:
    """Many ids of a segment, by rank alone; ``at`` in any order."""
    value, own = np.zeros(len(at), np.int64), np.arange(len(at))
    for depth, (level, bits, rank) in enumerate(zip(levels, more, ranks)):
        value[own] |= np.frombuffer(level, np.uint8)[at].astype(np.int64) << (8 * depth)
        packed = np.frombuffer(bits, np.uint8)
        on = (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
        own, at = own[on], at[on]
        if not len(at):
            break
        # Set bits before each place: those of its block's whole bytes, then those of its own byte.
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)))
        block = at // BLOCK
        before = ones[at >> 3] - ones[block * (BLOCK // 8)]
        before += np.bitwise_count(packed[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8))
        at = np.frombuffer(rank, "<u4").astype(np.int64)[block] + before
    return value


def _segments(tokenizer: str, end_id: int | None, segment_tokens: int, added: bool):
    def run(batches):
        from pyspark import TaskContext

        part, done, first = TaskContext.get().partitionId(), 0, 0
        docs, lengths, ids, held = [], [], [], 0

        def flush():
            nonlocal docs, lengths, ids, held, done, first
            levels, more, ranks = encode(np.concatenate(ids) if ids else np.zeros(0, np.uint32))
            row = dict(part=part, segment=done, first=first, size=held, doc_ids=docs, lengths=lengths, levels=levels, more=more, ranks=ranks)
            done, first = done + 1, first + held
            docs, lengths, ids, held = [], [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        with encoder(tokenizer, reuse=True, added=added) as enc:
            for batch in batches:
                texts, keys = column(batch, "text"), column(batch, "doc_id").to_pylist()
                for a, b in text_slices(texts, 1 << 21):
                    flat, counts = enc.encode(texts.slice(a, b - a))
                    if end_id is not None:
                        flat, counts = np.insert(flat, np.cumsum(counts), end_id), counts + 1
                    docs += keys[a:b]
                    lengths += counts.tolist()
                    ids.append(flat)
                    held += len(flat)
                    if held >= segment_tokens:
                        yield flush()
        if docs:
            yield flush()

    return run


_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("segment", pa.int32()),
        ("first", pa.int64()),
        ("size", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("levels", pa.list_(pa.binary())),
        ("more", pa.list_(pa.binary())),
        ("ranks", pa.list_(pa.binary())),
    ]
)


def write_store(
    docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 0, segment_tokens: int = SEGMENT_TOKENS, added: bool = False
) -> None:
    """Encode ``docs`` (doc_id, text; other columns are not read) and write the store to ``path``.

    One range exchange puts the documents in ascending order of doc_id, null first; rows of equal doc_id are ordered by
    a hash of their text, so that many rows of one id still spread. A null text is empty and has the end id alone. An
    empty table gives an empty store. With ``added`` the names of added tokens in a text become their ids.
    """
    tie = F.xxhash64("text")
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    ordered.mapInArrow(_segments(tokenizer, end_id, segment_tokens, added), SCHEMA).write.option("compression", "zstd").parquet(path)


def read_store(spark, path: str) -> DataFrame:
    """Segments with ``start``, the number of ids in all segments before.

    The parts' totals are summed up in one row per part of the write, a number the write's partitioning bounds.
    """
    store = spark.read.schema(SCHEMA).parquet(path)
    parts = store.groupBy("part").agg(F.sum("size").alias("total"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("total").over(upto), F.lit(0)).alias("base"))
    return store.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("first"))


def read_documents(spark, path: str) -> DataFrame:
    """doc_id, start, and ``ids`` as little-endian unsigned 32-bit integers, for every document of a store."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = decode(row["levels"], row["more"]).astype("<u4")
                ends = np.cumsum(row["lengths"])
                starts = ends - np.array(row["lengths"], np.int64)
                raw, bounds = ids.tobytes(), pa.py_buffer((np.concatenate((starts[:1], ends)) * 4).astype(np.int32))
                payload = pa.BinaryArray.from_buffers(pa.binary(), len(ends), [None, bounds, pa.py_buffer(raw)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(row["start"] + starts, pa.int64()), payload], ["doc_id", "start", "ids"]
                )

    return read_store(spark, path).select("start", "doc_ids", "lengths", "levels", "more").mapInArrow(run, "doc_id long, start long, ids binary")


def _spans(batches):
    """Where the documents of a segment lie in it: part, segment, doc_id, n, lead."""
    for batch in batches:
        for row in batch.to_pylist():
            n = np.array(row["lengths"], np.int64)
            same = [pa.array(np.full(len(n), row[c], np.int32)) for c in ("part", "segment")]
            yield pa.RecordBatch.from_arrays(
                [*same, pa.array(row["doc_ids"], pa.int64()), pa.array(n), pa.array(np.cumsum(n) - n)], ["part", "segment", "doc_id", "n", "lead"]
            )


def read_tokens(spark, path: str, wanted: DataFrame) -> DataFrame:
    """``wanted`` (doc_id, at) with ``token``, the at-th id of the document; null where it has none.

    Requests, each once, are gathered by segment and stretch of it and read by rank, without decoding the segment; a
    stretch bounds how many come together. Of documents with one doc_id each gives its own token. Repeated requests are
    answered each; null ones get a null.
    """
    store = read_store(spark, path)
    spans = store.select("part", "segment", "doc_ids", "lengths").mapInArrow(_spans, "part int, segment int, doc_id long, n long, lead long")
    asked = wanted.select("doc_id", "at").distinct().join(spans, "doc_id").filter("at >= 0 AND at < n")
    inside = asked.select("part", "segment", "doc_id", "at", (F.col("lead") + F.col("at")).alias("place"))

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        lists = [pa.array([column(table, c).to_numpy().astype("<i8").tobytes()], pa.binary()) for c in ("doc_id", "at", "place")]
        return pa.table([pa.array([k.as_py()], pa.int32()) for k in key[:2]] + lists, names=["part", "segment", "doc_ids", "ats", "places"])

    stretch = F.floor(F.col("place") / STRETCH).alias("stretch")
    gathered = inside.groupBy("part", "segment", stretch).applyInArrow(gather, "part int, segment int, doc_ids binary, ats binary, places binary")
    joined = gathered.join(store.select("part", "segment", "levels", "more", "ranks"), ["part", "segment"])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                r = batch.slice(i, 1).to_pylist()[0]
                ids, ats, places = (np.frombuffer(r[c], "<i8") for c in ("doc_ids", "ats", "places"))
                got = tokens_at(r["levels"], r["more"], r["ranks"], places)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ats), pa.array(got)], ["doc_id", "at", "token"])

    columns = ["part", "segment", "levels", "more", "ranks", "doc_ids", "ats", "places"]
    found = joined.select(*columns).mapInArrow(run, "doc_id long, at long, token long")
    return wanted.select("doc_id", "at").join(found, ["doc_id", "at"], "left")


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
