"""Removal of repeated word windows, with a count-min sketch before the exact count.

Every chunk of documents sends the cells of its windows to the sketch, whose blocks add up what all chunks sent; a
window whose cells all reach two may stand in two documents, any other does not. Only those are grouped exactly, by a
128-bit hash. The sketch never counts too little, so no repeated window is lost.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import REPLY, by_block, each_chunk, pack_gaps, place_replies, reply_table, unpack_gaps, with_replies, write_chunks
from .scratch import keep
from .words import BASES, Texts, column, mix, ranges, text_slices

ROWS = 2  # sketch rows
BLOCK_BITS = 20  # cells of a block
CELLS_PER_WINDOW = 4
_SALT = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)
LOWEST = -(1 << 63)

COPY, CELLS, FIRST, ORDER = 0, 1, 2, 3  # kinds of replies
MESSAGE = "block long, chunk long, cells binary, twice binary"


def _ids(table: pa.Table) -> np.ndarray:
    return column(table, "doc_id").cast(pa.int64()).fill_null(LOWEST).to_numpy(zero_copy_only=False)


class Windows:
    """Distinct windows of a chunk's documents, copies left out.

    ``key``: ascending first halves of the hashes; ``check``: second halves; ``least``: smallest doc_id with the window;
    ``several``: whether two documents of the chunk have it. ``of``, ``doc`` and ``at``: distinct window, document and
    first word (counted in the document) of every window. Row numbers of ``replies`` stand in for doc_ids.
    """

    def __init__(self, table: pa.Table, size: int, replies: list[dict]):
        texts, ids = column(table, "text"), _ids(table)
        for r in replies:
            if r["kind"] == ORDER:
                ids = np.frombuffer(r["data"], "<i8")
        use = np.ones(len(texts), bool)
        use[_copies(replies)] = False
        self.n_words = np.zeros(len(texts), np.int64)
        key, check, doc, at = [], [], [], []
        for a, b in text_slices(texts):
            t = Texts(texts.slice(a, b - a))
            self.n_words[a:b] = t.counts
            words, begin = t.hashes(), t.window_starts(size)
            owner = t.owner()[begin]
            keep_ = use[a:b][owner]
            begin, owner = begin[keep_], owner[keep_]
            key.append(ranges(words, begin, begin + size, BASES[0]))
            check.append(ranges(words, begin, begin + size, BASES[1]))
            doc.append((owner + a).astype(np.int32))
            at.append((begin - t.first[owner]).astype(np.int32))
        key, check, doc, at = (np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((key, np.uint64), (check, np.uint64), (doc, np.int32), (at, np.int32)))
        order = np.argsort(key, kind="stable")
        key, self.doc, self.at = key[order], doc[order], at[order]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        self.key, self.check = key[first], check[order][first]
        own = ids[self.doc]
        if len(first):
            self.least = np.minimum.reduceat(own, first)
            last = np.append(first[1:], len(key)) - 1
            self.several = self.doc[first] != self.doc[last]  # documents ascend within a key
        else:
            self.least, self.several = np.zeros(0, np.int64), np.zeros(0, bool)
        self.ids = ids

    def cells(self, row: int, bits: int) -> np.ndarray:
        return (mix(self.key ^ np.uint64(_SALT[row])) >> np.uint64(64 - bits)).astype(np.int64)


def _copies(replies: list[dict]) -> np.ndarray:
    got = [np.frombuffer(r["data"], "<i4") for r in replies if r["kind"] == COPY]
    return np.concatenate(got) if got else np.zeros(0, np.int32)


def find_copies(chunks: DataFrame, by_row: bool = False) -> DataFrame:
    """Replies with the documents whose whole text also is that of a document of smaller doc_id.

    ``by_row``: every row has a number of its own, ascending with doc_id, then the text's hash, which stands in for its
    doc_id; replies of kind ``ORDER`` hold the numbers of each chunk's rows.
    """

    def digest(chunk: int, table: pa.Table) -> pa.Table:
        texts, out = column(table, "text"), []
        for a, b in text_slices(texts):
            t = Texts(texts.slice(a, b - a))
            out.append([ranges(t.data, t.bounds[:-1], t.bounds[1:], base).view(np.int64) for base in BASES])
        n = len(texts)
        both = [np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(2)]
        return pa.table(
            [pa.array(np.full(n, chunk)), pa.array(np.arange(n), pa.int32()), pa.array(_ids(table)), pa.array(both[0]), pa.array(both[1])],
            names=["chunk", "i", "doc_id", "a", "b"],
        )

    texts = keep(each_chunk(chunks, digest, "chunk long, i int, doc_id long, a long, b long"), "text-digests")
    if by_row:
        order = ["doc_id", "a", "b", "chunk", "i"]
        ordered = texts.repartitionByRange(*order).sortWithinPartitions(*order)
        texts = keep(ordered.withColumn("doc_id", F.monotonically_increasing_id()), "row-order")
    first = texts.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter("first < last").drop("last")
    later = texts.join(first, ["a", "b"]).filter("doc_id > first")
    replies = place_replies(later, COPY)

    def numbers(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(column(table, "i").to_numpy())
        data = column(table, "doc_id").to_numpy()[order].astype("<i8").tobytes()
        return reply_table([key[0].as_py()], ORDER, [0], [data], [None])

    if by_row:
        replies = replies.unionAll(texts.select("chunk", "i", "doc_id").groupBy("chunk").applyInArrow(numbers, REPLY))
    return keep(replies, "copies")


def sketch(chunks: DataFrame, copies: DataFrame, size: int, bits: int) -> DataFrame:
    """Replies that tell, cell by cell in the order sent, which of a chunk's cells add up to two or more."""
    low = (1 << min(BLOCK_BITS, bits)) - 1

    def send(chunk: int, table: pa.Table, replies: list[dict]) -> pa.Table:
        w = Windows(table, size, replies)
        rows = []
        for row in range(ROWS):
            cells, back = np.unique(w.cells(row, bits), return_inverse=True)
            counts = np.bincount(back, weights=1 + w.several, minlength=len(cells)) if len(cells) else np.zeros(0)
            for block, s in by_block(cells >> BLOCK_BITS):
                rows.append(((block * ROWS + row), chunk, pack_gaps(cells[s] & low), np.packbits(counts[s] > 1).tobytes()))
        cols = list(zip(*rows)) if rows else [[], [], [], []]
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.binary())], names=["block", "chunk", "cells", "twice"])

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        counts = np.zeros(low + 1, np.uint8)
        sent = []
        for cells, twice in zip(column(table, "cells"), column(table, "twice")):
            at = unpack_gaps(cells.as_py())
            sent.append(at)
            counts[at] = np.minimum(counts[at] + 1 + np.unpackbits(np.frombuffer(twice.as_py(), np.uint8), count=len(at)), 2)
        data = [np.packbits(counts[at] > 1).tobytes() for at in sent]
        n = len(data)
        return reply_table(column(table, "chunk").to_pylist(), CELLS, [key[0].as_py()] * n, data, [None] * n)

    return with_replies(chunks, copies, send, MESSAGE).groupBy("block").applyInArrow(merge, REPLY)


def _repeated(w: Windows, replies: list[dict], bits: int) -> np.ndarray:
    """Distinct windows that the sketch counts twice or more in every row."""
    said = {r["block"]: r["data"] for r in replies if r["kind"] == CELLS}
    out = np.ones(len(w.key), bool)
    for row in range(ROWS):
        cells, back = np.unique(w.cells(row, bits), return_inverse=True)
        hit = np.zeros(len(cells), bool)
        for block, s in by_block(cells >> BLOCK_BITS):
            hit[s] = np.unpackbits(np.frombuffer(said[block * ROWS + row], np.uint8), count=s.stop - s.start).astype(bool)
        out &= hit[back]
    return out


def exact(chunks: DataFrame, copies: DataFrame, cells: DataFrame, size: int, bits: int) -> DataFrame:
    """Replies with the windows of a chunk that a document of smaller doc_id has elsewhere, and the smallest such doc_id."""
    high = max(0, bits - 22)

    def send(chunk: int, table: pa.Table, replies: list[dict]) -> pa.Table:
        w = Windows(table, size, replies)
        at = np.flatnonzero(_repeated(w, replies, bits))
        key, check, least = w.key[at], w.check[at], w.least[at]
        rows = [
            (block, chunk, key[s].tobytes(), check[s].tobytes(), least[s].tobytes())
            for block, s in by_block((key >> np.uint64(64 - high)).astype(np.int64) if high else np.zeros(len(key), np.int64))
        ]
        cols = list(zip(*rows)) if rows else [[]] * 5
        return pa.table([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), *[pa.array(c, pa.binary()) for c in cols[2:]]], names=["block", "chunk", "key", "check", "least"])

    def merge(group: tuple, table: pa.Table) -> pa.Table:
        kinds = (("key", np.uint64), ("check", np.uint64), ("least", np.int64))
        key, check, least = (np.concatenate([np.frombuffer(x.as_py(), kind) for x in column(table, c)]) for c, kind in kinds)
        sent = [len(x.as_py()) // 8 for x in column(table, "key")]
        order = np.lexsort((check, key))
        new = np.ones(len(key), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (check[order][1:] != check[order][:-1])
        lowest = np.empty(len(key), np.int64)
        lowest[order] = np.minimum.reduceat(least[order], np.flatnonzero(new))[np.cumsum(new) - 1]
        chunk, data, more, at = [], [], [], 0
        for c, n in zip(column(table, "chunk").to_pylist(), sent):
            part = slice(at, at + n)
            at += n
            less = lowest[part] < least[part]
            if less.any():
                chunk.append(c), data.append(key[part][less].tobytes()), more.append(lowest[part][less].tobytes())
        return reply_table(chunk, FIRST, [group[0].as_py()] * len(chunk), data, more)

    sent = with_replies(chunks, copies.unionAll(cells), send, "block long, chunk long, key binary, check binary, least binary")
    return sent.groupBy("block").applyInArrow(merge, REPLY)


def cut(chunks: DataFrame, replies: DataFrame, size: int, schema, as_is: bool) -> DataFrame:
    """Documents without the words of windows that start in a document of smaller doc_id; ``as_is``: others keep their text."""
    names = [f.name for f in schema.fields]

    def run(chunk: int, table: pa.Table, replies: list[dict]) -> pa.Table:
        copies = _copies(replies)
        w = Windows(table, size, replies)
        lowest = w.least.copy()
        for r in replies:
            if r["kind"] == FIRST:
                at = np.searchsorted(w.key, np.frombuffer(r["data"], np.uint64))
                lowest[at] = np.minimum(lowest[at], np.frombuffer(r["more"], np.int64))
        gone = lowest[w.of] < w.ids[w.doc]
        upto = np.concatenate(([0], np.cumsum(w.n_words)))
        step = np.zeros(int(upto[-1]) + 1, np.int64)
        begin = upto[w.doc[gone]] + w.at[gone]
        np.add.at(step, begin, 1)
        np.add.at(step, begin + size, -1)
        removed = np.cumsum(step[:-1]) > 0
        for i in copies:
            if w.n_words[i] >= size:
                removed[upto[i] : upto[i + 1]] = True
        text = pa.concat_arrays([_joined(column(table, "text").slice(a, b - a), ~removed[upto[a] : upto[b]]) for a, b in text_slices(column(table, "text"))])
        n_removed = np.diff(np.concatenate(([0], np.cumsum(removed)))[upto])
        if as_is:
            text = pc.if_else(pa.array(n_removed == 0), column(table, "text").cast(pa.string()), text)
        made = {"text": text, "n_words": pa.array(w.n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
        return pa.table([made[n] if n in made else column(table, n) for n in names], names=names)

    return with_replies(chunks, replies, run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields))


def _joined(texts: pa.Array, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    t = Texts(texts)
    starts, ends = t.starts[kept], t.ends[kept]
    per = np.diff(np.concatenate(([0], np.cumsum(kept)))[t.first])
    size = ends - starts + 1  # with the space behind
    total = np.cumsum(size)
    out = np.full(int(total[-1]) if len(total) else 0, 0x20, np.uint8)
    if len(total):
        lengths = size - 1
        shift = np.repeat(total - size - (np.cumsum(lengths) - lengths), lengths)
        source = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        index = np.arange(int(lengths.sum()))
        out[index + shift] = t.data[index + source]
    # Every text but an empty one ends with a space too many: texts are cut out one by one.
    ends_at = np.concatenate(([0], total))[np.cumsum(per)]
    begins_at = np.concatenate(([0], ends_at[:-1]))
    last = np.where(per > 0, ends_at - 1, ends_at)
    raw = out.tobytes()
    return pa.array([raw[a:b].decode() for a, b in zip(begins_at.tolist(), last.tolist())], pa.string())


def remove_repeats(docs: DataFrame, size: int = 50, as_is: bool = False, by_row: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, any others) with repeated words out of ``text``, and ``n_words`` and ``n_removed``.

    A word goes if it is covered by ``size`` consecutive words that also start in a document of smaller doc_id, judged
    on the input. Kept words are joined by one space; with ``as_is`` a document that loses none keeps its text. A null text is empty; a null doc_id is smaller than all others;
    rows of one doc_id do not count against each other, unless ``by_row``, which puts them, those without an id too, in
    the order of their texts' hashes. A document whose whole text is that of one before it loses all
    words if it has a window, and takes no part in the sketch. Columns named n_words and n_removed are replaced.
    """
    from pyspark.sql.types import LongType, StructField, StructType

    own = docs.select(*[c for c in docs.columns if c not in ("n_words", "n_removed")])
    schema = StructType([*own.schema.fields, StructField("n_words", LongType()), StructField("n_removed", LongType())])
    chunks = write_chunks(own, "substrings")

    def count(chunk: int, table: pa.Table) -> pa.Table:
        texts = column(table, "text")
        n = sum(int(np.maximum(Texts(texts.slice(a, b - a)).counts - size + 1, 0).sum()) for a, b in text_slices(texts))
        return pa.table({"n": pa.array([n], pa.int64())})

    total = each_chunk(chunks, count, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    bits = max(10, int(np.ceil(np.log2(max(1, CELLS_PER_WINDOW * total)))))
    copies = find_copies(chunks, by_row)
    cells = sketch(chunks, copies, size, bits)
    first = keep(exact(chunks, copies, cells, size, bits), "first")
    return cut(chunks, copies.unionAll(first), size, schema, as_is)
