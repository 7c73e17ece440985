"""Phrases of two to five words by association score, grown best first until the best ones of each language are settled.

A phrase with first word ``x`` and last word ``y`` scores at most ``1000 * n / f(x)`` and at most ``1000 * n / f(y)``: the
rest of a cut is at least as frequent as the phrase. Words are therefore a frontier ordered by that bound, rarest
first. A round expands the words of at most ``cap`` occurrences: phrases that begin or end with one grow by a word at a
time while they stay frequent, so that every cut of a phrase with both ends in the frontier is counted. All phrases that
score more than ``1000 * n / (cap + 1)`` are then known. A language is settled when its last wanted score, ties
included, lies above that, or when it has no words left; for the others the cap rises.

On Spark the texts become chunks of word codes, written once and bucketed by chunk. Words and grown phrases are counted
exactly, without hashes in place of words: a phrase is named by the number of its frequent part and that of the word
added. A chunk sends its distinct words, then the names of its phrases, with their counts to hash blocks and gets back
the numbers of the frequent ones, so a very common word or phrase costs one entry per chunk.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .chunks import REPLY, by_block, packed, reply_table, unpacked
from .scratch import keep, keep_bucketed
from .words import BASES, Texts, column, mix, ranges, release, slices

CHUNK_BYTES = 4 << 20  # of text
BLOCK_WORDS = 1 << 20  # of the corpus per hash block
LONGEST = 5
FIRST_CAP, RISE = 16, 32  # the first cap in multiples of the least count, and by how much it rises
UNKNOWN = "und"

BREAKS = np.zeros(256, bool)  # ends of pieces
BREAKS[[ord(c) for c in ".,;:!?"]] = True
BREAKS[0x0A:0x0E] = True
BETWEEN = BREAKS.copy()  # what words do not hold
BETWEEN[[0x20, 0x09]] = True

OUT = "lang string, rank int, phrase string, a long, l long, r long, n long, score long"
MESSAGE = "block long, chunk long, n int, data binary"
_OPEN, _COUNTED = 0, 100  # kinds of replies; those between are levels


def _squeeze(*arrays: np.ndarray) -> bytes:
    return pa.compress(b"".join(a.tobytes() for a in arrays), codec="zstd", asbytes=True)


def _spread(data: bytes, n: int, *dtypes: str) -> list[np.ndarray]:
    width = [np.dtype(d).itemsize * n for d in dtypes]
    raw = pa.decompress(data, sum(width), codec="zstd", asbytes=True)
    ends = np.cumsum(width)
    return [np.frombuffer(raw[e - w : e], d) for e, w, d in zip(ends, width, dtypes)]


# --- chunks of codes ---------------------------------------------------------------------------------------------


def _code(texts: pa.Array, langs: pa.Array) -> tuple[pa.Table, np.ndarray]:
    """Distinct (lang, word) with their counts, and the words as codes; -1 stands between pieces."""
    t = Texts(texts, BETWEEN, lower=True)
    sizes = t.ends - t.starts
    bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    letters = t.data[~BETWEEN[t.data]]
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]).dictionary_encode()
    spoken = pc.fill_null(langs, UNKNOWN).dictionary_encode()
    lang = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)[t.owner()]
    key = lang * max(len(words.dictionary), 1) + words.indices.to_numpy(zero_copy_only=False)
    distinct, codes, counts = np.unique(key, return_inverse=True, return_counts=True)
    width = max(len(words.dictionary), 1)
    table = pa.table(
        [spoken.dictionary.take(pa.array(distinct // width)).cast(pa.string()), words.dictionary.take(pa.array(distinct % width)).cast(pa.large_string()).cast(pa.string()), pa.array(counts.astype(np.int64))],
        names=["lang", "word", "n"],
    )
    upto = np.concatenate(([0], np.cumsum(BREAKS[t.data])))
    apart = np.ones(len(codes), bool)
    apart[1:] = upto[t.starts[1:]] != upto[t.ends[:-1]]
    apart[t.first[:-1][t.counts > 0]] = True
    return table, np.insert(codes.astype(np.int32), np.flatnonzero(apart), -1)


def _chunks(chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, held, size = TaskContext.get().partitionId() << 24, [], 0

        def row() -> pa.RecordBatch:
            table = pa.concat_tables(held).combine_chunks()
            words, codes = _code(column(table, "text"), column(table, "lang"))
            langs = words.group_by("lang").aggregate([("n", "sum")])
            totals = [[{"lang": a, "n": b} for a, b in zip(langs.column("lang").to_pylist(), langs.column("n_sum").to_pylist())]]
            return pa.RecordBatch.from_pylist([{"chunk": chunk, "langs": totals[0], "words": packed(words), "codes": packed(pa.table([pa.array(codes)], names=["code"]))}], _CODED)

        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(column(batch, "text")), 0).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes, chunk_bytes):
                own = int(sizes[a:b].sum())
                if held and size + own > chunk_bytes:
                    yield row()
                    held, size, chunk = [], 0, chunk + 1
                    release()
                held.append(pa.Table.from_batches([batch.slice(a, b - a)]))
                size += own
        if held:
            yield row()
        release()

    return run


CODED = "chunk long, langs array<struct<lang string, n bigint>>, words binary, codes binary"
_CODED = pa.schema(
    [("chunk", pa.int64()), ("langs", pa.list_(pa.struct([("lang", pa.string()), ("n", pa.int64())]))), ("words", pa.binary()), ("codes", pa.binary())]
)


def _dealt(words: pa.Table, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of a chunk's words by (block, language); blocks and languages (as numbers) in that order. Equal words share a block."""
    text = column(words, "word").cast(pa.large_string())
    _, offsets, data = text.buffers()
    bounds = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(data, np.uint8) if len(text) else np.zeros(0, np.uint8)
    spoken = column(words, "lang").dictionary_encode()
    lang = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    seed = np.array([zlib.crc32(x.encode()) for x in spoken.dictionary.to_pylist()] or [0], np.uint64)
    block = (mix(ranges(data[: int(bounds[-1])], bounds[:-1], bounds[1:], BASES[0]) + seed[lang]) % np.uint64(blocks)).astype(np.int64)
    order = np.lexsort((lang, block))
    return order, block[order], lang[order]


WORDS = "block long, chunk long, kind int, lang string, n int, size int, data binary"
_WORDS = pa.schema(
    [("block", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()), ("lang", pa.string()), ("n", pa.int32()), ("size", pa.int32()), ("data", pa.binary())]
)


def _send_words(blocks: int):
    """A chunk's distinct words with their counts, one message per block and language. Words hold no line feed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, blob in zip(column(batch, "chunk").to_pylist(), column(batch, "words")):
                words, out = unpacked(blob.as_py()), []
                order, block, lang = _dealt(words, blocks)
                names = column(words, "lang").dictionary_encode().dictionary.to_pylist()
                text, counts = column(words, "word").take(pa.array(order)).to_pylist(), column(words, "n").to_numpy()[order]
                for b, s in by_block(block):
                    for kind, part in by_block(lang[s]):
                        lo, hi = s.start + part.start, s.start + part.stop
                        raw = counts[lo:hi].astype("<i8").tobytes() + "\n".join(text[lo:hi]).encode()
                        data = pa.compress(raw, codec="zstd", asbytes=True)
                        out.append({"block": b, "chunk": chunk, "kind": kind, "lang": names[kind], "n": hi - lo, "size": len(raw), "data": data})
                yield pa.RecordBatch.from_pylist(out, _WORDS)
        release()

    return run


def _count_words(least: int):
    """Counts of a block's words; every chunk learns which of its own are frequent, their numbers and counts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block, keys, counts = key[0].as_py(), [], []
        sizes = table.column("n").to_numpy()
        for lang, n, size, data in zip(*(table.column(c).to_pylist() for c in ("lang", "n", "size", "data"))):
            raw = pa.decompress(data, size, codec="zstd", asbytes=True)
            counts.append(np.frombuffer(raw[: 8 * n], "<i8"))
            keys += [f"{lang}\n{word}" for word in raw[8 * n :].decode().split("\n")]
        coded = pa.array(keys, pa.large_string()).dictionary_encode()
        which, counts = coded.indices.to_numpy(), np.concatenate(counts)
        total = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(total, which, counts)
        number = np.where(total >= least, np.cumsum(total >= least) - 1 + (block << 32), -1)
        ends = np.cumsum(sizes)
        out = []
        for chunk, kind, lo, hi in zip(table.column("chunk").to_pylist(), table.column("kind").to_pylist(), ends - sizes, ends):
            own = which[lo:hi]
            good = np.flatnonzero(number[own] >= 0)
            if len(good):
                more = _squeeze(number[own[good]], total[own[good]])
                out.append({"chunk": chunk, "kind": kind, "block": block, "data": good.astype("<i4").tobytes(), "more": more})
        release()
        return pa.Table.from_pylist(out, _REPLY)

    return run


_REPLY = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("block", pa.int64()), ("data", pa.binary()), ("more", pa.binary())])


def _only_frequent(blocks: int):
    """A chunk with its frequent words only; others end a piece, as no frequent phrase holds them."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _BASE.empty_table()
        words, codes = unpacked(left.column("words")[0].as_py()), column(unpacked(left.column("codes")[0].as_py()), "code").to_numpy()
        replies = {(r["block"], r["kind"]): r for r in right.to_pylist()}
        order, block, lang = _dealt(words, blocks)
        gid, f = np.full(len(order), -1, np.int64), np.zeros(len(order), np.int64)
        for b, s in by_block(block):
            for kind, part in by_block(lang[s]):
                r = replies.get((b, kind))
                if r:
                    good = np.frombuffer(r["data"], "<i4")
                    at = order[s.start + part.start + good]
                    gid[at], f[at] = _spread(r["more"], len(good), "<i8", "<i8")
        kept = np.flatnonzero(gid >= 0)
        new = np.full(words.num_rows + 1, -1, np.int32)  # the last entry is for -1
        new[kept] = np.arange(len(kept))
        codes = new[codes]
        codes = codes[(codes >= 0) | np.concatenate(([True], codes[:-1] >= 0))]  # one -1 between pieces
        words = words.take(pa.array(kept)).select(["lang", "word"]).append_column("id", pa.array(gid[kept])).append_column("f", pa.array(f[kept]))
        tops = words.group_by("lang").aggregate([("f", "max")])
        langs = [{"lang": a, "top": b} for a, b in zip(tops.column("lang").to_pylist(), tops.column("f_max").to_pylist())]
        release()
        coded = packed(pa.table([pa.array(codes)], names=["code"]))
        return pa.Table.from_pylist([{"chunk": left.column("chunk")[0].as_py(), "langs": langs, "words": packed(words), "codes": coded}], _BASE)

    return run


BASE = "chunk long, langs array<struct<lang string, top bigint>>, words binary, codes binary"
_BASE = pa.schema(
    [("chunk", pa.int64()), ("langs", pa.list_(pa.struct([("lang", pa.string()), ("top", pa.int64())]))), ("words", pa.binary()), ("codes", pa.binary())]
)


# --- growth within a chunk ---------------------------------------------------------------------------------------


class Chunk:
    """Words of a chunk, and the frequent phrases found in it so far: ``at[k]`` is the phrase of ``k`` words at a place, or -1."""

    def __init__(self, row: pa.Table, replies: list[dict], cap: int):
        self.words = unpacked(row.column("words")[0].as_py())
        self.code = column(unpacked(row.column("codes")[0].as_py()), "code").to_numpy()
        self.id, f = column(self.words, "id").to_numpy(), column(self.words, "f").to_numpy()
        opened = [unpacked(r["data"]) for r in replies if r["kind"] == _OPEN]
        #: Per language still open: all its words, and the count of its most frequent one.
        self.open = {r["lang"]: (r["n"], r["top"]) for t in opened for r in t.to_pylist()}
        lang = column(self.words, "lang").dictionary_encode()
        usable = np.array([x in self.open for x in lang.dictionary.to_pylist()], bool)[lang.indices.to_numpy()]
        self.lang = lang
        self.in_frontier = np.append(usable & (f <= cap), False)  # the last entry is for -1
        self.at, self.f, self.gid = {1: self.code}, {1: f}, {1: self.id}
        for r in replies:
            if _OPEN < r["kind"] < _COUNTED:
                places, gids = unpacked(r["data"]), unpacked(r["more"])
                here = np.full(len(self.code), -1, np.int32)
                here[column(places, "at").to_numpy()] = column(places, "gram").to_numpy()
                self.at[r["kind"]], self.f[r["kind"]], self.gid[r["kind"]] = here, column(gids, "f").to_numpy(), column(gids, "gid").to_numpy()

    def grow(self, size: int, blocks: int):
        """Phrases of ``size`` words to count: (places, phrase of each), then per phrase its block, two keys and count, in order of the three."""
        before = self.at.get(size - 1)
        n = len(self.code) - size + 1
        if n <= 0 or before is None:
            return None
        first, last = self.in_frontier[self.code[:n]], self.in_frontier[self.code[size - 1 :]]
        left, right = before[:n] >= 0, before[1 : n + 1] >= 0
        wanted = (first | last) & np.where(first, left, self.code[:n] >= 0) & np.where(last, right, self.code[size - 1 :] >= 0)
        places = np.flatnonzero(wanted)
        if not len(places):
            return None
        # Named by the part at its frontier end, the front one if both are, and the word beside that.
        front = first[places]
        part = np.where(front, before[places], before[places + 1]).astype(np.int64)
        word = np.where(front, self.code[places + size - 1], self.code[places]).astype(np.int64)
        _, some, which, counts = np.unique(part << 32 | word << 1 | ~front, return_index=True, return_inverse=True, return_counts=True)
        one = self.gid[size - 1][part[some]]
        two = self.id[word[some]] * 2 + ~front[some]
        block = (mix(one.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + mix(two.astype(np.uint64))) % np.uint64(blocks)).astype(np.int64)
        order = np.lexsort((two, one, block))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return places, back[which], block[order], one[order], two[order], counts[order]


def _messages(size: int, blocks: int, cap: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        replies = right.to_pylist()
        if left.num_rows and any(r["kind"] == _OPEN for r in replies):
            chunk = left.column("chunk")[0].as_py()
            grown = Chunk(left, replies, cap).grow(size, blocks)
            if grown:
                _, _, block, one, two, counts = grown
                for b, s in by_block(block):
                    n = s.stop - s.start
                    out.append({"block": b, "chunk": chunk, "n": n, "data": _squeeze(np.diff(one[s], prepend=0), two[s], counts[s].astype(np.int32))})
        release()
        return pa.Table.from_pylist(out, _MESSAGE)

    return run


_MESSAGE = pa.schema([("block", pa.int64()), ("chunk", pa.int64()), ("n", pa.int32()), ("data", pa.binary())])


def _count(least: int):
    """Sums of a block's phrases; every chunk learns which of its own are frequent, their numbers and counts."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        block = key[0].as_py()
        one, two, counts = [], [], []
        for n, data in zip(table.column("n").to_pylist(), table.column("data").to_pylist()):
            a, b, c = _spread(data, n, "<i8", "<i8", "<i4")
            one.append(np.cumsum(a))
            two.append(b)
            counts.append(c)
        ends = np.cumsum([len(x) for x in one])
        one, two, counts = np.concatenate(one), np.concatenate(two), np.concatenate(counts).astype(np.int64)
        order = np.lexsort((two, one))
        new = np.ones(len(order), bool)
        new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
        total = np.add.reduceat(counts[order], np.flatnonzero(new))
        which = np.empty(len(order), np.int64)
        which[order] = np.cumsum(new) - 1
        number = np.where(total >= least, np.cumsum(total >= least) - 1 + (block << 32), -1)
        chunks, data, more = [], [], []
        for chunk, lo, hi in zip(table.column("chunk").to_pylist(), np.concatenate(([0], ends[:-1])), ends):
            own = which[lo:hi]
            good = np.flatnonzero(number[own] >= 0)
            if len(good):
                chunks.append(chunk)
                data.append(good.astype("<i4").tobytes())
                more.append(_squeeze(number[own[good]], total[own[good]]))
        release()
        return reply_table(chunks, _COUNTED, [block] * len(chunks), data, more)

    return run


def _take(size: int, blocks: int, cap: int):
    """The frequent phrases of ``size`` words of a chunk as one reply to itself."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = right.to_pylist()
        counted = {r["block"]: r for r in replies if r["kind"] == _COUNTED}
        if not left.num_rows or not counted:
            return reply_table([], size, [], [], [])
        places, which, block, one, _, _ = Chunk(left, [r for r in replies if r["kind"] != _COUNTED], cap).grow(size, blocks)
        gid, f = np.full(len(one), -1, np.int64), np.zeros(len(one), np.int64)
        for b, s in by_block(block):
            r = counted.get(b)
            if r:
                good = np.frombuffer(r["data"], "<i4") + s.start
                gid[good], f[good] = _spread(r["more"], len(good), "<i8", "<i8")
        kept = np.flatnonzero(gid >= 0)
        new = np.full(len(one), -1, np.int32)
        new[kept] = np.arange(len(kept))
        here = new[which] >= 0
        data = packed(pa.table([pa.array(places[here].astype(np.int32)), pa.array(new[which[here]])], names=["at", "gram"]))
        more = packed(pa.table([pa.array(gid[kept]), pa.array(f[kept])], names=["gid", "f"]))
        release()
        return reply_table([left.column("chunk")[0].as_py()], size, [0], [data], [more])

    return run


FOUND = "lang string, phrase string, size int, a long, l long, r long, n long, score long, before long, after long"
_FOUND = pa.schema(
    [("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32())] + [(c, pa.int64()) for c in ("a", "l", "r", "n", "score", "before", "after")]
)


def _beside(chunk: Chunk, gram: np.ndarray, near: np.ndarray, count: int) -> np.ndarray:
    """Per phrase the number of the word that stands there at every occurrence, or -1."""
    word = np.append(chunk.id, -1)[near]
    low, high = np.full(count, np.iinfo(np.int64).max), np.full(count, -1)
    np.minimum.at(low, gram, word)
    np.maximum.at(high, gram, word)
    return np.where(low == high, low, -1)


def _score(cap: int):
    """Phrases with both ends in the frontier that score more than any phrase outside it can, as far as this chunk knows them."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = right.to_pylist()
        if not left.num_rows or not any(r["kind"] == _OPEN for r in replies):
            return _FOUND.empty_table()
        chunk = Chunk(left, replies, cap)
        names, langs = chunk.words.column("word").to_pylist(), chunk.lang.dictionary.to_pylist()
        lang_of = chunk.lang.indices.to_numpy()
        out = []
        padded = np.concatenate(([-1], chunk.code, [-1] * (LONGEST + 1)))  # the word before place p is padded[p]
        for size in range(2, LONGEST + 1):
            if size not in chunk.at:
                continue
            here = np.flatnonzero(chunk.at[size] >= 0)
            gram = chunk.at[size][here]
            count = len(chunk.f[size])
            before, after = _beside(chunk, gram, padded[here], count), _beside(chunk, gram, padded[here + size + 1], count)
            grams, some = np.unique(gram, return_index=True)
            place = here[some]
            both = chunk.in_frontier[chunk.code[place]] & chunk.in_frontier[chunk.code[place + size - 1]]
            grams, place = grams[both], place[both]
            if not len(grams):
                continue
            a = chunk.f[size][grams].tolist()
            cuts = []
            for k in range(1, size):
                l = chunk.f[k][chunk.at[k][place]].tolist()
                r = chunk.f[size - k][chunk.at[size - k][place + k]].tolist()
                cuts.append((l, r))
            words = chunk.code[place[:, None] + np.arange(size)].tolist()
            spoken = lang_of[chunk.code[place]].tolist()
            for i, g in enumerate(grams.tolist()):
                lang = langs[spoken[i]]
                n, top = chunk.open[lang]
                whole = 1000 * a[i] * n  # Python's integers have no bound
                score, k = min((whole // (l[i] * r[i]), k) for k, (l, r) in enumerate(cuts))
                if cap >= top or score > 1000 * n // (cap + 1):
                    phrase = " ".join([names[w] for w in words[i]])
                    out.append((lang, phrase, size, a[i], cuts[k][0][i], cuts[k][1][i], n, score, int(before[g]), int(after[g])))
        release()
        return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), _FOUND)], schema=_FOUND) if out else _FOUND.empty_table()

    return run


# --- the search --------------------------------------------------------------------------------------------------


def _pack_open(key: tuple, table: pa.Table) -> pa.Table:
    return reply_table([key[0].as_py()], _OPEN, [0], [packed(table.select(["lang", "n", "top"]))], [None])


def _expand(base: DataFrame, opened: DataFrame, cap: int, least: int, blocks: int) -> DataFrame:
    """All phrases that score more than any outside the frontier of ``cap`` can, per chunk that holds them."""
    spoken = base.select("chunk", F.explode("langs.lang").alias("lang")).join(opened, "lang")
    replies = keep(spoken.groupBy("chunk").applyInArrow(_pack_open, REPLY), "open_chunks")

    def meet(replies: DataFrame, fn, schema: str) -> DataFrame:
        return base.select("chunk", "words", "codes").groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(fn, schema)

    levels = replies
    for size in range(2, LONGEST + 1):
        known = levels.filter(F.col("kind").isin(_OPEN, size - 1))
        sent = meet(known, _messages(size, blocks, cap), MESSAGE)
        counted = keep(sent.groupBy("block").applyInArrow(_count(least), REPLY), "counted")
        levels = levels.unionAll(keep(meet(known.unionAll(counted), _take(size, blocks, cap), REPLY), "grown"))
    return meet(levels, _score(cap), FOUND)


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", least: int = 100, limit: int = 2000, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The ``limit`` best phrases of every language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and into words at spaces and tabs. ``n`` counts
    a language's words, ``a`` the occurrences of the phrase within pieces (overlaps included, at least ``least``), ``l``
    and ``r`` those of its parts at the cut with the lowest score ``1000 * a * n / (l * r)``, rounded down; equal cuts go
    to the earliest. A phrase that lies inside a longer one (of at most five words) with as many occurrences is left
    out. Order: score and ``a`` falling, then the phrase by its bytes.

    Null texts are empty, null languages ``und`` (together with documents that say so). Repeated rows count as often as
    they stand there. Other columns are ignored; an empty table gives an empty one. Arithmetic is exact at any size; a
    score beyond 64 bits is an error of the column type.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    coded = keep_bucketed(rows.mapInArrow(_chunks(chunk_bytes), CODED), "chunk", "phrase_chunks")
    totals = coded.select(F.explode("langs").alias("t")).groupBy("t.lang").agg(F.sum("t.n").alias("n"))
    n = totals.agg(F.sum("n")).first()[0] or 0
    blocks, cap, best = n // BLOCK_WORDS + 1, FIRST_CAP * least, spark.createDataFrame([], OUT)
    sent = coded.select("chunk", "words").mapInArrow(_send_words(blocks), WORDS)
    known = sent.groupBy("block").applyInArrow(_count_words(least), REPLY)
    base = coded.select("chunk", "words", "codes").groupBy("chunk").cogroup(known.groupBy("chunk")).applyInArrow(_only_frequent(blocks), BASE)
    base = keep_bucketed(base, "chunk", "phrase_words")
    tops = base.select(F.explode("langs").alias("t")).groupBy("t.lang").agg(F.max("t.top").alias("top"))
    opened = keep(totals.join(tops, "lang"), "languages")
    while not opened.isEmpty():
        found = _expand(base, opened, cap, least, blocks)
        sides = [f(c).alias(f"{name}_{c}") for c in ("before", "after") for name, f in (("low", F.min), ("high", F.max))]
        every = found.groupBy("lang", "phrase", "size", "a", "l", "r", "n", "score").agg(*sides)
        inside = F.lit(False)  # the same word stands beside it wherever it occurs
        for c in ("before", "after"):
            inside |= (F.col(f"low_{c}") == F.col(f"high_{c}")) & (F.col(f"low_{c}") >= 0)
        alone = every.filter(~inside | (F.col("size") == LONGEST))
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = alone.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)
        ranked = keep(ranked.select(*[c.split()[0] for c in OUT.split(", ")]), "ranked")
        full = ranked.filter(F.col("rank") == limit).select("lang", F.lit(True).alias("full"))
        judged = keep(opened.join(full, "lang", "left").withColumn("done", F.coalesce("full", F.lit(False)) | (F.col("top") <= cap)), "languages")
        best = best.unionAll(ranked.join(judged.filter("done").select("lang"), "lang", "left_semi").select(*best.columns))
        opened = judged.filter("NOT done").select("lang", "n", "top")
        cap *= RISE
    return best
