"""Byte-pair encoding as a deterministic automaton over token ids, compiled from the list of merges.

The automaton accepts exactly the id sequences that the merges produce. It starts with one state in which every byte
may follow every byte. Merge gadgets are then built in, one merge ``u v -> w`` after another:

* the state after ``w`` is the state after ``v`` as it is at that moment, and ``w`` may follow whatever ``u`` may follow;
* the state after ``u`` is split off without its arc ``v``, as the two would now have been merged.

A state is therefore the arcs that its gadgets took away. Let each id hang below the left half of its merge, later
siblings after earlier ones, and number the ids bottom up: an arc ``v`` and everything that later merges would have
derived from it are then one interval of numbers, so a gadget adds one interval to the state it splits. The compiled
table holds the merged intervals of all states in one sorted array, and one binary search follows an arc.

A word is encoded along its bytes: a trie gives the ids that start at each byte, and of those that end at a byte
exactly one has an arc from the state before it. The ids of the word are the arcs that lead to its last byte. Decoding
writes the bytes that each arc stands for.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .words import column, release, slices, text_slices

SLICE = 1 << 21  # bytes of text that are encoded at a time
WORDS = 300_000  # distinct pieces of text that a task remembers with their ids
LONGEST = 1000  # characters of a piece that is remembered
MOST_IDS = 8_000_000  # of the remembered pieces
BATCH = 1 << 17  # bytes of distinct words that go through the automaton together


# A word of the byte-level splitting pattern, of one class of ASCII characters; apostrophes may begin a shortened verb.
_PLAIN_WORD = re.compile(r" ?(?:[A-Za-z]+|[0-9]+|[!-&(-/:-@\[-`{-~]+)")
_CLASS = np.zeros(256, np.uint8)  # 0: not plain, 1: letter, 2: digit, 3: other visible
_CLASS[0x21:0x7F] = 3
_CLASS[0x30:0x3A] = 2
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_CLASS[0x27] = 0


def _byte_names() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: visible ones for themselves, others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {chr(b): b for b in visible}
    hidden = [b for b in range(256) if b not in set(visible)]
    return names | {chr(256 + i): b for i, b in enumerate(hidden)}


class Automaton:
    """The compiled tables. ``tokens`` are the bytes of each id (None where an id is unused), ``merges`` pairs of ids."""

    def __init__(self, tokens: Sequence[bytes | None], merges: Sequence[tuple[int, int]]):
        ids = {t: i for i, t in enumerate(tokens) if t is not None}
        single = [ids[bytes([b])] for b in range(256) if bytes([b]) in ids]
        made = set(single)
        size = len(tokens)
        left, born = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        results = []
        for at, (u, v) in enumerate(merges, 1):
            w = ids.get(tokens[u] + tokens[v], -1)
            if u not in made or v not in made or w < 0 or w in made:
                raise ValueError(f"merge {at} does not make a new id of two ids made before it")
            made.add(w)
            results.append(w)
            left[w], born[w] = u, at
        self._number(left, born, made)
        # Of every state: the state it was split off, and the numbers of the arcs it lost then.
        above, low, high = [-1], [0], [0]
        state, number, first = [-1] * size, self.number.tolist(), self.first.tolist()
        for i in single:
            state[i] = 0
        times = {u: [int(born[c]) for c in kids] for u, kids in self.below.items()}
        for at, (u, v, w) in enumerate(((u, v, w) for (u, v), w in zip(merges, results)), 1):
            s, n = state[u], number[v]
            while s > 0 and not low[s] <= n < high[s]:
                s = above[s]
            if s or state[v] < 0:  # the two never meet: no gadget, and the result is never made
                made.discard(w)
                continue
            later = bisect_left(times.get(v, ()), at)  # merged with itself, v takes w along
            above.append(state[u])
            low.append(first[self.below[v][later]] if later < len(times.get(v, ())) else n)
            high.append(n + 1)
            state[w], state[u] = state[v], len(above) - 1
        self.state = np.array(state)
        self.number[self.state < 0] = -1
        self._intervals(np.array(above), np.array(low), np.array(high))
        self._trie(tokens, made)
        self.sizes = np.array([len(t or b"") for t in tokens], np.int64)

    def _number(self, left: np.ndarray, born: np.ndarray, made: set[int]) -> None:
        """Numbers of the ids, bottom up below their left halves, siblings in the order of their merges."""
        self.number = np.full(len(left), -1, np.int64)
        below: dict[int, list[int]] = {}
        for i in sorted(made, key=lambda i: born[i]):
            below.setdefault(int(left[i]), []).append(i)
        self.below, count = below, 0
        self.first = np.zeros(len(left), np.int64)  # smallest number in an id's own tree
        for root in below.get(-1, []):
            stack = [(root, iter(below.get(root, ())))]
            self.first[root] = count
            while stack:
                node, rest = stack[-1]
                child = next(rest, None)
                if child is None:
                    self.number[node] = count
                    count += 1
                    stack.pop()
                else:
                    self.first[child] = count
                    stack.append((child, iter(below.get(child, ()))))

    def _intervals(self, above: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        """One sorted array of interval bounds: an arc is missing if an odd number of its state's bounds lie at or below it."""
        used = np.unique(self.state[self.state >= 0])
        self.row = np.full(len(self.state), -1, np.int64)
        has = self.state >= 0
        self.row[has] = np.searchsorted(used, self.state[has])
        self.span = len(self.state) + 1
        bounds = []
        for row, s in enumerate(used.tolist()):
            chain = []
            while s > 0:
                chain.append(s)
                s = int(above[s])
            if chain:
                a, b = low[chain], high[chain]
                order = np.argsort(a)
                a, b = a[order], np.maximum.accumulate(b[order])
                apart = np.concatenate(([True], a[1:] > b[:-1]))
                ends = np.concatenate((b[:-1][apart[1:]], b[-1:]))
                bounds.append(np.stack((a[apart], ends), 1).ravel() + row * self.span)
        every = np.concatenate(bounds) if bounds else np.zeros(0, np.int64)
        self.bounds = every.astype(np.uint32 if len(used) * self.span < 1 << 32 else np.int64)

    def _trie(self, tokens: Sequence[bytes | None], made: set[int]) -> None:
        """Arcs of the byte trie as sorted keys node * 256 + byte, and the id that ends in each node."""
        nodes: dict[tuple[int, int], int] = {}
        ends = [-1]
        for i in sorted(made):
            at = 0
            for b in tokens[i]:
                to = nodes.get((at, b))
                if to is None:
                    to = nodes[at, b] = len(ends)
                    ends.append(-1)
                at = to
            ends[at] = i
        keys = np.array([a * 256 + b for a, b in nodes], np.int64)
        order = np.argsort(keys)
        self.trie_keys, self.trie_nodes = keys[order], np.array(list(nodes.values()), np.int64)[order]
        self.node_id = np.array(ends, np.int64)
        self.root = np.full(256, -1, np.int64)
        self.root[self.trie_keys[self.trie_keys < 256]] = self.trie_nodes[self.trie_keys < 256]

    def follows(self, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether there is an arc ``after`` out of the state that ``before`` leads to."""
        key = self.row[before] * self.span + self.number[after]
        return np.searchsorted(self.bounds, key.astype(self.bounds.dtype), "right") % 2 == 0

    def accepts(self, ids: Sequence[int]) -> bool:
        """Whether the merges would produce these ids, one word's, from their bytes."""
        ids = np.asarray(ids, np.int64)
        return bool((self.number[ids] >= 0).all() and self.follows(ids[:-1], ids[1:]).all())

    def _matches(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Every occurrence of an id in the words: first byte, byte after the last, id. ``ends`` is the word's end per byte."""
        at = np.arange(len(data))
        node = self.root[data]
        found = []
        depth = 0
        while True:
            live = node >= 0
            at, node = at[live], node[live]
            if not len(at):
                break
            depth += 1
            ids = self.node_id[node]
            hit = ids >= 0
            found.append((at[hit], at[hit] + depth, ids[hit]))
            more = at + depth < ends[at]
            at, node = at[more], node[more]
            key = node * 256 + data[at + depth]
            place = np.minimum(np.searchsorted(self.trie_keys, key), len(self.trie_keys) - 1)
            node = np.where(self.trie_keys[place] == key, self.trie_nodes[place], -1)
        return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3

    def encode_words(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that lie end to end in ``data``, one after another, and how many each has.

        Bytes without an id of their own (only in vocabularies that lack them) raise ValueError.
        """
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(sizes), np.int64)
        stops = np.cumsum(sizes)
        begins = stops - sizes
        start, stop, ids = self._matches(data, np.repeat(stops, sizes))
        inside = start - np.repeat(begins, sizes)[start]
        order = np.argsort(inside, kind="stable")
        start, stop, ids, inside = start[order], stop[order], ids[order], inside[order]
        last = np.full(len(data) + 1, -1, np.int64)  # the arc that leads to each byte, by the byte after it
        cuts = np.searchsorted(inside, np.arange(int(inside[-1]) + 2 if len(inside) else 1))
        n = int(cuts[1]) if len(cuts) > 1 else 0
        last[stop[:n]] = ids[:n]  # the first arc of a word leaves the starting state, which has them all
        # Of the ids that start a word, only the last written one would stay for a byte; each byte has just one of them.
        for a, b in zip(cuts[1:-1].tolist(), cuts[2:].tolist()):
            s, i = start[a:b], ids[a:b]
            ok = self.follows(last[s], i)
            last[stop[a:b][ok]] = i[ok]
        if (last[1:] < 0).any():
            raise ValueError("the vocabulary has no id for some byte")
        # Back from each word's end, all words a step at a time.
        at, word = stops[sizes > 0], np.flatnonzero(sizes)
        taken, owner = [], []
        while len(at):
            got = last[at]
            taken.append(got)
            owner.append(word)
            at = at - self.sizes[got]
            live = at > begins[word]
            at, word = at[live], word[live]
        counts = np.bincount(np.concatenate(owner), minlength=len(sizes)).astype(np.int64)
        out = np.zeros(int(counts.sum()), np.uint32)
        upto = np.cumsum(counts)
        for step, (w, got) in enumerate(zip(owner, taken)):
            out[upto[w] - 1 - step] = got
        return out, counts


def _gather(labels: np.ndarray, label_ends: np.ndarray, label_sizes: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all ids, end to end, and where each ends."""
    ids = ids[ids < len(label_sizes)].astype(np.int64)
    sizes = label_sizes[ids]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return labels[np.arange(total) + np.repeat(label_ends[ids] - ends, sizes)], ends


class Codec:
    """Encodes and decodes whole texts as the ``tokenizers`` library does with the same file.

    The file's own splitting into words is used; the merges are this module's automaton. It must be a byte-level BPE
    vocabulary without a normalizer, dropout or affixes; names of added tokens in a text become their ids.
    """

    def __init__(self, path: str, words: int = WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        odd = [k for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        odd += [k for k in ("normalizer", "truncation", "padding") if spec.get(k)]
        if model["type"] != "BPE" or (spec.get("decoder") or {}).get("type") != "ByteLevel" or odd:
            raise ValueError(f"not a plain byte-level vocabulary: {odd or model['type']}")
        names = _byte_names()
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", ())):
            raise ValueError("added tokens that take neighbouring characters are not supported")
        tokens: list[bytes | None] = [None] * (max([*model["vocab"].values(), *added.values()]) + 1)
        for name, i in model["vocab"].items():
            if name not in added:
                tokens[i] = bytes(names[c] for c in name)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self._tokens, self._merges = tokens, [(model["vocab"][a], model["vocab"][b]) for a, b in merges]
        self.added = {c.encode(): i for c, i in added.items()}
        labels = list(tokens)
        for content, i in self.added.items():
            labels[i] = content
        self.label_sizes = np.array([len(t or b"") for t in labels], np.int64)
        self.label_ends = np.cumsum(self.label_sizes)
        self.labels = np.frombuffer(b"".join(t or b"" for t in labels), np.uint8)
        how = spec.get("pre_tokenizer") or {}
        #: Whether words are those of the byte-level pattern, so that plain ones are known without asking the library.
        self.pattern = how.get("type") == "ByteLevel" and how.get("use_regex", True) and not how.get("add_prefix_space")
        self.names = np.zeros(max(map(ord, names)) + 1, np.uint8)
        self.names[[ord(c) for c in names]] = list(names.values())
        self.limit = words
        self.seen: dict[str, tuple[int, int]] = {}
        self.arena: list[np.ndarray] = []
        self.filled = 0

    @cached_property
    def automaton(self) -> Automaton:
        """Compiled when a text is first encoded; decoding needs the labels only."""
        return Automaton(self._tokens, self._merges)

    def _fresh(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct pieces, one after another, and how many each has."""
        spelled, per = [], np.zeros(len(pieces), np.int64)
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        for i, piece in enumerate(pieces):
            if self.pattern and _PLAIN_WORD.fullmatch(piece):
                per[i] = 1
                spelled.append(piece.replace(" ", "\u0120"))
                continue
            found = split(piece)
            per[i] = len(found)
            spelled += [w for w, _ in found]
        words = pa.array(spelled, pa.large_string()).dictionary_encode()
        which = words.indices.to_numpy(zero_copy_only=False)
        values = words.dictionary.to_pylist()
        # Short words first, so that words of one batch end at about the same time.
        lengths = np.fromiter(map(len, values), np.int64, len(values))
        distinct = np.argsort(lengths, kind="stable")
        ids, counts = [], np.zeros(len(values), np.int64)
        for lo, hi in slices(lengths[distinct], BATCH):
            part = distinct[lo:hi].tolist()
            points = np.frombuffer("".join([values[i] for i in part]).encode("utf-32-le"), "<u4")
            sizes = np.fromiter((len(values[i]) for i in part), np.int64, len(part))
            got, n = self.automaton.encode_words(self.names[points], sizes)
            ids.append(got)
            counts[part] = n
        flat = np.concatenate(ids) if ids else np.zeros(0, np.uint32)
        place = np.zeros(len(values), np.int64)
        place[distinct] = np.cumsum(counts[distinct]) - counts[distinct]
        sizes = counts[which]
        ends = np.cumsum(sizes)
        out = flat[np.arange(int(sizes.sum())) + np.repeat(place[which] - (ends - sizes), sizes)]
        first = np.concatenate(([0], np.cumsum(per)))
        upto = np.concatenate(([0], ends))
        return out, np.diff(upto[first])

    def _plain(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts without added tokens, cut where words are independent of each other."""
        _, offsets, data = texts.buffers()
        bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        base = int(bounds[0])
        data = np.frombuffer(data, np.uint8)[base : int(bounds[-1])] if bounds[-1] > base else np.zeros(0, np.uint8)
        bounds = bounds - base
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        cuts = _cuts(data, bounds, self.pattern)
        coded = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), pa.py_buffer(data)).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        new = [p for p in pieces if p not in self.seen]
        if new:
            if len(self.seen) + len(new) > self.limit or self.filled > MOST_IDS:  # begin anew rather than grow
                self.seen, self.arena, self.filled = {}, [], 0
                new = pieces
            ids, counts = self._fresh(new)
            ends = (np.cumsum(counts) + self.filled).tolist()
            self.seen.update(zip(new, zip(ends, counts.tolist())))
            self.arena.append(ids)
            self.filled += len(ids)
        if len(self.arena) > 1:
            self.arena = [np.concatenate(self.arena)]
        found = np.array([self.seen[p] for p in pieces], np.int64)
        for p in new:
            if len(p) > LONGEST:
                del self.seen[p]
        which = coded.indices.to_numpy(zero_copy_only=False)
        sizes = found[which, 1]
        ends = np.cumsum(sizes)
        ids = self.arena[0][np.arange(int(ends[-1])) + np.repeat(found[which, 0] - ends, sizes)]
        upto = np.concatenate(([0], ends))
        return ids, np.diff(upto[np.searchsorted(cuts, bounds)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one after another, and the number of each; null and empty texts have none."""
        texts = pc.fill_null(texts, "").cast(pa.large_string())
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        marked = np.zeros(len(texts), bool)
        for content in self.added:
            marked |= pc.match_substring(texts, content.decode()).to_numpy(zero_copy_only=False)
        if not marked.any():
            return self._plain(texts)
        # Texts with added tokens are cut at those; the parts between them are texts of their own.
        names = re.compile("|".join(re.escape(c.decode()) for c in sorted(self.added, key=len, reverse=True)))
        parts, owner, after = [], [], []  # ``after`` is the added token that follows a part, or -1
        for i, (text, has) in enumerate(zip(texts.to_pylist(), marked)):
            at = 0
            for m in names.finditer(text) if has else ():
                parts.append(text[at : m.start()])
                owner.append(i)
                after.append(self.added[m.group().encode()])
                at = m.end()
            parts.append(text[at:])
            owner.append(i)
            after.append(-1)
        ids, counts = self._plain(pa.array(parts, pa.large_string()))
        after, owner = np.array(after), np.array(owner)
        ids = np.insert(ids, np.cumsum(counts)[after >= 0], after[after >= 0].astype(np.uint32))
        return ids, np.bincount(owner, counts + (after >= 0), len(texts)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> pa.LargeStringArray:
        """Texts of id sequences that lie end to end. Bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
        known = np.concatenate(([0], np.cumsum(ids < len(self.label_sizes))))
        data, ends = _gather(self.labels, self.label_ends, self.label_sizes, ids)
        upto = np.concatenate(([0], ends))
        bounds = upto[known[np.concatenate(([0], np.cumsum(counts)))]]
        out = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)])
        try:
            return out.cast(pa.large_string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in out.to_pylist()], pa.large_string())


def _cuts(data: np.ndarray, bounds: np.ndarray, plain: bool) -> np.ndarray:
    """Sorted byte offsets at which texts can be cut without changing their words, ``bounds`` among them.

    That is before a space that follows a visible ASCII character: word patterns never join the two. With ``plain``
    pieces of ASCII letters, digits and signs are also cut into the words of the byte-level pattern.
    """
    before = np.zeros(len(data) + 1, bool)
    before[1:-1] = (data[1:] == 0x20) & (data[:-1] > 0x20) & (data[:-1] < 0x7F)
    before[bounds] = True
    before[[0, -1]] = True
    cuts = np.flatnonzero(before).astype(np.int64)
    if not plain:
        return cuts
    kind = _CLASS[data]
    lead = before[:-1] & (data == 0x20)
    pure = np.minimum.reduceat(np.where(lead, 1, kind), cuts[:-1]) > 0
    change = kind[1:] != kind[:-1]
    change &= ~lead[:-1]
    before[1:-1] |= change & np.repeat(pure, np.diff(cuts))[1:]
    return np.flatnonzero(before).astype(np.int64)


@lru_cache(maxsize=1)
def codec(path: str) -> Codec:
    """The codec of a file, compiled once by every worker process."""
    return Codec(path)


def _schema(df: DataFrame, drop: tuple[str, ...], *more: T.StructField) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in drop] + list(more))


def encode(docs: DataFrame, path: str, text: str = "text", to: str = "ids") -> DataFrame:
    """``docs`` with the ids of the whole ``text`` as little-endian unsigned 32-bit integers in the binary column ``to``.

    Null and empty texts have no ids (an empty value). Rows stay as they are, repeated ones and null keys too; a column
    that is already named ``to`` is replaced. An empty table gives an empty one.
    """
    names = [c for c in docs.columns if c != to]
    schema = _schema(docs, (to,), T.StructField(to, T.BinaryType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            texts = column(batch, text)
            for a, b in text_slices(texts, SLICE):
                ids, counts = coder.encode(texts.slice(a, b - a))
                for c, d in _cut(counts * 4):
                    upto = np.concatenate(([0], np.cumsum(counts[c:d]))) * 4
                    skip = int(counts[:c].sum())
                    data = ids[skip : skip + int(upto[-1]) // 4].astype("<u4", copy=False)
                    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), d - c, [None, pa.py_buffer(upto.astype(np.int64)), pa.py_buffer(data)])
                    kept = [batch.column(n).slice(a + c, d - c) for n in names]
                    yield pa.RecordBatch.from_arrays([*kept, coded.cast(pa.binary())], names=[*names, to])
        release()

    return docs.select(*[f"`{n}`" for n in names]).mapInArrow(run, schema)


def _cut(sizes: np.ndarray, most: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes fit in one Arrow binary column."""
    return slices(sizes, most)


def decode(frame: DataFrame, path: str, ids: str = "ids", to: str = "decoded") -> DataFrame:
    """``frame`` with the text of its binary column ``ids`` in the column ``to`` (replaced if there is one).

    Null ids give an empty text, bytes that are no UTF-8 become U+FFFD, ids outside the vocabulary stand for nothing.
    """
    names = [c for c in frame.columns if c != to]
    schema = _schema(frame, (to,), T.StructField(to, T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            values = pc.fill_null(column(batch, ids), b"").cast(pa.large_binary())
            for a, b in _cut(pc.binary_length(values).to_numpy(zero_copy_only=False), SLICE):
                part = values.slice(a, b - a)
                _, offsets, data = part.buffers()
                bounds = np.frombuffer(offsets, np.int64)[part.offset : part.offset + len(part) + 1]
                data = np.frombuffer(data, np.uint8)[int(bounds[0]) : int(bounds[-1])] if bounds[-1] > bounds[0] else np.zeros(0, np.uint8)
                texts = coder.decode(np.frombuffer(data.tobytes(), "<u4"), np.diff(bounds) // 4)
                yield pa.RecordBatch.from_arrays([*[batch.column(n).slice(a, b - a) for n in names], texts.cast(pa.string())], names=[*names, to])
        release()

    return frame.select(*[f"`{n}`" for n in names]).mapInArrow(run, schema)
