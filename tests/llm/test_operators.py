"""Every operator against brute force on a small corpus, and on an empty table."""

from __future__ import annotations

import collections
import re
import string
import zlib

import numpy as np
import pyarrow as pa
import pytest

from feedkit.llm import chat, decontaminate, jaccard, language, packing, pages, quality, sharding, substrings, token_store
from feedkit.llm.components import components
from feedkit.llm.queries import vocabulary
from feedkit.llm.tokens import Encoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def _ids(texts, end=None):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids + ([] if end is None else [end]) for x in texts]


def _tuples(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_encoder_cuts_texts_where_ids_are_independent(corpus):
    odd = ["a  b", " \n x", "a  b", "<|endoftext|> x", "é x　y z", "it's 12 's", "x " * 50]
    texts = [t for _, t in corpus] + odd
    ids, counts = Encoder(vocabulary()).encode(pa.array(texts, pa.string()))
    assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == _ids(texts)


def test_addressable_codes_round_trip():
    v = np.array([0, 255, 256, 50_000, 70_000, 1, 2**31] * 300, np.uint32)
    levels, more, ranks = token_store.encode(v)
    assert (token_store.decode(levels, more) == v).all()
    assert [token_store.token_at(levels, more, ranks, i) for i in range(len(v))] == v.tolist()


def test_token_store(spark, documents, nothing, corpus, folder):
    token_store.write_store(documents, folder("store"), vocabulary(), end_id=0, segment_tokens=500)
    got = sorted(token_store.read_documents(spark, folder("store")).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(d for d, _ in corpus)
    want = {d: np.array(i, "<u4").tobytes() for (d, _), i in zip(corpus, _ids([t for _, t in corpus], 0))}
    assert all(bytes(r["ids"]) == want[r["doc_id"]] for r in got)
    assert [r["start"] for r in got] == list(np.cumsum([0] + [len(r["ids"]) // 4 for r in got[:-1]]))
    asked = spark.createDataFrame([(13, 5), (13, 10**6), (6, 0), (999, 0)], "doc_id long, at long")
    at = {(r["doc_id"], r["at"]): r["token"] for r in token_store.read_tokens(spark, folder("store"), asked).collect()}
    assert at == {(13, 5): np.frombuffer(want[13], "<u4")[5], (13, 10**6): None, (6, 0): np.frombuffer(want[6], "<u4")[0], (999, 0): None}
    token_store.write_store(nothing, folder("none"), vocabulary())
    assert token_store.read_documents(spark, folder("none")).count() == 0


def test_packing(documents, nothing, corpus):
    packed = packing.pack(documents, vocabulary(), capacity=256, end_id=2)
    rows = packed.places.collect()
    want = collections.Counter()
    for (d, _), ids in zip(corpus, _ids([t for _, t in corpus], 2)):
        head = (len(ids) - 1) % 256 + 1
        at = 0
        for k in range(-(-len(ids) // 256)):
            size = head if k == 0 else 256
            want[d, k, at, size, zlib.crc32(np.array(ids[at : at + size], "<u4").tobytes())] += 1
            at += size
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    taken = collections.defaultdict(list)
    for r in rows:
        taken[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in taken.values():
        assert [o for o, _ in sorted(spans)] == list(np.cumsum([0] + [n for _, n in sorted(spans)[:-1]]))
        assert sum(n for _, n in spans) <= 256
    assert len(taken) == packed.sequences
    whole = packing.sequences(packed).collect()
    assert sorted(len(r["ids"]) // 4 for r in whole) == sorted(sum(n for _, n in s) for s in taken.values())
    assert packing.pack(nothing, vocabulary()).places.count() == 0


@pytest.mark.parametrize("histogram", [{1: 5, 1024: 3, 700: 1000, 300: 10}, {512: 7, 511: 7, 1: 7}, {k: 3 for k in range(1, 200)}, {}])
def test_plan_places_every_piece(histogram):
    p = packing.plan(histogram, 1024)
    total = sum(k * v for k, v in histogram.items())
    assert p.sequences >= -(-total // 1024)
    assert p.sequences <= max(-(-total // 1024) + 2, sum(v for k, v in histogram.items() if 2 * k > 1024) + 2)


def test_substrings(documents, nothing, corpus):
    first, words = {}, [(d, WORD.findall(t or "")) for d, t in corpus]
    for d, w in words:
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            first[key] = min(first.get(key, d), d)
    want = []
    for d, w in words:
        gone = [False] * len(w)
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                gone[i : i + 50] = [True] * 50
        want.append((d, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    got = substrings.remove_repeats(documents)
    assert got.columns == ["doc_id", "text", "words", "n_words", "n_removed"]
    assert _tuples(got, "doc_id", "n_words", "n_removed", "text") == sorted(want, key=str)
    as_is = substrings.remove_repeats(documents, as_is=True)
    assert {t for n, t in _tuples(as_is, "n_removed", "text") if not n} <= {t for _, t in corpus}
    assert substrings.remove_repeats(nothing).count() == 0


def test_decontaminate(spark, documents, nothing, corpus):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: pattern.findall((t or "").translate(LOWER))
    long = dict(corpus)[7]
    items = [(1, long), (2, long[:60]), (10, long), (3, None), (4, "One"), (5, ""), (6, "never seen words here"), (7, dict(corpus)[9]), (None, dict(corpus)[8])]
    windows = collections.defaultdict(set)
    for i, t in items:
        w = split(t)
        size = min(13, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[k : k + size])].add(i)
    want = []
    for d, t in corpus:
        w, seen = split(t), set()
        hit = [False] * len(w)
        for size in {len(k) for k in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in windows:
                    seen |= windows[tuple(w[k : k + size])]
                    hit[k : k + size] = [True] * size
        names = sorted(str(i) for i in seen if i is not None)
        want.append((d, len(w), sum(hit), len(names), names, sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    table = spark.createDataFrame(items, "item_id long, text string")
    names = ("doc_id", "n_words", "n_hit", "n_items", "items", "contaminated")
    assert _tuples(decontaminate.contamination(documents, table), *names) == sorted(want, key=str)
    assert decontaminate.contamination(nothing, table).count() == 0
    assert decontaminate.contamination(documents, table.limit(0)).filter("n_hit > 0").count() == 0


def test_winnowing_is_native(spark, documents):
    table = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = decontaminate.contamination(documents, table)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan.replace("ArrowEvalPython", "Python"))


def test_shards(spark, documents, nothing, corpus):
    from pyspark.sql import functions as F

    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 8
    one = documents.unionAll(documents.sparkSession.createDataFrame([(None, "no id", "x", 1)], documents.schema))
    rows = sharding.shard(one, 4, size).collect()
    assert len(rows) == len(corpus) + 1
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append((r["slot"], r["doc_id"] if r["doc_id"] is not None else -1))
    assert all(sorted(s for s, _ in v) == list(range(len(v))) for v in slots.values())
    order = [d for k in sorted(slots) for _, d in sorted(slots[k])]
    assert order == sorted(order)
    many = spark.range(20_000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", "CAST(id AS STRING) AS text")  # a third on one key
    totals = [r["n"] for r in sharding.shard(many, 24, F.length("text")).groupBy("shard").agg(F.sum(F.length("text")).alias("n")).collect()]
    assert len(totals) == 24 and max(totals) - min(totals) < 0.02 * sum(totals) / 24
    assert sharding.shard(nothing, 4, size).count() == 0


def test_language(spark, nothing):
    en, de = "the house of the people is there and then they are here", "das haus der leute ist dort und dann sind sie hier"
    train = spark.createDataFrame([(en, "en"), (de, "de"), (None, "en"), ("x", None)], "text string, lang string")
    model = language.train(train)
    texts = [(1, en), (2, de.upper()), (3, None), (4, ""), (5, "12 ## !!"), (6, " ".join([en, de] * 5)), (7, "漢")]
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert [got[k]["lang_pred"] for k in (1, 2, 3, 4, 5)] == ["en", "de", "und", "und", "und"]
    assert set(got[6]["languages"]) == {"de", "en"} and 0.3 < got[6]["score"] < 0.7
    assert got[7]["lang_pred"] in ("de", "en") and all(0 <= r["score"] <= 1 for r in got.values())
    empty = language.train(train.limit(0))
    assert {r["lang_pred"] for r in language.identify(train.limit(1), empty, ("lang",)).collect()} == {"und"}
    assert language.identify(nothing, model).count() == 0


def test_statistics(documents, nothing, corpus):
    want = []
    for d, t in corpus:
        t = t or ""
        w, seen, repeats = WORD.findall(t), set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                repeats += line in seen
                seen.add(line)
        many = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = [any(many[tuple(w[k : k + 3])] > 1 for k in range(max(0, i - 2), min(i, len(w) - 3) + 1)) for i in range(len(w))]
        want.append((d, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), repeats, sum(covered)))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert _tuples(quality.document_statistics(documents), *names) == sorted(want, key=str)
    assert quality.document_statistics(nothing).count() == 0


def test_trees_follow_directions():
    rng = np.random.default_rng(3)
    x = rng.random((4000, 3))
    y = (x[:, 0] + 0.3 * x[:, 1] * rng.random(4000) < 0.6).astype(float)
    model = quality.fit(x, y, [-1, 0, 0], trees=30)
    assert ((model.score(x) > 0.5) == (y > 0.5)).mean() > 0.93
    grid = np.repeat(rng.random((50, 3)), 40, axis=0)
    grid[:, 0] = np.tile(np.linspace(0, 1, 40), 50)
    assert (np.diff(model.score(grid).reshape(50, 40), axis=1) <= 1e-12).all()


def test_quality_without_labels(spark, documents):
    labels = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    rows = quality.rate(documents, labels).collect()
    assert all(r["kept"] == (not r["base_failed"]) and r["score"] is None for r in rows)


def test_quality_takes_a_labelled_id_once(spark, monkeypatch):
    stats = spark.range(3000).selectExpr("IF(id % 3 = 0, 7, id) AS doc_id", *[f"id + 1 AS {c}" for c in quality.COUNTS])  # a third on one id
    labels = spark.range(3000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda x, y, directions: seen.append(len(y)))
    quality.train(stats, labels)
    assert seen == [2000]


def test_chat(spark):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]"), (1, 1, "assistant", "a<|im_end|>\n\\<s>b\\"), (1, 1, "assistant", "a<|im_end|>\n\\<s>b\\")]
    rows += [(2, None, None, None), (2, 3, "to\nol\\n", "é漢"), (None, 0, "user", ""), (-1, 0, "assistant", "")] + [(9, k, "user", str(k)) for k in range(40)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = collections.defaultdict(list)
    for r in sorted(chat.format_chat(turns, segment_turns=7).collect(), key=lambda r: (r["part"], r["segment"])):
        raw = r["formatted"].encode()
        loss = [chat.unescape(raw[s["start"] : s["end"]].decode()) for s in r["loss"]]
        said = chat.parse(r["formatted"])
        assert loss == [t for role, t in said if role == "assistant"] and len(said) == r["n_turns"]
        got[r["conv_id"]] += said
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv in {r[0] for r in rows}:
        assert got[conv] == [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
    assert chat.format_chat(turns.limit(0)).count() == 0


def test_escapes_round_trip(corpus):
    parts = ["\\", "</s>", "[INST]", "<|im_end|>", "\n", "a", "é", "n", "<", "|im_end|>"]
    texts = ["".join(parts[(i >> 2 * k + k) % len(parts)] for k in range(6)) for i in range(5000)]
    assert [chat.unescape(t) for t in chat.escape(pa.array(texts)).to_pylist()] == texts
    assert [chat.unescape_role(t) for t in chat.escape_role(pa.array(texts)).to_pylist()] == texts


def test_pages(spark):
    def page(body, nav="<nav><p>menu</nav>"):
        return f"<html><head><title>t</title><style>p{{}}</style></head><body>{nav}{body}<script>x='</p>'</script></body></html>"

    shared = "<p>Sign in</p><p>All rights</p>"
    rows = [
        (1, "http://a/x/1", page("<article><h1>Head</h1><p>One &amp; <b>t</b>wo&#33;<br>three</p></article><div class='ad'>buy</div>" + shared)),
        (2, "http://a/x/2", page("<p>Sign in</p><p>second page text</p><p>All rights</p>")),
        (3, "http://a/x/3", page("<p>Sign in</p><p>third page text</p><p>All rights</p>")),
        (4, "http://a/y", page("<p>copy one</p><p>long text of a copy that is most of the page</p>")),
        (5, "http://a/y/2", page("<p>copy one</p><p>long text of a copy that is most of the page</p>")),
        (6, None, page("<p>no url</p><form>f</form><footer>g")),
        (7, "http://b/", None),
        (8, "http://[bad", "<p>broken <b"),
        (None, "http://c/", ""),
    ]
    got = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1] == "Head One & two! three"
    assert (got[2], got[3]) == ("second page text", "third page text")
    assert got[4] == got[5] == "copy one long text of a copy that is most of the page"
    assert (got[6], got[7], got[8], got[None]) == ("no url", "", "broken", "")


def test_pages_of_a_long_host(spark):
    """Every page shares a line with the next page and with no other."""
    for n in (64, 65, 130):
        body = lambda k: f"<p>with {k - 1}</p><p>this is the own text of page {k}</p><p>with {k}</p>"
        rows = [(k, f"http://h/{k:03}", body(k)) for k in range(n)]
        got = dict(_tuples(pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)), "page_id", "text"))
        want = {k: f"this is the own text of page {k}" for k in range(n)}
        want[0], want[n - 1] = f"with -1 {want[0]}", f"{want[n - 1]} with {n - 1}"
        assert got == want


def test_common_subsequence():
    rng = np.random.default_rng(1)
    for _ in range(300):
        a, b = rng.integers(0, 5, rng.integers(0, 12)).tolist(), rng.integers(0, 5, rng.integers(0, 12)).tolist()
        d = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                d[i + 1, j + 1] = d[i, j] + 1 if x == y else max(d[i, j + 1], d[i + 1, j])
        left, right = pages.common(a, b)
        assert [a[i] for i in left] == [b[j] for j in right] and len(left) == d[-1, -1]


def _components(texts, size=5, percent=80):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return sets, root


def test_jaccard(documents, nothing, corpus):
    sets, root = _components([t for _, t in corpus])
    least = {r: min(d for (d, _), x in zip(corpus, root) if x == r) for r in root}
    want = [(d, len(s), least[r]) for (d, _), s, r in zip(corpus, sets, root)]
    assert _tuples(jaccard.linked(documents), "doc_id", "n_shingles", "component_id") == sorted(want, key=str)
    assert jaccard.linked(nothing).count() == 0


def test_jaccard_splits_hot_blocks(documents, monkeypatch):
    whole = _tuples(jaccard.linked(documents), "doc_id", "n_shingles", "component_id")
    monkeypatch.setattr(jaccard, "HOT_BYTES", 0)
    assert _tuples(jaccard.linked(documents), "doc_id", "n_shingles", "component_id") == whole


def test_components(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 90), (100, 95), (95, 90), (7, 7), (200, 201), (202, 201), (None, 3)]
    got = dict(_tuples(components(spark.createDataFrame(links, "u long, v long")), "node", "root"))
    assert got == {**{i: 0 for i in range(1, 31)}, 100: 90, 95: 90, 201: 200, 202: 200}



def test_family_of_near_copies_does_not_meet_in_pairs(spark, monkeypatch):
    """A page and 120 copies with one or two changed words: leaders join them, so no token brings all their pairs."""
    base = [f"w{i}" for i in range(150)]
    texts = [" ".join(base)]
    for i in range(120):
        words = list(base)
        for k in range(1 + i % 2):
            words[(i * 7 + k * 61) % 150] = f"own{i}x{k}"
        texts.append(" ".join(words))
    texts += [" ".join([*base[:40], *(f"far{i}x{k}" for k in range(110))]) for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts[::-1])], "doc_id long, text string")
    opened = []
    visit = jaccard._visit

    def seen(chunks, rows, *rest):
        opened.append(rows.count())
        return visit(chunks, rows, *rest)

    monkeypatch.setattr(jaccard, "_visit", seen)
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(146)} for i, t in enumerate(texts[::-1])}
    root = {i: i for i in sets}
    for i in sets:
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = {x: new if r == old else r for x, r in root.items()}
    assert _tuples(jaccard.linked(docs), "doc_id", "n_shingles", "component_id") == sorted(((i, 146, root[i]) for i in sets), key=str)
    assert opened[0] <= len(texts)  # not the pairs of the family
