"""Benchmark decontamination by winnowing, in DataFrame operations only.

For spans of L words, k-grams of words are hashed (k about L / 2) and of every L - k + 1 consecutive hashes the smallest
is kept, the rightmost among equals. A span of L words keeps the same hash wherever it stands, so documents and
benchmark windows that share one share a fingerprint: joining fingerprints finds every shared span. Each hit is then
extended to the whole window and compared word by word.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import keep

#: Characters that are not part of a word, after A-Z are lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPAN = 13
BROADCAST_BYTES = 16 << 20  # of windows with their texts
PLACE_BITS = 27  # low bits of a fingerprint hold the position, counted down
_LAST = (1 << PLACE_BITS) - 1


def words(text: Column) -> Column:
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(lower, SEPARATORS), "")


def _pairs(df: DataFrame, name: str, distance: int, join) -> DataFrame:
    """``name[i]`` replaced by ``join(name[i], name[i + distance])``. Arrays are arguments here, never captured by a lambda,
    so each step is one pass over them."""
    size = F.greatest(F.size(name) - distance, F.lit(0))
    return df.withColumn(name, F.zip_with(F.slice(name, F.lit(1), size), F.slice(name, F.lit(1 + distance), size), join))


def _run(df: DataFrame, name: str, length: int, join) -> DataFrame:
    """``name[i]`` replaced by the join of ``length`` consecutive values, by doubling."""
    have = 1
    while have * 2 <= length:
        df, have = _pairs(df, name, have, join), have * 2
    return _pairs(df, name, length - have, join) if have < length else df


def fingerprints(df: DataFrame, span: int) -> DataFrame:
    """``df`` with ``fp``: the distinct fingerprints of its column ``words``, and without ``words``."""
    gram = (span + 1) // 2
    out = df.withColumn("fp", F.transform("words", lambda w: F.xxhash64(w))).drop("words")
    out = _run(out, "fp", gram, lambda a, b: F.xxhash64(a, b))
    out = out.withColumn("fp", F.transform("fp", lambda h, i: F.shiftleft(h, PLACE_BITS).bitwiseOR(F.lit(_LAST) - i)))
    out = _run(out, "fp", span - gram + 1, lambda a, b: F.least(a, b))
    return out.withColumn("fp", F.array_distinct("fp"))


def _exploded(df: DataFrame, *carry: str) -> DataFrame:
    # Outer: a plain explode makes Spark filter on the array's size first, computing the whole chain of passes many times.
    rows = df.select(*carry, F.explode_outer("fp").alias("fp"))
    return rows.select(*carry, F.shiftright("fp", PLACE_BITS).alias("hash"), (F.lit(_LAST) - F.col("fp").bitwiseAND(F.lit(_LAST))).cast("int").alias("place"))


def windows(benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """Distinct windows (span, text, items) of a benchmark (item_id, text): ``span`` words, or all words of a shorter item."""
    cut = benchmark.select("item_id", words(F.col("text")).alias("w")).filter("size(w) > 0")
    sized = cut.withColumn("span", F.least(F.size("w"), F.lit(span)))
    each = sized.select("item_id", "span", "w", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("span") + 1)).alias("i"))
    text = each.select("item_id", "span", F.array_join(F.slice("w", F.col("i"), F.col("span")), " ").alias("text"))
    return text.groupBy("span", "text").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted as strings) and contaminated, for every row of ``docs`` (doc_id, text).

    A word is hit if it lies in an occurrence of a benchmark window; a document is contaminated if a twentieth of its
    words or more are hit. Null and empty texts have no words and no hits. Repeated documents are judged each by itself,
    also if they share a doc_id; an item that stands in the benchmark twice counts once, and one without an id counts
    for hits alone. Either table may be empty. Only the named columns are read.
    """
    known = keep(windows(benchmark, span), "windows")
    # Windows of the same items share a set, so that documents carry set names and not item lists.
    sets = known.select(F.sha2(F.to_json("items"), 256).alias("set"), "items").distinct()
    named = known.select("span", "text", F.sha2(F.to_json("items"), 256).alias("set"))
    spans = sorted(r["span"] for r in named.select("span").distinct().collect())  # at most ``span`` values
    hits = None
    for n in spans:
        own = named.filter(F.col("span") == n)
        printed = _exploded(fingerprints(own.withColumn("words", F.split("text", " ")), n), "text", "set")
        entry = F.struct(F.lit(n).alias("span"), F.col("place"), "text", "set")
        index = keep(printed.groupBy("hash").agg(F.collect_list(entry).alias("windows")), "index")
        weight = F.aggregate("windows", F.lit(0).cast("long"), lambda a, w: a + 128 + F.octet_length(w["text"]))
        if index.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0] <= BROADCAST_BYTES:
            index = F.broadcast(index)
        found = _exploded(fingerprints(docs.select("doc_id", words(F.col("text")).alias("words")), n), "doc_id").join(index, "hash")
        starts = F.transform("windows", lambda w: F.struct((F.col("place") - w["place"]).alias("start"), w["span"].alias("span"), w["text"].alias("text"), w["set"].alias("set")))
        part = found.select("doc_id", F.filter(starts, lambda w: w["start"] >= 0).alias("hits"))
        hits = part if hits is None else hits.unionAll(part)
    if hits is None:
        hits = docs.sparkSession.createDataFrame([], "doc_id long, hits array<struct<start:int,span:int,text:string,set:string>>")
        hits = hits.withColumn("doc_id", F.col("doc_id").cast(docs.schema["doc_id"].dataType))
    grouped = keep(hits.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("hits"))).alias("hits")), "hits")
    # A merge join at every size: hits grow with the documents. Texts are exchanged, which are smaller than their words.
    own = grouped.withColumnRenamed("doc_id", "_id").hint("merge")
    joined = docs.select("doc_id", "text").join(own, F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    joined = joined.select("doc_id", words(F.col("text")).alias("w"), "hits")
    same = F.filter("hits", lambda h: F.array_join(F.slice("w", h["start"] + 1, h["span"]), " ") == h["text"])
    sized = joined.select("doc_id", F.size("w").cast("long").alias("n_words"), F.coalesce(same, F.array()).alias("hits"))
    spread = F.array_sort(F.transform("hits", lambda h: F.struct(h["start"].alias("a"), (h["start"] + h["span"]).alias("b"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    union = F.aggregate(
        spread, start, lambda u, h: F.struct((u["n"] + F.greatest(F.lit(0), h["b"] - F.greatest(u["end"], h["a"]))).alias("n"), F.greatest(u["end"], h["b"]).alias("end"))
    )
    judged = sized.select(
        "doc_id", "n_words", union["n"].cast("long").alias("n_hit"), F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["set"]))).alias("sets")
    )
    judged = keep(judged, "judged")
    # Items of each distinct list of sets, joined back to the rows that have hits.
    lists = judged.filter("size(sets) > 0").select("sets").distinct()
    each = lists.select("sets", F.explode("sets").alias("set")).join(sets, "set")
    items = each.groupBy("sets").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    clean = judged.filter("size(sets) = 0").select("doc_id", "n_words", "n_hit", F.array().cast("array<string>").alias("items"))
    dirty = judged.filter("size(sets) > 0").join(items, "sets").select("doc_id", "n_words", "n_hit", "items")
    return clean.unionAll(dirty).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        "items",
        ((F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"),
    )
