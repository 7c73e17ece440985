"""The operators as registered queries over the given tables, and their SQL where SQL can say the same."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, tune
from . import automaton, chat, decontaminate, jaccard, language, negatives, packing, pages, phrases, quality, sharding, substrings, token_store
from .oracle import CONTROL_TEXT, ORACLE  # noqa: F401  the registry reads ORACLE
from .scratch import keep
from .words import column

BENCHMARK_SPAN = 13
SHARDS = 24


def vocabulary() -> str:
    """The tokenizer that the queries use; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{path.rstrip('/')}/{name}.parquet")


def op1_token_store(spark: SparkSession, path: str) -> DataFrame:
    store = f"{scratch_dir(spark, 'token-store')}/store"
    token_store.write_store(_table(spark, path, "documents"), store, vocabulary(), end_id=0, added=True)
    got = token_store.read_documents(spark, store)
    return got.select("doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op2_page_text(spark: SparkSession, path: str) -> DataFrame:
    return pages.extract(_table(spark, path, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op3_substring_dedup(spark: SparkSession, path: str) -> DataFrame:
    out = substrings.remove_repeats(_table(spark, path, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_decontaminate(spark: SparkSession, path: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, path, "documents"), _table(spark, path, "benchmark"), BENCHMARK_SPAN)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op5_histogram_shards(spark: SparkSession, path: str) -> DataFrame:
    size = F.octet_length(F.coalesce(F.col("text"), F.lit(""))) + 8
    out = sharding.shard(_table(spark, path, "documents").select("doc_id", "text"), SHARDS, size, tie=F.xxhash64("text"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_pack(spark: SparkSession, path: str) -> DataFrame:
    packed = packing.pack(_table(spark, path, "documents"), vocabulary(), capacity=1024, end_id=2, added=True)
    return packed.places.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_language(spark: SparkSession, path: str) -> DataFrame:
    docs = _table(spark, path, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    marked = docs.select("doc_id", "text", "lang", F.coalesce(held_out, F.lit(False)).alias("held_out"))
    model = language.train(marked.filter(~F.col("held_out")))
    return language.identify(marked, model, ("doc_id", "held_out"))


def op8_quality(spark: SparkSession, path: str) -> DataFrame:
    got = quality.rate(_table(spark, path, "documents"), _table(spark, path, "labels"))
    return got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def _read_chat(batches):
    """Digests of conversations whose segments come in order; a conversation may be longer than memory."""
    own, key, turns, seen, loss, points, chars = False, None, 0, hashlib.sha256(), hashlib.sha256(), 0, 0

    def row():
        return dict(conv_id=key, n_turns=turns, turns_sha256=seen.hexdigest(), loss_chars=points, loss_sha256=loss.hexdigest(), formatted_chars=chars)

    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    for batch in batches:
        out = []
        spans = column(batch, "loss").to_pylist()
        for conv, text, masked in zip(column(batch, "conv_id").to_pylist(), column(batch, "formatted").to_pylist(), spans):
            if own and conv != key:
                out.append(row())
            if not own or conv != key:
                own, key, turns, seen, loss, points, chars = True, conv, 0, hashlib.sha256(), hashlib.sha256(), 0, 0
            for role, said in chat.parse(text):
                turns += 1
                seen.update(f"{role}\n{said}\n".encode())
            raw = text.encode()
            for s in masked:
                said = chat.unescape(raw[s["start"] : s["end"]].decode())
                points += len(said)
                loss.update(said.encode())
            chars += len(text)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)
    if own:
        yield pa.RecordBatch.from_pylist([row()], schema=schema)


def op9_chat(spark: SparkSession, path: str) -> DataFrame:
    turns = _table(spark, path, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", CONTROL_TEXT), (-1, 1, "assistant", CONTROL_TEXT)], turns.schema)
    formatted = keep(chat.format_chat(turns.unionAll(extra)), "chat")
    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment")
    return ordered.mapInArrow(_read_chat, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def op10_jaccard_components(spark: SparkSession, path: str) -> DataFrame:
    return jaccard.linked(_table(spark, path, "documents"), size=5, percent=80)


def op11_hard_negatives(spark: SparkSession, path: str) -> DataFrame:
    rows = _table(spark, path, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", moved), "vec_id % 100 = 0")


def op12_bpe_automaton(spark: SparkSession, path: str) -> DataFrame:
    coded = automaton.encode(_table(spark, path, "documents").select("doc_id", "text"), vocabulary()).select("doc_id", "ids")
    back = automaton.decode(coded, vocabulary())
    return back.select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


def op13_phrases(spark: SparkSession, path: str) -> DataFrame:
    return phrases.collocations(_table(spark, path, "documents"), least=100, limit=2000)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_store,
        op2_page_text,
        op3_substring_dedup,
        op4_decontaminate,
        op5_histogram_shards,
        op6_pack,
        op7_language,
        op8_quality,
        op9_chat,
        op10_jaccard_components,
        op11_hard_negatives,
        op12_bpe_automaton,
        op13_phrases,
    )
}