"""Documents in compressed chunks, and messages between chunks and hash blocks.

Operators that compare all documents read the texts several times. They are written once, as rows that hold a few
thousand documents each, in a table bucketed by chunk: what other tasks find out about a chunk's documents is sent
back to it, and the table itself is never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .words import column, release, slices

CHUNK_BYTES = 4 << 20
CHUNK_DOCS = 1 << 20
REF_BITS = 23  # a document's reference is its chunk, then these bits for its place there
SCHEMA = "chunk long, docs int, blob binary"
REPLY = "chunk long, kind int, block long, data binary, more binary"


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table.combine_chunks())
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all().combine_chunks()


def _chunked(chunk_bytes: int):
    def run(batches):
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 20
        held, size, docs = [], 0, 0

        def row() -> pa.RecordBatch:
            table = pa.concat_tables(held)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int64()), pa.array([table.num_rows], pa.int32()), pa.array([packed(table)], pa.binary())], ["chunk", "docs", "blob"]
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            sizes = pc.fill_null(pc.binary_length(column(batch, "text")), 0).to_numpy(zero_copy_only=False)
            for a, b in slices(sizes, chunk_bytes):
                own = int(sizes[a:b].sum())
                if held and (size + own > chunk_bytes or docs + b - a > CHUNK_DOCS):
                    yield row()
                    held, size, docs, chunk = [], 0, 0, chunk + 1
                held.append(table.slice(a, b - a))
                size, docs = size + own, docs + b - a
        if held:
            yield row()

    return run


def write_chunks(docs: DataFrame, label: str, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """All columns of ``docs`` in chunks of about ``chunk_bytes`` of text, as a table bucketed by chunk."""
    spark = docs.sparkSession
    chunks = docs.mapInArrow(_chunked(chunk_bytes), SCHEMA)
    name = f"{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = chunks.write.format("parquet").bucketBy(buckets, "chunk").option("compression", "uncompressed")
    writer.option("path", f"{scratch_dir(spark, label)}/chunks").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and ``table`` keeps reading them
    return table


def with_replies(chunks: DataFrame, replies: DataFrame, fn: Callable[[int, pa.Table, list[dict]], Iterator[pa.Table] | pa.Table], schema: str) -> DataFrame:
    """``fn(chunk, documents, replies)`` for every chunk, whether or not it got replies (rows of ``REPLY``)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return _EMPTY(schema)
        out = fn(left.column("chunk")[0].as_py(), unpacked(left.column("blob")[0].as_py()), right.to_pylist())
        release()
        return out

    return chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(run, schema)


def _EMPTY(schema: str) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema)).empty_table()


def each_chunk(chunks: DataFrame, fn: Callable[[int, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``fn(chunk, documents)`` for every chunk."""

    def run(batches):
        for batch in batches:
            for chunk, blob in zip(batch.column("chunk").to_pylist(), batch.column("blob")):
                yield from fn(chunk, unpacked(blob.as_py())).to_batches()
                release()

    return chunks.select("chunk", "blob").mapInArrow(run, schema)


def place_replies(places: DataFrame, kind: int) -> DataFrame:
    """One reply per chunk with its places, ascending, of ``places`` (chunk, i)."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        at = np.sort(column(table, "i").to_numpy()).astype("<i4").tobytes()
        return reply_table([key[0].as_py()], kind, [0], [at], [None])

    return places.select("chunk", "i").groupBy("chunk").applyInArrow(pack, REPLY)


def reply_table(chunk: list, kind: int, block: list, data: list, more: list) -> pa.Table:
    return pa.table(
        [pa.array(chunk, pa.int64()), pa.array([kind] * len(chunk), pa.int32()), pa.array(block, pa.int64()), pa.array(data, pa.binary()), pa.array(more, pa.binary())],
        names=["chunk", "kind", "block", "data", "more"],
    )


def no_replies(spark) -> DataFrame:
    return spark.createDataFrame([], REPLY)


# Ascending cells as gaps of two bytes; a gap of 65,535 or more takes further two bytes for each 65,535 in it.
def pack_gaps(cells: np.ndarray) -> bytes:
    gaps = np.diff(cells, prepend=-1).astype(np.int64)
    more, last = gaps // 0xFFFF, gaps % 0xFFFF
    out = np.full(int(len(gaps) + more.sum()), 0xFFFF, "<u2")
    out[np.cumsum(more + 1) - 1] = last
    return out.tobytes()


def unpack_gaps(data: bytes) -> np.ndarray:
    values = np.frombuffer(data, "<u2")
    return np.cumsum(values.astype(np.int64))[values != 0xFFFF] - 1


def by_block(blocks: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal values of an ascending array."""
    if len(blocks):
        cuts = np.flatnonzero(np.diff(blocks)) + 1
        for a, b in zip(np.concatenate(([0], cuts)), np.concatenate((cuts, [len(blocks)]))):
            yield int(blocks[a]), slice(int(a), int(b))
