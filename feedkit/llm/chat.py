"""Conversations as training text, assembled by column.

Every byte of the output has a computed place: segment lengths give cumulative offsets, offsets give scatter indices,
and headers and contents are copied into one buffer that becomes the Arrow column.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import column, text_slices

START, END = "<|im_start|>", "<|im_end|>"
#: Strings that a template or a model gives meaning to. None has the first character of another inside it.
CONTROL = (START, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_ANY = "(" + "|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)) + ")"
_ESCAPE = r"(\\*" + _ANY + ")"
_TURN = re.compile(rf"(?<!\\){re.escape(START)}(.*?)\n(.*?)\n(?<!\\){re.escape(END)}\n", re.S)

SCHEMA = "conv_id long, part int, segment int, n_turns int, formatted string, loss array<struct<start:int,end:int>>"
SEGMENT_TURNS = 512


def escape(texts: pa.Array) -> pa.Array:
    """One backslash before every control string, and before any backslashes that lead up to it."""
    return pc.replace_substring_regex(pc.fill_null(texts, "").cast(pa.large_string()), _ESCAPE, r"\\\1")


def unescape(text: str) -> str:
    return re.sub(r"\\(\\*" + _ANY + ")", r"\1", text)


def escape_role(roles: pa.Array) -> pa.Array:
    """Roles end at the line's end, so a line feed in one is written as a backslash and n."""
    roles = pc.replace_substring(escape(roles), "\\", "\\\\")
    return pc.replace_substring(roles, "\n", "\\n")


def unescape_role(role: str) -> str:
    return unescape(re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], role))


def assemble(segments: list[pa.Array]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of rows whose parts are the given columns, one after another: the buffer, each part's offset, each part's length."""
    n = len(segments[0])
    held = []
    for s in segments:
        _, offsets, data = s.buffers()
        bounds = np.frombuffer(offsets, np.int64)[s.offset : s.offset + n + 1]
        held.append((bounds, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)))
    lengths = np.stack([np.diff(b) for b, _ in held], axis=1)
    flat = lengths.reshape(-1)
    offsets = (np.cumsum(flat) - flat).reshape(lengths.shape)
    out = np.empty(int(flat.sum()), np.uint8)
    for k, (bounds, data) in enumerate(held):
        size = lengths[:, k]
        total = int(size.sum())
        if total:
            shift = np.repeat(offsets[:, k] - (np.cumsum(size) - size), size)
            out[np.arange(total) + shift] = data[int(bounds[0]) : int(bounds[-1])]
    return out, offsets, lengths


def _constant(text: str, n: int) -> pa.Array:
    size = len(text.encode())
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.arange(n + 1, dtype=np.int64) * size), pa.py_buffer(text.encode() * n))


def _format(segment_turns: int, loss_role: str):
    def run(batches):
        from pyspark import TaskContext

        part, segment = TaskContext.get().partitionId(), 0
        for batch in batches:
            for a, b in text_slices(column(batch, "text"), 4 << 20):
                n = b - a
                conv = column(batch, "conv_id").slice(a, n)
                role = pc.fill_null(column(batch, "role").slice(a, n), "")
                parts = [_constant(START, n), escape_role(role), _constant("\n", n), escape(column(batch, "text").slice(a, n)), _constant(f"\n{END}\n", n)]
                buffer, offsets, lengths = assemble(parts)
                keys = pc.fill_null(conv, -(1 << 63)).to_numpy(zero_copy_only=False)
                null = conv.is_null().to_numpy(zero_copy_only=False)
                new = np.ones(n, bool)
                new[1:] = (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])
                first = np.flatnonzero(new)
                size = np.diff(np.append(first, n))
                # A conversation of many turns is cut into segments of bounded length.
                cuts = (size + segment_turns - 1) // segment_turns
                begin = np.repeat(first, cuts) + (np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)) * segment_turns
                turns = np.diff(np.append(begin, n))
                at = np.append(offsets[begin, 0], len(buffer))
                text = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(at), pa.py_buffer(buffer)).cast(pa.string())
                loss = np.flatnonzero(pc.equal(role, loss_role).to_numpy(zero_copy_only=False))
                of = np.searchsorted(begin, loss, "right") - 1
                lo = offsets[loss, 3] - at[of]
                spans = pa.StructArray.from_arrays(
                    [pa.array(lo, pa.int32()), pa.array(lo + lengths[loss, 3], pa.int32())], fields=[pa.field("start", pa.int32()), pa.field("end", pa.int32())]
                )
                per = np.searchsorted(of, np.arange(len(begin) + 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        conv.take(pa.array(begin)).cast(pa.int64()),
                        pa.array(np.full(len(begin), part), pa.int32()),
                        pa.array(segment + np.arange(len(begin)), pa.int32()),
                        pa.array(turns, pa.int32()),
                        text,
                        pa.ListArray.from_arrays(pa.array(per, pa.int32()), spans),
                    ],
                    ["conv_id", "part", "segment", "n_turns", "formatted", "loss"],
                )
                segment += len(begin)

    return run


def format_chat(turns: DataFrame, loss_role: str = "assistant", segment_turns: int = SEGMENT_TURNS) -> DataFrame:
    """Format ``turns`` (conv_id, turn, role, text) as ``<|im_start|>role, text, <|im_end|>`` with the loss spans.

    Output rows are segments of a conversation: their texts in the order of (part, segment) are the conversation. Spans
    are byte offsets in a segment's UTF-8. Turns are ordered by turn, null first, then role and text, so ties have a
    defined order and repeated rows stay. Null roles and texts are empty; rows without conv_id make one conversation.
    One range exchange on conversation and turn spreads a conversation of any length over tasks.
    """
    order = ["conv_id", "turn", "role", "text"]
    ordered = turns.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.select("conv_id", "role", "text").mapInArrow(_format(segment_turns, loss_role), SCHEMA)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Turns of a segment, as they went in."""
    return [(unescape_role(m[1]), unescape(m[2])) for m in _TURN.finditer(formatted)]
