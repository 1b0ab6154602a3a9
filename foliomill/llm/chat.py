"""Chat formatting by columnar byte assembly.

A turn is ``<s>[INST] role [/INST] text</s>`` and a line feed; a conversation is
its turns in order.  Control strings inside roles and texts get a backslash
after their bracket, those that look escaped get one more, so reading back is
exact.  Rows are dealt by conversation and sorted; each task takes whole
conversations, computes segment lengths, cumulative offsets and scatter indices
in numpy, and copies headers and texts into one preallocated buffer, which
becomes the Arrow column as it is.

Defined cases: a null text or role is empty; rows of a null conv_id are one
conversation; turns that tie are ordered by role, then text; repeated rows are
repeated turns; null turns come first; an empty table gives an empty result;
further columns are ignored.  A conversation must fit a Spark string; its own
rows are all that a task has to hold beside ``BLOCK`` bytes.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, NAMED, CLOSE = "<s>[INST] ", " [/INST] ", "</s>\n"
LEARN = ("assistant",)
BLOCK = 1 << 25


def escaped(column: pa.Array) -> pa.Array:
    for bracket, name in (("<", r"/?s>"), (r"\[", r"/?INST\]")):
        column = pc.replace_substring_regex(column, rf"({bracket})(\\*{name})", r"\1\\\2")
    return column


def unescaped(text: str) -> str:
    return re.sub(r"(?:(<)\\(?=\\*/?s>)|(\[)\\(?=\\*/?INST\]))", lambda m: m[1] or m[2], text)


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its values."""
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8)), at


def scattered(out: np.ndarray, to: np.ndarray, data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
    """Copy each data[begin:begin+size] to out[to:]."""
    total = int(size.sum())
    within = np.arange(total) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(to, size) + within] = data[np.repeat(begin, size) + within]


def assembled(role: pa.Array, text: pa.Array, first: np.ndarray, learn: tuple[str, ...] = LEARN) -> tuple[pa.Array, pa.Array, pa.Array]:
    """One formatted string and its loss spans (code points) for each conversation; first: the row at which each begins."""
    role, text = (pc.fill_null(x, "") for x in (role, text))
    names, body = escaped(role), escaped(text)
    spoken = pc.dictionary_encode(names)
    heads = pa.array([OPEN + (x.as_py() or "") + NAMED for x in spoken.dictionary], pa.string())
    head_data, head_at = bytes_of(heads)
    body_data, body_at = bytes_of(body)
    tail = np.frombuffer(CLOSE.encode(), np.uint8)
    which = spoken.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(role)
    size = np.empty((n, 3), np.int64)
    size[:, 0], size[:, 1], size[:, 2] = np.diff(head_at)[which], np.diff(body_at), len(tail)
    ends = np.cumsum(size.ravel())
    starts = (ends - size.ravel()).reshape(n, 3)
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    scattered(out, starts[:, 0], head_data, head_at[:-1][which], size[:, 0])
    scattered(out, starts[:, 1], body_data, body_at[:-1], size[:, 1])
    scattered(out, starts[:, 2], tail, np.zeros(n, np.int64), size[:, 2])
    row_ends = np.append(first[1:], n)
    cut = np.concatenate((starts[first, 0], [len(out)])) if n else np.zeros(1, np.int64)
    formatted = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(cut.astype(np.int64)), pa.py_buffer(out)]).cast(pa.string())
    # loss spans: bytes to code points, counted from the conversation's start
    points = np.concatenate(([0], np.cumsum((out & 0xC0) != 0x80)))
    taught = pc.is_in(role, pa.array(learn)).to_numpy(zero_copy_only=False)
    conv = np.repeat(np.arange(len(first)), row_ends - first)
    base = points[cut[:-1]][conv] if n else points[:0]
    begin, end = (points[starts[:, 1]] - base)[taught], (points[starts[:, 1] + size[:, 1]] - base)[taught]
    offsets = pa.array(np.concatenate(([0], np.cumsum(np.bincount(conv[taught], minlength=len(first))))), pa.int32())
    return formatted, pa.ListArray.from_arrays(offsets, pa.array(begin, pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(end, pa.int64()))


OUT = ["conv_id", "n_turns", "formatted", "loss_begin", "loss_end"]


def format_conversations(rows: DataFrame, learn: tuple[str, ...] = LEARN) -> DataFrame:
    """(conv_id, n_turns, formatted, loss_begin, loss_end): one row for each conversation; spans of texts to learn from, in code points."""

    def build(part: pa.Table) -> pa.RecordBatch:
        part = part.combine_chunks()
        conv, role, text = (part.column(c).chunk(0) if part.num_rows else part.column(c).combine_chunks() for c in ("conv_id", "role", "text"))
        key = pc.fill_null(conv, 0).to_numpy(zero_copy_only=False)
        null = pc.is_null(conv).to_numpy(zero_copy_only=False)
        new = np.concatenate(([True], (key[1:] != key[:-1]) | (null[1:] != null[:-1])))
        first = np.flatnonzero(new)
        formatted, begin, end = assembled(role, text, first, learn)
        turns = np.diff(np.append(first, len(key)))
        return pa.RecordBatch.from_arrays([conv.take(pa.array(first)), pa.array(turns, pa.int64()), formatted, begin, end], OUT)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for part in parts:
            if not part.num_rows:
                continue
            held.append(part)
            if sum(x.nbytes for x in held) < BLOCK:
                continue
            whole = pa.Table.from_batches(held)
            conv = whole.column("conv_id")
            last = conv[-1].as_py()
            same = pc.is_null(conv) if last is None else pc.fill_null(pc.equal(conv, last), False)
            at = pc.index(same, True).as_py()  # the last conversation may go on
            if at:
                yield build(whole.slice(0, at))
            held = whole.slice(at).to_batches()
        if held:
            yield build(pa.Table.from_batches(held))

    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    dealt = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return dealt.mapInArrow(run, "conv_id long, n_turns long, formatted string, loss_begin array<long>, loss_end array<long>")


TURN = re.compile(re.escape(OPEN) + "(.*?)" + re.escape(NAMED) + "(.*?)" + re.escape(CLOSE), re.S)


def turns(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back."""
    return [(unescaped(m[1]), unescaped(m[2])) for m in TURN.finditer(formatted)]


def digests(done: DataFrame) -> DataFrame:
    """What the formatted column says when it is read back: turns and the text under the loss mask."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            cols: dict[str, list] = {k: [] for k in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
            for conv, text, begin, end in zip(*(part.column(i).to_pylist() for i in range(4)), strict=True):
                read = turns(text)
                loss = "".join(unescaped(text[a:b]) for a, b in zip(begin, end, strict=True))
                hexed = lambda x: hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest()
                for k, v in zip(cols, (conv, len(read), hexed("".join(f"{r}\n{t}\n" for r, t in read)), len(loss), hexed(loss), len(text)), strict=True):
                    cols[k].append(v)
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(cols.values(), types, strict=True)], list(cols))

    return done.select("conv_id", "formatted", "loss_begin", "loss_end").mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
