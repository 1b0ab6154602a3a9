"""Prefix trie of conversations: sort them, and read the tree off the LCP array.

A turn is a unit of 20 bytes: 128 bits of its SHA-256 and the code points of its
text.  A conversation's units in order are its key, and keys sorted as bytes put
conversations with a common beginning side by side.  Equal conversations are one
row with a count, so a conversation that many repeat is no hot group.

Sorted keys lie in blocks, one for each partition of a range partitioning.  The
LCP array says how many units a key shares with the one before it.  A node of
depth d spans from the key at which the LCP was last below d to the next at
which it is again: its nearest smaller values.  Within a block one pass with a
stack finds them, merges nodes of equal LCP and adds a node for each missing
depth; the values to be summed over an interval are summed as intervals close.
Intervals that leave their block are met through the blocks' minima: the piece
of depth d in block b belongs to the nearest earlier block whose minimum is
below d.  Such pieces are as many as blocks times open depths; they are summed
by key.  A second pass in the same order hands each node its parent's id.

What the driver holds is one figure for each block.  The digest of the ids that
end at a node is one stream by its definition: ids are joined in groups of 4096
in parallel, and one task reads a node's groups one after another.

Defined cases: a null turn comes first; turns of one number are ordered by role,
then by unit; a null role or text is empty; rows without a conv_id belong to no
conversation and are left out; repeated rows are separate turns; a conversation
of which nothing is left belongs to the root alone; an empty table has no nodes;
further columns are ignored.  All units of one conversation are one row, 20
bytes for each turn.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

UNIT, DIGEST = 20, 16
#: Ids joined to one text: those equal but for this many low bits.
ID_BITS = 12
FAR = 2**31 - 1
NODE, OPENING, PIECE, BLOCK = range(4)
CLASSES = "key binary, n long, conv long, ends string"
FOLDED = "kind int, block int, pos long, depth int, open boolean, conv long, n long, children long, leaves long, saved long, size long, ends string"
TRIE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_ARROW = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(name, _ARROW[kind]) for name, kind in (x.split(" ") for x in text.split(", "))])


def _flushed(rows: Iterable[tuple], schema: pa.Schema, most: int = 8192) -> Iterator[pa.RecordBatch]:
    """Batches of rows, so that no task holds more than one of them."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def unit(role: Column, text: Column) -> Column:
    """A turn as 40 hexadecimal digits: two turns share it if and only if role and text are equal."""
    size = F.length(text)
    return F.concat(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * DIGEST), F.lpad(F.hex(size), 2 * (UNIT - DIGEST), "0"))


def keys(conversations: DataFrame) -> DataFrame:
    """(conv_id, key): the units of each conversation in order."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", role.alias("role"), unit(role, text).alias("unit")).alias("t"))
    return turns.groupBy("conv_id").agg(F.unhex(F.array_join(F.sort_array(F.collect_list("t")).getField("unit"), "")).alias("key"))


def rebuilt(own: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """(conv_id, key): the first h units are those of the conversation that opens the group of ``every`` ids; h is the id's crc32 modulo ``most``.

    The group of a negative id is found by a remainder that is rounded to zero."""
    first = F.col("conv_id") - F.col("conv_id") % every
    h = (F.crc32(F.encode(F.col("conv_id").cast("string"), "utf-8")) % most).cast("int")
    own = own.select("conv_id", "key", first.alias("opener"), (h * UNIT).alias("h"))
    openers = own.where("conv_id = opener").select("opener", F.substring("key", 1, (most - 1) * UNIT).alias("opening"))
    met = own.join(openers, "opener", "left")
    lent = F.coalesce(F.substring(F.col("opening"), F.lit(1), F.col("h")), F.lit(b""))
    return met.select("conv_id", F.concat(lent, F.substring(F.col("key"), F.col("h") + 1, F.lit(FAR))).alias("key"))


def classes(sequences: DataFrame) -> DataFrame:
    """(key, n, conv, ends) for each distinct key: how many conversations have it, the least of them and the digest of all."""
    ids = F.sort_array(F.collect_list("conv_id"))
    parts = sequences.groupBy("key", F.shiftright("conv_id", ID_BITS).alias("part")).agg(ids.alias("ids"))
    parts = parts.select("key", "part", F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("conv"), F.array_join(F.col("ids").cast("array<string>"), ",").alias("text"))
    return parts.repartition("key").sortWithinPartitions("key", "part").mapInArrow(_joined, CLASSES)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        now, n, conv, ends = None, 0, None, hashlib.sha256()
        for key, _, more, least, text in _rows(batches):
            if key != now:
                if now is not None:
                    yield now, n, conv, ends.hexdigest()
                now, n, conv, ends = key, 0, least, hashlib.sha256()
            ends.update((("," if n else "") + text).encode())
            n += more
        if now is not None:
            yield now, n, conv, ends.hexdigest()

    return _flushed(rows(), _schema(CLASSES))


def shared(a: bytes, b: bytes) -> int:
    """Units that two keys have in common from their beginning on."""
    most = min(len(a), len(b)) // UNIT * UNIT
    step, at = 64 * UNIT, 0
    while at < most and a[at : min(at + step, most)] == b[at : min(at + step, most)]:
        at += step
    at = min(at, most)
    while at < most and a[at : at + UNIT] == b[at : at + UNIT]:
        at += UNIT
    return at // UNIT


class Open:
    """A node on the stack: what is known of it within this block."""

    __slots__ = ("children", "conv", "ends", "foreign", "leaves", "n", "pos", "saved", "size")

    def __init__(self, pos: int | None, size: int) -> None:
        self.pos, self.size, self.foreign = pos, size, pos is None
        self.n = self.children = self.leaves = self.saved = 0
        self.conv = self.ends = None


def fold(rows: Iterable[tuple]) -> Iterator[tuple]:
    """Rows of FOLDED from (block, pos, key, n, conv, ends), ordered by block and pos; at pos -1 a block has the last key of the one before it."""
    none = hashlib.sha256().hexdigest()
    block = prior = None
    least, stack = FAR, []

    def popped(ended: bool) -> tuple:
        """The deepest node leaves the stack and counts for the one above it; it is whole if it began here and doesn't reach the block's end."""
        x, depth = stack.pop(), len(stack)
        kind = PIECE if x.foreign else OPENING if ended else NODE
        if kind == NODE:
            x.saved += (x.n - 1) * x.size
            x.leaves += not x.children
        if stack:
            up = stack[-1]
            up.n, up.leaves, up.saved = up.n + x.n, up.leaves + x.leaves, up.saved + x.saved
            up.conv = x.conv if up.conv is None else min(up.conv, x.conv)
        return kind, block, x.pos, depth, ended, x.conv, x.n, x.children, x.leaves, x.saved, x.size, (None if x.foreign else x.ends or none)

    def ended() -> Iterator[tuple]:
        while stack:
            yield popped(True)
        yield BLOCK, block, None, least, None, None, None, None, None, None, None, None

    for own, pos, key, n, conv, ends in rows:
        if own != block:
            if block is not None:
                yield from ended()
            block, prior, least, stack = own, None, FAR, []
        if pos < 0:
            prior = key
            continue
        lcp = -1 if prior is None else shared(prior, key)
        if prior is not None and not stack:
            stack = [Open(None, 0) for _ in range(lcp + 1)]
        while len(stack) > lcp + 1:
            yield popped(False)
        least = min(least, lcp)
        for depth in range(lcp + 1, len(key) // UNIT + 1):
            if stack:
                stack[-1].children += 1
            stack.append(Open(pos, int.from_bytes(key[UNIT * (depth - 1) + DIGEST : UNIT * depth], "big") if depth else 0))
        stack[-1].n, stack[-1].conv, stack[-1].ends, prior = n, conv, ends, key
    if block is not None:
        yield from ended()


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _flushed(fold(_rows(batches)), _schema(FOLDED))


def blocks(own: DataFrame) -> DataFrame:
    """(block, pos, key, n, conv, ends): the classes in order, with the last key of the block before at pos -1 of each but the first."""
    own = own.repartitionByRange("key").sortWithinPartitions("key").select(F.spark_partition_id().alias("block"), F.monotonically_increasing_id().alias("pos"), "key", "n", "conv", "ends")
    own = stored(own, "sorted")
    last = own.groupBy("block").agg(F.max_by("key", "pos").alias("key"))
    there = sorted(r["block"] for r in own.select("block").distinct().collect())  # one figure for each partition
    if len(there) < 2:
        return own
    after = own.sparkSession.createDataFrame(list(zip(there, there[1:], strict=False)), "block int, after int")
    borders = last.join(F.broadcast(after), "block").select(F.col("after").alias("block"), F.lit(-1).cast("long").alias("pos"), "key")
    return own.unionByName(borders, allowMissingColumns=True)


def crossing(folded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes that reach the end of the block they began in, like those of kind NODE; and (block, pos, depth, conv) of those that are open where a block begins, at pos -1."""
    from pyspark.sql import Window

    low = {r["block"]: r["depth"] for r in folded.where(F.col("kind") == BLOCK).select("block", "depth").collect()}  # one figure for each partition
    minima = F.from_json(F.lit(json.dumps([low.get(b, FAR) for b in range(max(low, default=-1) + 1)])), "array<int>")
    # nearest smaller value to the left, over the blocks' minima
    earlier = F.array_max(F.filter(F.sequence(F.lit(0), F.col("block") - 1), lambda b: F.get(minima, b) < F.col("depth")))
    pieces = folded.where(F.col("kind").isin(OPENING, PIECE)).withColumn("owner", F.when(F.col("kind") == OPENING, F.col("block")).otherwise(earlier))
    total = pieces.groupBy("owner", "depth").agg(
        F.max("pos").alias("pos"), F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")), F.max(F.when(F.col("kind") == OPENING, F.col("size"))).alias("size"), F.max("ends").alias("ends")
    )
    total = total.withColumns({"own": (F.col("n") - 1) * F.col("size"), "leaf": (F.col("children") == 0).cast("long")})
    # what deeper nodes that began in a block, and stay open at its end, bring to those above them
    began = total.select(F.col("owner").alias("block"), "depth", "own", "leaf")
    open_ = pieces.where("open").select("block", "depth", "owner", "kind").join(began, ["block", "depth"], "left")
    mine = F.col("kind") == OPENING
    deeper = Window.partitionBy("block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each open depth
    more = open_.select("owner", "depth", F.sum(F.when(mine, F.col("own"))).over(deeper).alias("own"), F.sum(F.when(mine, F.col("leaf"))).over(deeper).alias("leaf"))
    more = more.groupBy("owner", "depth").agg(F.sum("own").alias("more_saved"), F.sum("leaf").alias("more_leaves"))
    plus = lambda *c: sum((F.coalesce(x, F.lit(0)) for x in c[1:]), F.col(c[0]))
    nodes = total.join(more, ["owner", "depth"], "left").select(
        F.col("owner").alias("block"), "pos", "depth", "conv", "n", "children", plus("leaves", "leaf", "more_leaves").alias("leaves"), plus("saved", "own", "more_saved").alias("saved"), "ends"
    )
    nodes = stored(nodes, "crossing")
    seeds = pieces.where(F.col("kind") == PIECE).select("block", "depth", "owner").join(nodes.select(F.col("block").alias("owner"), "depth", "conv"), ["owner", "depth"])
    return nodes, seeds.select("block", F.lit(-1).cast("long").alias("pos"), "depth", "conv")


def _parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        block, path = None, []
        for own, pos, depth, conv, n, children, leaves, saved, ends in _rows(batches):
            if own != block:
                block, path = own, []
            del path[depth:]
            path.append(conv)
            if pos >= 0:
                yield conv, depth, path[depth - 1] if depth else None, n, children, leaves, saved, ends

    return _flushed(rows(), _schema(TRIE))


def trie(sequences: DataFrame) -> DataFrame:
    """A row of TRIE for each distinct prefix of the keys of (conv_id, key); conv_ids are distinct."""
    rows = blocks(stored(classes(sequences), "classes"))
    folded = stored(rows.repartition("block").sortWithinPartitions("block", "pos").mapInArrow(_folded, FOLDED), "folded")
    nodes, seeds = crossing(folded)
    whole = folded.where(F.col("kind") == NODE).select(*nodes.columns).unionByName(nodes).unionByName(seeds, allowMissingColumns=True)
    return whole.repartition("block").sortWithinPartitions("block", "pos", "depth").mapInArrow(_parents, TRIE)


def prefix_trie(conversations: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """The trie of conversations that were rebuilt to share beginnings."""
    return trie(stored(rebuilt(stored(keys(conversations), "keys"), every, most), "rebuilt"))
