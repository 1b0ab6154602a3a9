"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

``vnodes`` points a shard cut the hash ring into arcs.  A row's place on the
ring is a hash of its doc_id; its arc's shard is its home.  Loads are bounded
by capacities that differ by one row at most and add up to all rows, so law
``rows`` holds.  Each shard keeps rows of its own arcs, in ring order, up to its
capacity; what overflows continues clockwise to the next shards with room.

The ring has 2^14 places.  Only the number of rows at each place reaches the
driver, as many figures whatever the input; it fixes which ranks at a place go
to which shard, and from which slot on.  A row's rank at its place is found by
one shuffle of (doc_id, size, checksum), without texts, over all places.  A place
of more than ``HOT`` rows, as a null or repeated doc_id makes, is cut into chunks
by a hash of the whole row and its number, so no task ranks more than about as
many; a chunk's ranks go on after those of the chunks before it.

Defined cases: a null doc_id hashes like a value of its own; a null text has
size 8 and checksum 0; repeated rows are separate rows, which may go to
different shards; which of the rows of one place move on is a tie that their hash,
then their values, decide; texts may be of any length and only their size and
checksum travel; an empty table gives an empty result; further columns, whatever
their names, are ignored by ``assign``.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

VNODES = 128
BITS = 14
#: Rows of a place that one task ranks.
HOT = 1 << 20


def owners(shards: int, vnodes: int = VNODES) -> list[int]:
    """The home shard of every place: that of the first virtual node at or after it, clockwise.

    A shard's nodes don't depend on the number of shards; of two at one place, the smaller shard keeps it."""
    nodes: dict[int, int] = {}
    for s in range(shards):
        for v in range(vnodes):
            nodes.setdefault(int.from_bytes(hashlib.sha256(f"shard {s} node {v}".encode()).digest()[:4], "big") >> (32 - BITS), s)
    home, last = [0] * (1 << BITS), nodes[min(nodes)]
    for place in reversed(range(1 << BITS)):
        last = nodes.get(place, last)
        home[place] = last
    return home


def deal(counts: list[int], home: list[int], shards: int) -> list[list[tuple[int, int, int, int]]]:
    """For each place: (first rank, end rank, shard, first slot) of the pieces its rows are cut into."""
    total = sum(counts)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    slot = [0] * shards
    pieces: list[list[tuple[int, int, int, int]]] = [[] for _ in counts]

    def take(place: int, begin: int, n: int, s: int) -> int:
        n = min(n, room[s])
        if n:
            pieces[place].append((begin, begin + n, s, slot[s]))
            room[s] -= n
            slot[s] += n
        return n

    over = []
    for place, n in enumerate(counts):  # at home first
        kept = take(place, 0, n, home[place])
        if kept < n:
            over.append((place, kept))
    border = [p for p in range(len(home)) if home[p] != home[p - 1]]  # where another shard's run begins
    after, at = [0] * len(home), border[0] if border else 0
    for p in reversed(range(len(home))):
        after[p] = at
        if border and home[p] != home[p - 1]:
            at = p
    for place, begin in over:  # then clockwise, past each other shard's nodes
        at, met = place, {home[place]}
        while begin < counts[place]:
            at = after[at]
            if home[at] not in met:
                met.add(home[at])
                begin += take(place, begin, counts[place] - begin, home[at])
    return pieces


def assign(docs: DataFrame, shards: int = 24, vnodes: int = VNODES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, home, shard, slot): law rows."""
    home = owners(shards, vnodes)
    raw = F.encode(F.coalesce(F.col(text_col), F.lit("")), "utf-8")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("null"))).alias("point"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "ring").withColumn("place", F.shiftrightunsigned("point", 64 - BITS).cast("int"))
    found = {r["place"]: r["count"] for r in rows.groupBy("place").count().collect()}  # 2^BITS figures at most
    pieces = deal([found.get(p, 0) for p in range(1 << BITS)], home, shards)
    table = rows.sparkSession.createDataFrame([(p, b, e, s, t, home[p]) for p, own in enumerate(pieces) for b, e, s, t in own], "place int, begin long, end long, shard int, first long, home int")
    met = ranked(rows, [(p, -(-n // HOT)) for p, n in found.items() if n > HOT]).join(F.broadcast(table), "place").where("rank >= begin and rank < end")  # as many rows as places and shards
    return met.select("doc_id", "size", "text_crc32", "home", "shard", (F.col("first") + F.col("rank") - F.col("begin")).alias("slot"))


def ranked(rows: DataFrame, hot: list[tuple[int, int]]) -> DataFrame:
    """rows with rank, from 0, at their place; hot: places and the chunks that their rows are ranked in."""
    own = ["doc_id", "size", "text_crc32"]
    at = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy("point", *own)) - 1
    if not hot:
        return rows.withColumn("rank", at("place"))
    chunks = F.broadcast(rows.sparkSession.createDataFrame(hot, "place int, chunks long"))  # at most as many rows as places
    cut = rows.join(chunks, "place", "left").withColumn("chunk", F.coalesce(F.pmod(F.xxhash64(*own, "row"), F.col("chunks")), F.lit(0)))
    sizes = cut.where("chunks is not null").groupBy("place", "chunk").agg(F.count(F.lit(1)).alias("n"))  # a row for each HOT rows of the input
    before = F.sum("n").over(Window.partitionBy("place").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select("place", "chunk", F.coalesce(before, F.lit(0)).alias("before"))
    return cut.withColumn("at", at("place", "chunk")).join(sizes, ["place", "chunk"], "left").withColumn("rank", F.col("at") + F.coalesce("before", F.lit(0)))
