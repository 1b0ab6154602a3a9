"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at Hamming distance 4 or less have a variant in common that
lies within 2 bits of both.  Each distinct fingerprint therefore stands for its
ball of 2081 variants; fingerprints that share a variant are linked, and the
members of one variant's bucket form a clique, so a star to the smallest member
keeps every link without emitting pairs.

The ball is not shuffled variant by variant.  Variants are dealt by their top
bits, and all variants of a fingerprint with the same top bits travel as one
row (79 rows for 12 bits instead of 2081); the receiving task expands them.  A
prefix that more than ``CROWD`` fingerprints have is dealt by ``STEP`` more
bits, and so on, so a task holds few fingerprints however many there are; of
these it expands ``CHUNK`` variants at once.

Joins on nodes and roots may meet hubs.  Keys with more than 1 / ``SHARE`` of
all rows, of which there can be no more than ``SHARE``, are broadcast, so their
rows stay where they are; only the others are shuffled.

Defined cases: a null text counts as empty; texts may be of any length; a text
without words has the zero fingerprint and links like any other; repeated rows
each get a result row; a null doc_id takes part in links but is never a
component's smallest id (null only where a whole component has none); among
rows that tie for a component's place the first stored stays; an empty table
gives an empty result; further columns of the input are ignored by
``near_duplicates`` and kept by ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import aside, discard, restored, small_batches, stored

RADIUS, SHINGLE, SEED = 4, 4, 42
ROUTE_BITS, CHUNK = 12, 1 << 21
#: Fingerprints of one prefix beyond which it is dealt by STEP more bits, up to MOST_BITS; parts of all rows beyond which a key is a hub.
CROWD, STEP, MOST_BITS, SHARE = 1 << 17, 6, 48, 256


def hashes(text: str, words: int = SHINGLE) -> np.ndarray:
    """XXH64 of every shingle, repeats included."""
    found = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only ASCII white space splits
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    k = min(words, len(found))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(found) - k + 1].tolist()
    h, seed = xxhash.xxh64_intdigest, SEED
    return np.fromiter((h(joined[a:b], seed) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)), np.uint64, len(starts))


def majority(h: np.ndarray, block: int = 1 << 16) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), block):
        counts += np.unpackbits(h[at : at + block].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", more: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp): the 64-bit fingerprint of each row as a signed long; and further columns of longs."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fp = np.array([majority(hashes(x.as_py() or "")) for x in part.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp, pa.int64()), *part.columns[2:]], ["doc_id", "fp", *more])

    small_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *more).mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *more)))


@cache
def masks(bits: int, most: int) -> np.ndarray:
    """Every mask of the low bits with at most so many set."""
    return np.array([sum(1 << b for b in x) for n in range(most + 1) for x in combinations(range(bits), n)], np.uint64)


def expected(fp: np.ndarray, left: np.ndarray, bits: int) -> int:
    return sum(int((left == j).sum()) * len(masks(bits, j)) for j in np.unique(left).tolist())


def stars(fp: np.ndarray, left: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among fingerprints whose variants share all but the low bits; left: the flips that each may still make there."""
    if len(fp) < 2:
        return
    if bits > 4 and expected(fp, left, bits) > CHUNK:
        nib = (fp >> np.uint64(bits - 4)) & np.uint64(15)
        for c in range(16):
            rest = left - np.bitwise_count(nib ^ np.uint64(c)).astype(np.int64)
            yield from stars(fp[rest >= 0], rest[rest >= 0], bits - 4)
        return
    low = fp & np.uint64((1 << bits) - 1)
    got, own = [], []
    for j in np.unique(left).tolist():
        at = np.flatnonzero(left == j)
        m = masks(bits, j)
        got.append((low[at, None] ^ m[None, :]).ravel())
        own.append(np.repeat(at.astype(np.uint32), len(m)))
    variants, owner = np.concatenate(got), np.concatenate(own)
    order = np.argsort(variants)
    variants = variants[order]
    same = variants[1:] == variants[:-1]
    if not same.any():
        return
    inside = np.concatenate((same, [False])) | np.concatenate(([False], same))
    first = np.flatnonzero(inside & ~np.concatenate(([False], same)))  # of each bucket with two members or more
    size = np.diff(np.append(np.cumsum(inside)[first] - 1, inside.sum()))
    member = fp[owner[order[inside]]].view(np.int64)
    root = np.repeat(np.minimum.reduceat(member, np.cumsum(inside)[first] - 1), size)
    pairs = np.unique(np.stack((member, root), 1)[member != root], axis=0)
    ok = np.bitwise_count((pairs[:, 0] ^ pairs[:, 1]).view(np.uint64)) <= RADIUS  # verified, whatever made them collide
    yield contracted(pairs[ok])


def contracted(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same components as one link from each member to its smallest."""
    nodes, ends = np.unique(pairs, return_inverse=True)
    a, b = ends.reshape(-1, 2).T
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def crowded(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Bits to the sorted prefixes of so many bits that over CROWD fingerprints have: at most 1 / CROWD of their number for each."""
    found: dict[int, np.ndarray] = {}
    for bits in range(ROUTE_BITS, MOST_BITS, STEP):
        top = F.shiftrightunsigned("fp", 64 - bits)
        rows = distinct.groupBy(top.alias("top")).count().where(F.col("count") > CROWD).select("top").collect()
        if not rows:
            break
        found[bits] = np.sort(np.array([r[0] for r in rows], np.uint64))
    return found


def routes(fp: np.ndarray, crowds: dict[int, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(route, index in fp): where variants within half the radius go; a route holds its number of bits in its top byte."""
    at, top = np.arange(len(fp)), np.zeros(len(fp), np.uint64)
    left = np.full(len(fp), RADIUS // 2)
    bits = 0
    while len(at):
        step = STEP if bits else ROUTE_BITS
        bits += step
        own = (fp[at] >> np.uint64(64 - bits)) & np.uint64((1 << step) - 1)
        parts = []
        for j in np.unique(left).tolist():
            mine, m = np.flatnonzero(left == j), masks(step, j)
            parts.append((np.repeat(mine, len(m)), (own[mine, None] ^ m[None, :]).ravel(), np.repeat(j, len(mine) * len(m)) - np.tile(np.bitwise_count(m), len(mine)).astype(np.int64)))
        which, low, left = (np.concatenate(x) for x in zip(*parts, strict=True))
        at, top = at[which], (top[which] << np.uint64(step)) | low
        full = np.isin(top, crowds[bits]) if bits in crowds else np.zeros(len(at), bool)
        yield (top[~full] | np.uint64(bits << 56)).view(np.int64), at[~full]
        at, top, left = at[full], top[full], left[full]


def links(distinct: DataFrame) -> DataFrame:
    """(hi, lo): links between distinct fingerprints that keep every component of the relation 'at most RADIUS bits apart'."""
    crowds = crowded(distinct)

    def emit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            fp = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for begin in range(0, len(fp), 4096):
                x = fp[begin : begin + 4096]
                for route, at in routes(x.view(np.uint64), crowds):
                    yield pa.RecordBatch.from_arrays([pa.array(route), pa.array(x[at])], ["route", "fp"])

    def group(route: int, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        bits = route >> 56
        top = np.uint64(route & ((1 << 56) - 1))
        left = RADIUS // 2 - np.bitwise_count((fp.view(np.uint64) >> np.uint64(64 - bits)) ^ top).astype(np.int64)
        for hi, lo in stars(fp.view(np.uint64), left, 64 - bits):
            yield pa.RecordBatch.from_arrays([pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], ["hi", "lo"])

    def collide(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = -1, []
        for part in parts:
            route, fp = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            cut = np.flatnonzero(np.diff(route)) + 1
            for r, x in zip(route[np.concatenate(([0], cut))].tolist() if len(route) else [], np.split(fp, cut), strict=False):
                if r != now and held:
                    yield from group(now, np.concatenate(held))
                    held = []
                now = r
                held.append(x.astype(np.int64))
        if held:
            yield from group(now, np.concatenate(held))

    dealt = distinct.select("fp").mapInArrow(emit, "route long, fp long").repartition("route").sortWithinPartitions("route")
    return dealt.mapInArrow(collide, "hi long, lo long").distinct()


def matched(rows: DataFrame, own: DataFrame, key: str, total: int) -> DataFrame:
    """rows joined with own, which has one row for each key and in n the number of rows of that key; total: all rows.  Hubs don't move."""
    hubs = F.broadcast(own.where(F.col("n") * SHARE > total).drop("n"))  # at most SHARE rows
    rest = own.where(F.col("n") * SHARE <= total).drop("n")
    return rows.join(hubs, key).unionByName(rows.join(hubs.select(key), key, "left_anti").join(rest, key))


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root): alternating large-star and small-star steps until nothing changes; root is a component's smallest node.

    Each step's edges are a table in the shared folder; only a count and a checksum reach the driver."""

    def sign(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo")), F.sum(F.hash("hi", "lo").cast("long"))).first())

    n = F.count(F.lit(1)).alias("n")
    now = stored(edges.where("hi <> lo").select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct(), "links")
    before = sign(now)
    for _ in range(most):
        both = now.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(now.select("lo", "hi"))
        least = both.groupBy("u").agg(F.min("v").alias("m"), n).select("u", F.least("u", "m").alias("m"), "n")
        large = stored(matched(both, least, "u", 2 * before[0]).where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct(), "large")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"), n)
        met = matched(large, least, "hi", before[0])
        small = met.select("hi", F.col("m").alias("lo")).union(met.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))).distinct()
        old, now = now, stored(small, "stars")
        after = sign(now)
        discard(old)
        discard(large)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("root")).union(now.select("lo", "lo").distinct())


def least_of_components(distinct: DataFrame, value: str) -> DataFrame:
    """(fp, value): for each fingerprint of distinct (fp, value) the smallest value of its component."""
    root = stored(components(links(distinct.select("fp"))).withColumnRenamed("node", "fp"), "roots")
    own = distinct.join(root, "fp")
    least = stored(own.groupBy("root").agg(F.min(value).alias("least"), F.count(F.lit(1)).alias("n")), "least")
    joined = matched(root, least, "root", root.count()).select("fp", F.col("least").alias(value))
    return joined.union(distinct.join(root.select("fp"), "fp", "left_anti").select("fp", value))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id: the smallest doc_id reachable over links, itself included."""
    fps = stored(fingerprints(docs, id_col, text_col), "fingerprints")
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("n")), "distinct")
    found = least_of_components(distinct.select("fp", "component_id"), "component_id").join(distinct.select("fp", "n"), "fp")
    return matched(fps, found, "fp", fps.count()).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, whatever its ids: that of the smallest doc_id, one without a doc_id only if no row has one, the first stored of several.

    Rows are told apart by a number that is written with them, so null and repeated ids neither lose a component nor meet in one task."""
    key = "__foliomill_row"
    docs, names = aside(docs, [key])
    numbered = stored(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
    fps = stored(fingerprints(numbered, names["doc_id"], names["text"], (key,)), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", key)).alias("first")
    distinct = stored(fps.groupBy("fp").agg(first), "distinct")
    chosen = least_of_components(distinct, "first").select(F.col(f"first.{key}").alias(key)).distinct()
    return restored(numbered.join(chosen, key, "left_semi"), names)
