"""Substring dedup: suffix trees over groups of suffixes that share a prefix.

A window is ``window`` consecutive words of a text; the words of windows that
start at more than one place are removed, all copies of them.

Suffixes that can't matter never travel.  The least 8-gram of a window (by a
hash of the words) is the same wherever the window starts, so a window whose
least 8-gram stands at one place of the whole table is not repeated.  Windows
that follow each other mostly share it: such a run is one row of about 16 bytes.
8-grams are counted over all texts, and only the runs of repeated ones fetch
their words.

Those runs are dealt by that 8-gram: all suffixes that could be equal meet in
one group, and suffixes of one run share their words.  An 8-gram of more than
HEAVY runs would be too large a group; the suffixes of its runs are dealt by the
longest prefix that matters, the whole window, and as such a group's tree is a
single node, the suffixes are counted (combined in each task) instead of held.
In a group, the suffixes of all runs are ordered by prefix doubling; neighbours
that share a whole window hang below one internal node of that depth, and the
runs of such suffixes are the maximal repeats.  Word numbers stand for whole
words, so no hash decides equality of what is removed (the counted windows are
compared by SHA-256).

Equal texts are one text with a count: they take part once, and all their
windows are repeated.  No group grows with their number.

Defined cases: a null text has no words; a text of fewer words than a window
loses none; text repeated inside one document counts as two places; ties can't
arise; repeated rows are equal texts; an empty table gives an empty result; of
the input, columns that clash with added ones keep their names and get an
underscore.  One text's own figures are held in one row of a task, whatever its
length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, aside, col, stored

WINDOW, GRAM = 35, 8
#: Windows of one run at most; runs of one 8-gram that meet in one group at most; words of the groups that are ordered at once.
RUN, HEAVY, AT_ONCE = 256, 4096, 1 << 20
FAR = 2**31 - 1
RUNS = "digest binary, grams array<long>, starts array<int>, sizes array<int>, twice array<boolean>"
SPANS = "digest binary, begin int, end int"
_RUNS = pa.schema([("digest", pa.binary()), ("grams", pa.list_(pa.int64())), ("starts", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32())), ("twice", pa.list_(pa.bool_()))])
_SPANS = pa.schema([("digest", pa.binary()), ("begin", pa.int32()), ("end", pa.int32())])
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_ODD), -1, 1 << 64))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_AT, _BACK_AT = _powers(_ODD, 1 << 16), _powers(_BACK, 1 << 16)
_BYTES = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)


def word_bounds(raw: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words of bytes begin and end; no word goes on over the places of ``first``."""
    full = np.concatenate([[False], ~_BLANK[raw], [False]])
    cut = np.zeros(len(raw) + 1, bool)
    cut[first] = True
    return np.flatnonzero(full[1:] & (~full[:-1] | cut)), np.flatnonzero(full[:-1] & (~full[1:] | cut))


def word_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each word's bytes; equal words have equal ones."""
    out = np.empty(len(begin), np.uint64)
    at, step = 0, len(_AT)
    while at < len(begin):
        last = int(np.searchsorted(end, begin[at] + step, "right"))
        if last <= at:  # one word longer than a step
            out[at] = int.from_bytes(hashlib.blake2b(raw[begin[at] : end[at]].tobytes(), digest_size=8).digest(), "little")
            at += 1
            continue
        own = raw[begin[at] : end[last - 1]]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTES[own] * _AT[: len(own)])])
        b, e = begin[at:last] - begin[at], end[at:last] - begin[at]
        out[at:last] = (total[e] - total[b]) * _BACK_AT[b]
        at = last
    return _mixed(out)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row."""
    out, have = values, 1
    while have < width:
        more = min(have, width - have)
        out = np.minimum(out[: len(out) - more], out[more:])
        have += more
    return out


def runs(hashes: np.ndarray, sizes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """(text, gram, start, size, twice) of each run of windows in texts of ``sizes`` words; twice: the 8-gram stands at two places in it."""
    none = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))
    if len(hashes) < window:
        return none
    width = window - GRAM + 1
    grams = np.zeros(len(hashes) - GRAM + 1, np.uint64)
    for j in range(GRAM):
        grams = grams * _ODD + hashes[j : len(hashes) - GRAM + 1 + j]
    grams = _mixed(grams)
    low = least(grams, width)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(low)]
    ends = np.cumsum(sizes)
    at = np.flatnonzero(np.arange(len(low)) + window <= ends[text])
    if not len(at):
        return none
    new = np.concatenate([[True], (low[at[1:]] != low[at[:-1]]) | (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])])
    begun = np.flatnonzero(new)
    into = np.arange(len(at)) - np.repeat(begun, np.diff(np.append(begun, len(at))))
    begun = np.flatnonzero(new | (into % RUN == 0))
    size, first = np.diff(np.append(begun, len(at))), at[begun]
    gram, twice = low[first], np.empty(len(first), bool)
    for k in range(0, len(first), 1 << 14):
        f, s, g = first[k : k + (1 << 14)], size[k : k + (1 << 14)], gram[k : k + (1 << 14), None]
        left = f + np.argmax(grams[f[:, None] + np.arange(width)] == g, axis=1)
        right = f + s - 1 + width - 1 - np.argmax(grams[(f + s - 1)[:, None] + np.arange(width - 1, -1, -1)] == g, axis=1)
        twice[k : k + (1 << 14)] = left != right
    return text[first], gram, first - (ends - sizes)[text[first]], size, twice


def _found(window: int, most: int = 1 << 21):  # noqa: ANN202
    """Function from batches of texts to batches of RUNS; texts of some 2 MB are worked on at once."""

    def chunk(own: list[bytes]) -> pa.RecordBatch:
        raw = np.frombuffer(b"".join(own), np.uint8)
        first = np.concatenate([[0], np.cumsum([len(x) for x in own])])
        begin, end = word_bounds(raw, first)
        sizes = np.diff(np.searchsorted(begin, first))
        text, gram, start, size, twice = runs(word_hashes(raw, begin, end), sizes, window)
        cuts = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text, minlength=len(own)))]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in (gram.view(np.int64), start.astype(np.int32), size.astype(np.int32), twice)]
        out = pa.RecordBatch.from_arrays([pa.array([hashlib.sha256(x).digest() for x in own], pa.binary()), *lists], schema=_RUNS)
        return out.filter(pa.array(np.diff(cuts.to_numpy()) > 0))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for x in batch.column(0):
                raw = x.as_buffer().to_pybytes() if x.is_valid else b""
                if len(raw) >= 2 * window - 1:
                    held.append(raw)
                    n += len(raw)
                if n >= most:
                    yield chunk(held)
                    held, n = [], 0
        if held:
            yield chunk(held)

    return work


def ranks(words: np.ndarray, room: np.ndarray, window: int) -> np.ndarray:
    """The order of the first ``window`` words of each suffix among all, by prefix doubling; equal ones share a rank.  room: words left of the suffix's own run; a suffix of fewer has no rank (-1)."""
    rank, have = words.astype(np.int64), 1
    while have < window:
        more = min(have, window - have)
        at = np.flatnonzero(room >= have + more)
        _, order = np.unique(rank[at] * (rank.max(initial=0) + 1) + rank[at + more], return_inverse=True)
        rank = np.full(len(words), -1, np.int64)
        rank[at] = order
        have += more
    return np.where(room >= window, rank, -1)


def repeats(texts: pa.Array, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run, begin, end) of the maximal repeats in runs of words that one space separates: their suffixes hang below an internal node of the window's depth."""
    lists = pc.split_pattern(texts, " ")
    cuts = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    words, cuts = words[cuts[0] : cuts[-1]], cuts - cuts[0]
    run = np.repeat(np.arange(len(texts)), np.diff(cuts))
    rank = ranks(words, cuts[run + 1] - np.arange(len(words)), window)
    whole = np.flatnonzero(rank >= 0)
    at = whole[np.bincount(rank[whole])[rank[whole]] > 1]
    if not len(at):
        return (np.zeros(0, np.int64),) * 3
    new = np.concatenate([[True], (run[at[1:]] != run[at[:-1]]) | (at[1:] > at[:-1] + window)])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    own = run[at[first]]
    return own, at[first] - cuts[own], at[last] + window - cuts[own]


def _grown(window: int):  # noqa: ANN202
    """Function from batches of (gram, digest, start, words), ordered by gram, to SPANS: whole groups are ordered, many small ones at once."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def trees(t: pa.Table) -> Iterator[pa.RecordBatch]:
            run, begin, end = repeats(t["words"].combine_chunks(), window)
            if len(run):
                start = t["start"].to_numpy()[run]
                yield pa.RecordBatch.from_arrays([t["digest"].take(pa.array(run)).combine_chunks(), pa.array((start + begin).astype(np.int32)), pa.array((start + end).astype(np.int32))], schema=_SPANS)

        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            size = 512
            for k in range(0, len(batch), size):
                own = batch.slice(k, size)
                held.append(own)
                n += pc.sum(pc.binary_length(own["words"])).as_py() // 6
                if n >= AT_ONCE:
                    t = pa.Table.from_batches(held)
                    gram = t["gram"].to_numpy()
                    cut = int(np.searchsorted(gram, gram[-1]))  # the last group may go on
                    if cut:
                        yield from trees(t.slice(0, cut))
                        held = t.slice(cut).to_batches()
                        n = sum(pc.sum(pc.binary_length(b["words"])).as_py() // 6 for b in held)
        if held:
            yield from trees(pa.Table.from_batches(held))

    return work


def _gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What stays of a text, from the spans to be removed: (first, number) of words, from 1 on."""
    kind = pa.struct([("first", pa.int32()), ("many", pa.int32())])
    for batch in batches:
        out = []
        for spans in batch["spans"].to_pylist():
            at, own = 0, []
            for x in sorted(spans, key=lambda x: x["begin"]):
                if x["begin"] > at:
                    own.append({"first": at + 1, "many": x["begin"] - at})
                at = max(at, x["end"])
            out.append(own + ([{"first": at + 1, "many": FAR - at}] if at < FAR else []))
        yield pa.RecordBatch.from_arrays([batch["digest"], pa.array(out, pa.list_(kind))], names=["digest", "gaps"])


def word_array(text: Column) -> Column:
    return F.array_remove(F.split(text, f"[{SPACE}]+", -1), "")


def spans(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(digest, begin, end) of words in windows that start at two places or more, for each distinct text (digest: its SHA-256); spans may overlap.  A text that stands in several rows has a span over all its words."""
    own = docs.select(F.coalesce(col(text_col), F.lit("")).alias("text"))
    each = own.mapInArrow(_found(window), RUNS)
    texts = stored(each.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), *(F.any_value(c).alias(c) for c in ("grams", "starts", "sizes", "twice"))), "texts")
    every = texts.select("digest", F.inline(F.arrays_zip("grams", "starts", "sizes", "twice"))).toDF("digest", "gram", "start", "size", "twice")
    many = every.groupBy("gram").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("many")).where("many > 1")
    some = every.join(stored(many, "grams"), "gram")
    run = F.struct("gram", "start", "size", (F.col("many") > HEAVY).alias("heavy"))
    some = stored(some.groupBy("digest").agg(F.collect_list(run).alias("runs")), "candidates")  # runs of one text
    # one row of each text: copies are combined in their tasks
    once = own.groupBy(F.unhex(F.sha2("text", 256)).alias("digest")).agg(F.any_value("text").alias("text"))
    part = lambda words, start, n: F.array_join(F.slice(words, start + 1, n), " ")

    def met(heavy: bool, each: Callable[[Column, Column], Column]) -> DataFrame:
        """A row for each value of each(words, run) over the runs of a text: cut within the row, so that no row but it holds all words."""
        runs_ = some.select("digest", F.filter("runs", lambda r: r["heavy"] == heavy).alias("runs")).where("size(runs) > 0")
        pieces = F.transform(F.array(word_array(F.col("text"))), lambda w: F.flatten(F.transform("runs", lambda r: each(w, r))))
        return once.join(runs_, "digest").select("digest", F.explode(F.get(pieces, F.lit(0))).alias("r")).select("digest", "r.*")

    light = met(False, lambda w, r: F.array(F.struct(r["gram"].alias("gram"), r["start"].alias("start"), part(w, r["start"], r["size"] + window - 1).alias("words"))))
    light = light.select("gram", "digest", "start", "words")
    found = stored(light.repartition("gram").sortWithinPartitions("gram").mapInArrow(_grown(window), SPANS), "trees")
    if not some.where(F.exists("runs", lambda r: r["heavy"])).isEmpty():  # else texts needn't be read once more
        prefix = lambda w, i: F.unhex(F.sha2(part(w, i, F.lit(window)), 256)).alias("prefix")
        each = met(True, lambda w, r: F.transform(F.sequence(r["start"], r["start"] + r["size"] - 1), lambda i: F.struct(prefix(w, i), i.alias("begin"))))
        each = stored(each.select("prefix", "digest", "begin"), "prefixes")
        twice = each.groupBy("prefix").count().where("count > 1").select("prefix")
        whole = each.join(stored(twice, "twice"), "prefix", "left_semi")
        found = found.unionByName(whole.select("digest", "begin", (F.col("begin") + window).alias("end")))
    return found.unionByName(texts.where("n > 1").select("digest", F.lit(0).alias("begin"), F.lit(FAR).alias("end")))


def remove(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with n_words, n_removed and kept (the words left, joined by one space) added."""
    added = ["n_words", "n_removed", "kept"]
    found = spans(docs, text_col, window)
    gaps = stored(found.groupBy("digest").agg(F.collect_set(F.struct("begin", "end")).alias("spans")).mapInArrow(_gaps, "digest binary, gaps array<struct<first int, many int>>"), "gaps")
    docs, names = aside(docs, [*added, "__digest", "__words", "__left"])
    own = [col(c) for c in docs.columns]
    text = F.coalesce(col(names[text_col]), F.lit(""))
    met = docs.withColumn("__digest", F.unhex(F.sha2(text, 256))).join(gaps.withColumnRenamed("digest", "__digest"), "__digest", "left")
    met = met.select(*own, word_array(text).alias("__words"), "gaps")
    left = F.when(F.col("gaps").isNull(), F.col("__words")).otherwise(F.flatten(F.transform("gaps", lambda g: F.slice("__words", g["first"], g["many"]))))
    met = met.select(*own, "__words", left.alias("__left"))
    return met.select(*own, F.size("__words").cast("long").alias("n_words"), (F.size("__words") - F.size("__left")).cast("long").alias("n_removed"), F.array_join("__left", " ").alias("kept"))
