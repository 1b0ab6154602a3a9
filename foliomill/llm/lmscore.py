"""LM scoring by cross-entropy difference of two matched n-gram models.

Both models are character n-gram models of the same order, smoothing and one
shared vocabulary: all code points found ``LEAST`` times or more in the
background, any other being one unknown token.  The background model counts
every document, the target model those that a set of ids names.  Grams are kept
exactly: executors count those of the highest order, and those of lower orders
and all contexts are sums of them, so the tables grow with the grams found.  A
probability is Dirichlet-smoothed order by order down to uniform.

No document is scored by a model that has counted it.  Documents fall into
``FOLDS`` folds by their ids, and those of a fold are scored by two models of
all other folds.  A table of every gram of every document holds its losses under
the models of each fold, reckoned by joins.  Up to ``MOST_GRAMS`` grams are
broadcast; if there are more, documents are put in groups of ``GROUP`` rows and
``GROUP_BYTES`` at most (a longer text is one by itself), and each group is given
the losses of its own grams by a shuffle.

A document's score is the mean over its tokens of loss(target) -
loss(background), in bits: below 0 it is more like the target.

Defined cases: a null or empty text has no tokens, losses and score 0; a text's
first tokens follow begin marks; texts may be of any length; rows whose doc_id
is null are in no target and of one fold; without a target row the target model
is uniform, so scores compare the background with that; repeated rows are
counted and scored each, rows of one id in one fold; equal texts of one fold tie;
an empty table gives an empty result; the columns ``ADDED`` of the input stay
under that name and an underscore.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, grouped, small_batches, stored

ORDER, LEAST, ALPHA, FOLDS = 4, 5, 8.0, 4
#: Bits of a token in a pair of tokens; a gram is two pairs, the older and the newer.
TOKEN_BITS = 21
#: Losses of up to so many grams are broadcast.
MOST_GRAMS = 1 << 20
#: Rows and bytes of a group of documents where they aren't, and grams that a counting task holds at once.
GROUP, GROUP_BYTES, HELD = 2048, 1 << 25, 1 << 21
#: Ids of ids sets up to this size are broadcast.
MOST_IDS = 4_000_000
#: Characters worked on at once.
BLOCK = 1 << 20


def flat_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and the number of each text's."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64), sizes


def vocabulary(docs: DataFrame, text_col: str = "text", least: int = LEAST) -> np.ndarray:
    """Code point to token id: 2 and up for the vocabulary, 1 unknown; 0 is the begin mark.  One figure a code point is gathered."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, np.int64)
        for part in parts:
            flat, _ = flat_points([x.as_py() or "" for x in part.column(0)])
            found = np.bincount(flat)
            total[: len(found)] += found
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], ["point", "n"])

    small_batches(docs.sparkSession)
    counts = docs.select(text_col).mapInArrow(run, "point long, n long").groupBy("point").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    known = sorted(r["point"] for r in counts.select("point").collect())
    ids = np.ones(0x110000, np.int32)
    ids[known] = np.arange(2, len(known) + 2)
    return ids


def keys(older: np.ndarray, newer: np.ndarray, size: int) -> np.ndarray:
    """One exact, sortable value a gram: a long if a vocabulary of so many tokens leaves room, else a pair of doubles."""
    bits, low = (size - 1).bit_length(), (1 << TOKEN_BITS) - 1
    if 4 * bits > 63:
        return older + 1j * newer  # pairs have 42 bits, so both parts are exact
    return (older >> TOKEN_BITS) << (3 * bits) | (older & low) << (2 * bits) | (newer >> TOKEN_BITS) << bits | (newer & low)


def pairs(key: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The older and the newer pair of keys()."""
    if key.dtype.kind == "c":
        return key.real.astype(np.int64), key.imag.astype(np.int64)
    bits = (size - 1).bit_length()
    a, b, c, d = ((key >> (k * bits)) & ((1 << bits) - 1) for k in (3, 2, 1, 0))
    return a << TOKEN_BITS | b, c << TOKEN_BITS | d


def grams(texts: list[str], ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of the gram of the highest order that ends at each token, and token counts."""
    flat, sizes = flat_points(texts)
    tokens = ids[flat].astype(np.int64)
    since = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    back = [tokens]
    for k in range(1, ORDER):
        own = np.zeros(len(tokens), np.int64)  # begin marks before the first token
        if k < len(tokens):
            own[k:] = np.where(since[k:] >= k, tokens[: len(tokens) - k], 0)
        back.append(own)
    return keys(back[3] << TOKEN_BITS | back[2], back[1] << TOKEN_BITS | back[0], size), sizes


def blocks(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of about BLOCK characters; a text stays whole."""
    held, n = [], 0
    for t in texts:
        held.append(t)
        n += len(t)
        if n >= BLOCK:
            yield held
            held, n = [], 0
    if held:
        yield held


def names_of(folds: int) -> list[tuple[str, str]]:
    """The columns of each fold: counts or losses of background and target."""
    return [(f"background_{k}", f"target_{k}") for k in range(folds)]


def gathered(docs: DataFrame, ids: np.ndarray, text_col: str, flag: str, fold: str, folds: int) -> DataFrame:
    """(older, newer, background and target of each fold): counts of all grams of the highest order in the fold's own documents."""
    shared, size = docs.sparkSession.sparkContext.broadcast(ids), int(ids.max()) + 1
    Held = dict[int, list[tuple[np.ndarray, np.ndarray]]]

    def merged(some: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        key, n = (np.concatenate(x) for x in zip(*some, strict=True))
        found, at = np.unique(key, return_inverse=True)
        return found, np.bincount(at, n, len(found)).astype(np.int64)

    def out(held: Held) -> Iterator[pa.RecordBatch]:
        for cell, some in held.items():
            key, n = merged(some)
            for i in range(0, len(key), 1 << 18):
                part = slice(i, i + (1 << 18))
                columns = [*pairs(key[part], size), np.full(len(key[part]), cell), n[part]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["older", "newer", "cell", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Held = {}
        for part in parts:
            cells = part.column(1).to_numpy(zero_copy_only=False)
            texts = [x.as_py() or "" for x in part.column(0)]
            for cell in np.unique(cells).tolist():
                for some in blocks([t for t, c in zip(texts, cells.tolist(), strict=True) if c == cell]):
                    held.setdefault(cell, []).append(np.unique(grams(some, shared.value, size)[0], return_counts=True))
            if sum(len(x[0]) for some in held.values() for x in some) > HELD:
                held = {cell: [merged(some)] for cell, some in held.items()}
                if sum(len(some[0][0]) for some in held.values()) > HELD // 2:
                    yield from out(held)
                    held = {}
        yield from out(held)

    small_batches(docs.sparkSession, 1024)
    cell = 2 * F.col(fold) + F.col(flag).cast("int")  # fold, and whether of the target
    counted = docs.select(text_col, cell.alias("cell")).mapInArrow(run, "older long, newer long, cell long, n long")
    of = lambda wanted: F.coalesce(F.sum(F.when(wanted, F.col("n"))), F.lit(0))
    sums = [x for k, (b, t) in enumerate(names_of(folds)) for x in (of(F.floor(F.col("cell") / 2) == k).alias(b), of(F.col("cell") == 2 * k + 1).alias(t))]
    return counted.groupBy("older", "newer").agg(*sums)


def models(counts: DataFrame, size: int, folds: int) -> DataFrame:
    """(older, newer, losses): the loss in bits of each gram's last token under the models for each fold, from gathered()."""
    low = (1 << TOKEN_BITS) - 1
    names, each = ["a", "b", "c", "d"], [m for pair in names_of(folds) for m in pair]
    sums = [F.sum(m).alias(m) for m in each]
    split = [F.shiftright(p, TOKEN_BITS) if k == 0 else F.col(p).bitwiseAND(F.lit(low)) for p in ("older", "newer") for k in (0, 1)]
    kinds = list(zip(*names_of(folds), strict=True))
    others = [(sum((F.col(x) for x in kind), F.lit(0)) - F.col(m)).cast("long").alias(m) if folds > 1 else F.col(m) for pair in names_of(folds) for m, kind in zip(pair, kinds, strict=True)]
    now = counts.select(*(x.alias(n) for n, x in zip(names, split, strict=True)), *others)
    of = {4: now}
    for k in (3, 2, 1):  # each position's gram of a lower order is the end of its gram of the next higher one
        of[k] = stored(of[k + 1].groupBy(names[4 - k :]).agg(*sums), "grams")
    total = of[1].agg(*sums).first()
    p = of[1].select("d", *(((F.col(m) + ALPHA / size) / (F.lit(float(total[m] or 0)) + ALPHA)).alias(f"p_{m}") for m in each))
    for k in (2, 3, 4):
        before = of[k].groupBy(names[4 - k : 3]).agg(*(F.sum(m).alias(f"all_{m}") for m in each))
        met = of[k].join(before, names[4 - k : 3]).join(p, names[5 - k :])
        p = met.select(*names[4 - k :], *(((F.col(m) + ALPHA * F.col(f"p_{m}")) / (F.col(f"all_{m}") + ALPHA)).alias(f"p_{m}") for m in each))
    pair = lambda x, y: F.shiftleft(x, TOKEN_BITS).bitwiseOR(F.col(y))
    return p.select(pair("a", "b").alias("older"), pair("c", "d").alias("newer"), *((-F.log2(f"p_{m}")).alias(m) for m in each))


Arrays = tuple[np.ndarray, np.ndarray, np.ndarray]


def model_arrays(found: pa.Table, size: int, folds: int) -> Arrays:
    """Sorted keys, and their losses under background and target: a column for each fold."""
    key = keys(*(found.column(c).to_numpy() for c in ("older", "newer")), size)
    order = np.argsort(key)
    return key[order], *(np.stack([found.column(c).to_numpy()[order] for c in kind], 1) for kind in zip(*names_of(folds), strict=True))


def losses(texts: list[str], fold: np.ndarray, ids: np.ndarray, model: Arrays, size: int) -> Arrays:
    """Tokens, and summed loss in bits under background and target, of each text; the model has every gram of the texts."""
    key, sizes = grams(texts, ids, size)
    at = np.searchsorted(model[0], key)
    own = np.repeat(np.arange(len(texts)), sizes)
    return sizes, *(np.bincount(own, x[at, fold[own]], len(texts)) for x in model[1:])


ADDED = ["n_tokens", "target_loss", "background_loss", "score"]


def figures(texts: list[str], fold: np.ndarray, ids: np.ndarray, model: Arrays, size: int) -> list[pa.Array]:
    """The columns ADDED of all texts."""
    found, at = [(np.empty(0),) * 3], 0
    for some in blocks(texts):
        found.append(losses(some, fold[at : at + len(some)], ids, model, size))
        at += len(some)
    n, background, target = (np.concatenate(x) for x in zip(*found, strict=True))
    each = np.maximum(n, 1)
    return [pa.array(n.astype(np.int64)), pa.array(target / each), pa.array(background / each), pa.array((target - background) / each)]


def score(docs: DataFrame, target_ids: DataFrame, text_col: str = "text", folds: int = FOLDS) -> DataFrame:
    """docs without the text, with n_tokens, target_loss, background_loss and score (bits a token) added; target_ids (doc_id): the target documents.

    With one fold the models have counted what they score."""
    flag, fold = "__foliomill_target", "__foliomill_fold"
    docs, names = aside(docs, [*ADDED, flag, fold])
    text_col = names[text_col]
    kept = [c for c in docs.columns if c != text_col]
    docs = docs.withColumn(fold, F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(folds)).cast("long"))
    wanted = target_ids.where("doc_id is not null").select("doc_id").distinct()
    if wanted.count() <= MOST_IDS:
        wanted = F.broadcast(wanted)
    flagged = docs.join(wanted.withColumn(flag, F.lit(True)), "doc_id", "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    ids = vocabulary(docs, text_col)
    size = int(ids.max()) + 1
    model = stored(models(stored(gathered(flagged, ids, text_col, flag, fold, folds), "counts"), size, folds), "losses")
    shared_ids = docs.sparkSession.sparkContext.broadcast(ids)
    fields = [T.StructField("n_tokens", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ADDED[1:])]
    schema = T.StructType([*(f for f in docs.schema if f.name in kept), *fields])
    small_batches(docs.sparkSession)
    if model.count() > MOST_GRAMS:
        return by_groups(docs, model, shared_ids, text_col, fold, kept, schema, size, folds)
    shared = docs.sparkSession.sparkContext.broadcast(model_arrays(model.toArrow(), size, folds))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts, own = (part.column(part.schema.get_field_index(c)) for c in (text_col, fold))
            more = figures([x.as_py() or "" for x in texts], own.to_numpy(), shared_ids.value, shared.value, size)
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), *more], [*kept, *ADDED])

    return docs.mapInArrow(run, schema)


def by_groups(docs: DataFrame, model: DataFrame, ids: Broadcast, text_col: str, fold: str, kept: list[str], schema: T.StructType, size: int, folds: int) -> DataFrame:
    """score() with a model of any size: each group of rows meets the losses of its own grams."""
    group = "__foliomill_group"
    numbered = stored(grouped(docs.select(*kept, text_col, fold), text_col, group, GROUP, GROUP_BYTES), "grouped")

    def wanted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def out() -> Iterator[pa.RecordBatch]:
            older, newer = pairs(np.unique(np.concatenate(held)), size)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(older), now)), pa.array(older), pa.array(newer)], [group, "older", "newer"])

        for part in parts:
            owner = part.column(1).to_numpy()
            texts = [x.as_py() or "" for x in part.column(0)]
            for own in np.unique(owner).tolist():
                if own != now and held:
                    yield from out()
                    held = []
                now = own
                held += [np.unique(grams(some, ids.value, size)[0]) for some in blocks([t for t, g in zip(texts, owner.tolist(), strict=True) if g == own])]
        if held:
            yield from out()

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        more = figures([x.as_py() or "" for x in left.column(text_col)], left.column(fold).to_numpy(), ids.value, model_arrays(right, size, folds), size)
        return pa.table([*(left.column(c) for c in kept), *more], names=[*kept, *ADDED])

    met = numbered.select(text_col, group).mapInArrow(wanted, f"{group} long, older long, newer long").distinct().join(model, ["older", "newer"])
    return numbered.groupBy(group).cogroup(met.groupBy(group)).applyInArrow(scored, schema)
