"""Language ID by bit-sliced Bloom filters of n-grams.

A text is lower-cased; runs of characters that are no letter become one space.
Its n-grams (3 code points, packed exactly into 63 bits) are looked up in a
table of masks, of as many 64-bit words as the languages need: bit l of a mask belongs to language l's Bloom filter, so
ANDing the masks at an n-gram's ``HASHES`` places returns all languages that
contain it.  The popcount of each language over a text, less the false
positives that its fill predicts, decides.

Learning counts every n-gram of every learning row for each language, on
executors with map-side sums.  An n-gram belongs to all languages in which its
share is ``SHARE`` or more of its largest share in any; n-grams seen fewer than
``LEAST`` times are noise, in a language of little text in proportion fewer: one
time for every ``PER_TIME`` n-grams of its text.  All others are kept as
(n-gram, word, mask), and a table's length follows their number, so neither
languages nor n-grams are cut.  Their masks are counted first: up to
``MOST_MASKS`` are gathered and broadcast as one table (of 128 MB at most).  More
stay a table of Spark: documents are put in groups of ``GROUP`` rows and
``GROUP_BYTES`` at most (a longer text is one by itself), a shuffle gives each
group the masks of its own n-grams, and its filters hold these.

Defined cases: a text that is null or has no letter is ``und`` with score 0; a
text with letters none of whose n-grams is known gets the commonest language,
score 0; without learning rows every text is ``und``; ties go to the commoner
language; repeated rows each get a row; texts may be of any length; an empty
table gives an empty result; columns ``lang_pred`` and ``score`` of the input
stay under that name and an underscore.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, grouped, learned, small_batches, stored

GRAM, HASHES, LEAST, SHARE = 3, 2, 5, 0.2
BITS = 20  # of the table's length; doubled until languages' filters are sparse
WORD = 64  # languages of one word of a mask
PER_TIME = 50_000
#: N-grams of a language that a counting task holds at once.
HELD = 1 << 20
#: Masks of up to so many n-grams are broadcast; rows and bytes of a group of documents where they aren't.
MOST_MASKS, GROUP, GROUP_BYTES = 1 << 20, 2048, 1 << 23
#: Characters that are looked up at once.
AT_ONCE = 1 << 20


def points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each between spaces, with runs of others than letters as one space; and the text of each."""
    flat = np.frombuffer("".join([f" {t} " for t in texts]).lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    sizes = np.array([len(f" {t} ".lower()) for t in texts])
    own = np.repeat(np.arange(len(texts)), sizes)
    present = np.flatnonzero(np.bincount(flat)) if len(flat) else np.empty(0, int)
    letter = np.zeros(present[-1] + 1 if len(present) else 1, bool)
    letter[present] = [chr(c).isalpha() for c in present.tolist()]
    flat = np.where(letter[flat], flat, 32)
    keep = np.append(True, ~((flat[1:] == 32) & (flat[:-1] == 32) & (own[1:] == own[:-1])))[: len(flat)]
    return flat[keep], own[keep]


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All n-grams, the text of each, and whether each text has a letter."""
    flat, own = points(texts)
    letters = np.bincount(own[flat != 32], minlength=len(texts)) > 0
    if len(flat) < GRAM:
        return np.empty(0, np.int64), np.empty(0, np.int64), letters
    packed = (flat[:-2] << 42) | (flat[1:-1] << 21) | flat[2:]
    inside = (own[:-2] == own[2:]) & (flat[1:-1] != 32)
    return packed[inside], own[:-2][inside], letters


def mixed(x: np.ndarray, k: int) -> np.ndarray:
    """The k-th hash of 63-bit values, by a multiply-xorshift round."""
    h = x.astype(np.uint64) * np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[k])
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def bit_of(masks: np.ndarray, i: int) -> np.ndarray:
    """Language i's bit of each mask."""
    word = masks if masks.ndim == 1 else masks[:, i // WORD]
    return (word >> np.uint64(i % WORD)) & np.uint64(1)


@dataclass
class Filters:
    languages: list[str]
    table: np.ndarray  # one mask of languages for each place: a word, or a row of words
    false: np.ndarray  # of each language: the share of unknown n-grams that it claims

    @classmethod
    def of(cls, packed: np.ndarray, masks: np.ndarray, languages: list[str]) -> Filters:
        bits = BITS
        while (1 << bits) < 16 * len(packed):
            bits += 1
        table = np.zeros((1 << bits, *masks.shape[1:]), np.uint64)
        for k in range(HASHES):
            np.bitwise_or.at(table, (mixed(packed, k) >> np.uint64(64 - bits)).astype(np.int64), masks)
        fill = np.array([bit_of(table, i).mean() for i in range(len(languages))])
        return cls(languages, table, fill**HASHES)

    @classmethod
    def met(cls, rows: pa.Table, languages: list[str]) -> Filters:
        """Filters of the masks (gram, word, mask)."""
        packed, word, mask = (rows.column(c).to_numpy().astype(np.int64) for c in ("gram", "word", "mask"))
        if len(languages) <= WORD:
            return cls.of(packed, mask.view(np.uint64), languages)
        own, at = np.unique(packed, return_inverse=True)
        wide = np.zeros((len(own), -(-len(languages) // WORD)), np.uint64)
        wide[at, word] = mask.view(np.uint64)
        return cls.of(own, wide, languages)

    def containing(self, packed: np.ndarray) -> np.ndarray:
        """The mask of all languages containing each n-gram."""
        shift = np.uint64(64 - (len(self.table).bit_length() - 1))
        out = self.table[(mixed(packed, 0) >> shift).astype(np.int64)]
        for k in range(1, HASHES):
            out = out & self.table[(mixed(packed, k) >> shift).astype(np.int64)]
        return out

    def predictions(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """predict() of all texts, some at once."""
        langs, scores, held, n = [], [np.empty(0)], [], 0
        for i, t in enumerate(texts):
            held.append(t)
            n += len(t)
            if n >= AT_ONCE or i == len(texts) - 1:
                some, score = self.predict(held)
                langs += some
                scores.append(score)
                held, n = [], 0
        return langs, np.concatenate(scores)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        packed, own, letters = grams(texts)
        n = np.bincount(own, minlength=len(texts)).astype(float)
        masks = self.containing(packed)
        counts = np.stack([np.bincount(own, bit_of(masks, i).astype(float), len(texts)) for i in range(len(self.languages))], 1)
        true = np.maximum(0, (counts - self.false * n[:, None]) / np.maximum(1 - self.false, 1e-9))
        best = true.argmax(1)
        score = np.where(letters, true.max(1) / np.maximum(n, 1), 0.0)
        return [self.languages[b] if y else "und" for b, y in zip(best.tolist(), letters.tolist(), strict=True)], np.clip(score, 0, 1)


@dataclass
class Spread:
    """The masks (gram, word, mask) of more n-grams than one table may hold."""

    languages: list[str]
    masks: DataFrame


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filters | Spread:
    """Filters from all rows of docs that have a language."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(pairs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            all_grams, all_counts = (np.concatenate(x) for x in zip(*pairs, strict=True))
            keys, at = np.unique(all_grams, return_inverse=True)
            return keys, np.bincount(at, all_counts, len(keys)).astype(np.int64)

        def out(lang: str) -> pa.RecordBatch:
            keys, counts = merged(held.pop(lang))
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], ["lang", "gram", "n"])

        for part in parts:
            text = [x.as_py() for x in part.column(1)]
            langs = part.column(0).to_pylist()
            for lang in sorted(set(langs)):
                packed, _, _ = grams([t for t, x in zip(text, langs, strict=True) if x == lang])
                held.setdefault(lang, []).append(np.unique(packed, return_counts=True))
                if len(held[lang]) >= 32:
                    held[lang] = [merged(held[lang])]
                    if len(held[lang][0][0]) > HELD:
                        yield out(lang)
        for lang in list(held):
            yield out(lang)

    small_batches(docs.sparkSession)
    counts = stored(known.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("total")).orderBy(F.desc("total"), "lang").collect()  # a row for each language
    languages = [r["lang"] for r in totals]
    if not languages:
        return Filters([], np.zeros(1, np.uint64), np.zeros(0))
    index = docs.sparkSession.createDataFrame([(r["lang"], i, float(r["total"])) for i, r in enumerate(totals)], "lang string, bit int, total double")
    rated = counts.join(index, "lang").withColumn("share", F.col("n") / F.col("total"))
    top = rated.withColumn("top", F.max("share").over(Window.partitionBy("gram"))).withColumn("seen", F.sum("n").over(Window.partitionBy("gram")))
    least = F.least(F.lit(LEAST), F.ceil(F.col("total") / PER_TIME))
    kept = top.where((F.col("seen") >= least) & (F.col("share") >= SHARE * F.col("top")))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit") % WORD)
    masks = stored(kept.groupBy("gram", F.floor(F.col("bit") / WORD).alias("word")).agg(F.bit_or(bit).alias("mask")), "masks")
    words = -(-len(languages) // WORD)
    if masks.count() * words > MOST_MASKS:
        return Spread(languages, masks)
    return Filters.met(masks.select("gram", "word", "mask").toArrow(), languages)  # MOST_MASKS rows at most


def identify(docs: DataFrame, filters: Filters | Spread, text_col: str = "text") -> DataFrame:
    """docs with lang_pred and score added; filters of bounded size are broadcast once."""
    docs, names = aside(docs, ["lang_pred", "score"])
    kept, text_col = docs.columns, names[text_col]
    schema = T.StructType([*(f for f in docs.schema if f.name in kept), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    small_batches(docs.sparkSession)
    if isinstance(filters, Spread):
        return by_groups(docs, filters, text_col, schema)
    shared = docs.sparkSession.sparkContext.broadcast((filters.languages, filters.table, filters.false))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Filters(*shared.value)
        for part in parts:
            texts = [x.as_py() or "" for x in part.column(part.schema.get_field_index(text_col))]
            langs, score = own.predictions(texts) if own.languages else (["und"] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), pa.array(langs, pa.string()), pa.array(score, pa.float64())], [*kept, "lang_pred", "score"])

    return docs.mapInArrow(run, schema)


def by_groups(docs: DataFrame, spread: Spread, text_col: str, schema: T.StructType) -> DataFrame:
    """identify() with masks of any number: each group of rows meets those of its own n-grams."""
    group, kept, languages = "__foliomill_group", docs.columns, spread.languages
    numbered = stored(grouped(docs, text_col, group, GROUP, GROUP_BYTES), "grouped")

    def wanted(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            owner, texts = part.column(1).to_pylist(), [x.as_py() or "" for x in part.column(0)]
            for own in sorted(set(owner)):
                packed = np.unique(grams([t for t, g in zip(texts, owner, strict=True) if g == own])[0])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(packed), own, np.int64)), pa.array(packed)], [group, "gram"])

    def predicted(left: pa.Table, right: pa.Table) -> pa.Table:
        langs, score = Filters.met(right, languages).predictions([x.as_py() or "" for x in left.column(text_col)])
        return pa.table([*(left.column(c) for c in kept), pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=[*kept, "lang_pred", "score"])

    met = numbered.select(text_col, group).mapInArrow(wanted, f"{group} long, gram long").distinct().join(spread.masks, "gram")
    return numbered.groupBy(group).cogroup(met.groupBy(group)).applyInArrow(predicted, schema)


def learning_rows(docs: DataFrame) -> DataFrame:
    return docs.where(learned(F.col("doc_id")))
