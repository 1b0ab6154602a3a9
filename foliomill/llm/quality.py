"""Quality classifier: random Fourier features of document statistics, ridge by normal equations, isotonic calibration.

Each text becomes ``len(NAMES)`` statistics.  ``WIDTH`` random Fourier features
of the standardised statistics approximate a Gaussian kernel.  Learning sums,
over at most ``PARTS`` partitions, the moments, then the normal equations
(WIDTH + 1 squared figures each), then calibration counts over ``BINS`` bins of
the raw score; only such sums reach the driver.  One in four learning rows is
kept from the ridge and used for the calibration.

At most ``MOST_LABELLED`` labelled rows are learned from; of more, those with
the smallest hashes of their ids are taken.  Statistics and scores cover every
row and the whole of every text.

Defined cases: a null text is empty and is scored; labels that are null are
left out, of several for one doc_id the mean decides; without labels, or with
one kind only, every score is that kind's share (0.5 without any); repeated
rows each get a row; texts may be of any length; texts that tie in all
statistics get one score; an empty table gives an empty result; columns of the
input whose names are added stay under that name and an underscore.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import aside, learned, restored, small_batches, stored

WIDTH, RIDGE, SEED = 256, 1e-2, 7
PARTS, BINS, MOST_LABELLED = 16, 400, 200_000
#: The raw score lies within these bounds, else in the bin next to them.
LOW, HIGH = -0.5, 1.5
NAMES = (
    "log_chars log_words log_lines upper lower digits spaces line_feeds beyond_ascii symbols full_stops commas shouts pipes quotes brackets other_marks "
    "word_mean word_deviation short_words distinct_words distinct_pairs same_as_last top_word distinct_lines words_per_line byte_entropy marked_words"
).split()


def statistics(text: str) -> list[float]:
    """The statistics of one whole text, in the order of NAMES."""
    raw = text.encode("utf-8", "surrogatepass")
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    chars = max(1.0, len(raw) - hist[0x80:0xC0].sum())
    of = lambda marks: float(sum(hist[b] for b in marks.encode())) / chars
    words = raw.split()
    n = max(1, len(words))
    size = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    counted = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    share = hist[hist > 0] / max(1, len(raw))
    letters = max(1.0, hist[65:91].sum() + hist[97:123].sum())
    symbols = of("#*$%&|<>@^~\\_=+")
    return [
        np.log1p(chars), np.log1p(len(words)), np.log1p(len(lines)), hist[65:91].sum() / letters, hist[97:123].sum() / chars, hist[48:58].sum() / chars, hist[32] / chars, hist[10] / chars,
        hist[0xC0:].sum() / chars, symbols, of("."), of(","), of("!?"), of("|"), of("\"'"), of("()[]{}"), of(":;-/"),
        float(size.mean()), float(size.std()), float((size <= 3).mean()), len(counted) / n, len(set(zip(words, words[1:], strict=False))) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n, max(counted.values(), default=0) / n, len(set(lines)) / max(1, len(lines)), np.log1p(len(words) / max(1, len(lines))),
        float(-(share * np.log2(share)).sum()) if len(raw) else 0.0, symbols * chars / n,
    ]


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # raw scores at which the calibrated score is known
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return fourier((x - self.mean) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Isotonic in the raw score; a thousandth of it keeps ties apart."""
        raw = self.raw(x)
        flat = np.interp(raw, self.edges, self.values)
        return np.clip(0.999 * flat + 0.001 / (1 + np.exp(-4 * (raw - 0.5))), 0, 1)


def fourier(x: np.ndarray) -> np.ndarray:
    """Random Fourier features and a constant."""
    r = np.random.default_rng(SEED)
    w = r.normal(size=(x.shape[1], WIDTH)) / np.sqrt(2 * x.shape[1])
    z = np.cos(np.clip(x, -8, 8) @ w + r.uniform(0, 2 * np.pi, WIDTH)) * np.sqrt(2 / WIDTH)
    return np.concatenate((z, np.ones((len(x), 1))), 1)


def matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, len(NAMES))


def with_statistics(docs: DataFrame, text_col: str = "text", to: str = "stats") -> DataFrame:
    """docs with their statistics in place of the text column."""
    docs, names = aside(docs, [to])
    text_col = names[text_col]
    kept = [c for c in docs.columns if c != text_col]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = pa.array([statistics(x.as_py() or "") for x in part.column(part.schema.get_field_index(text_col))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), found], [*kept, to])

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, T.StructType([*(f for f in docs.schema if f.name in kept), T.StructField(to, T.ArrayType(T.DoubleType()))]))


def isotonic(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Pool adjacent violators over bins in order; bins without rows take part in none."""
    blocks: list[list[float]] = []
    for n, y in zip(total.tolist(), good.tolist(), strict=True):
        blocks.append([y, n, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            y, n, k = blocks.pop()
            blocks[-1] = [blocks[-1][0] + y, blocks[-1][1] + n, blocks[-1][2] + k]
    return np.concatenate([np.full(int(k), y / n) for y, n, k in blocks])


def chosen(labels: DataFrame, target: str = "quality", most: int = MOST_LABELLED) -> DataFrame:
    """(doc_id, mean): the label of each row to learn from, about most of them at most."""
    own = labels.where(F.col(target).isNotNull() & learned(F.col("doc_id"))).groupBy("doc_id").agg(F.avg(F.col(target).cast("double")).alias("mean"))
    n = own.count()
    if n > most:
        own = own.where(F.abs(F.xxhash64("doc_id") % 1_000_003) < int(1_000_003 * most / n))
    return own


def fit(stats: DataFrame, own: DataFrame) -> Model:
    """Learn from the rows of stats (doc_id, stats) that are ``chosen``."""
    rows = stored(stats.select("doc_id", "stats").join(own, "doc_id").select("stats", (F.col("mean") >= 0.5).cast("int").alias("y"), (F.crc32(F.encode(F.concat(F.col("doc_id").cast("string"), F.lit("c")), "utf-8")) % 4 == 0).alias("calibrate")).coalesce(PARTS), "labelled").coalesce(PARTS)
    d, width = len(NAMES), WIDTH + 1

    def summed(per_batch, size: int) -> np.ndarray:
        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size)
            for part in parts:
                if part.num_rows:
                    total += per_batch(matrix(part.column(0)), part.column(1).to_numpy(zero_copy_only=False).astype(float), part.column(2).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["total"])

        return sum((np.frombuffer(bytes(r[0])) for r in rows.mapInArrow(run, "total binary").collect()), np.zeros(size))

    moments = summed(lambda x, y, c: np.concatenate(([len(x), y.sum()], x.sum(0), (x * x).sum(0))), 2 + 2 * d)
    count, good = moments[:2]
    if not 0 < good < count:
        share = good / count if count else 0.5
        return Model(np.zeros(d), np.ones(d), np.zeros(width), np.array([0.0]), np.array([share]))
    mean = moments[2 : 2 + d] / count
    scale = np.sqrt(np.maximum(moments[2 + d :] / count - mean**2, 0))
    scale[scale < 1e-9] = 1.0

    def normal(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> np.ndarray:
        z = fourier((x[~c] - mean) / scale)
        return np.concatenate(((z.T @ z).ravel(), z.T @ y[~c]))

    sums = summed(normal, width * width + width)
    gram = sums[: width * width].reshape(width, width)
    weights = np.linalg.solve(gram + RIDGE * np.eye(width) * max(1.0, np.trace(gram) / width) * 1e-2, sums[width * width :])
    model = Model(mean, scale, weights, np.array([0.0]), np.array([0.0]))

    def calibration(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> np.ndarray:
        at = np.clip(((model.raw(x[c]) - LOW) / (HIGH - LOW) * BINS).astype(int), 0, BINS - 1)
        return np.concatenate((np.bincount(at, minlength=BINS), np.bincount(at, y[c], BINS))).astype(float)

    bins = summed(calibration, 2 * BINS)
    full = np.flatnonzero(bins[:BINS])
    if len(full):
        model.edges, model.values = LOW + (full + 0.5) * (HIGH - LOW) / BINS, isotonic(bins[full], bins[BINS + full])
    else:
        model.edges, model.values = np.array([0.0, 1.0]), np.array([0.0, 1.0])
    return model


def scored(stats: DataFrame, model: Model, column: str = "stats", to: str = "score") -> DataFrame:
    """stats with the score, 0 to 1, in place of the statistics."""
    stats, names = aside(stats, [to])
    column = names[column]
    kept = [c for c in stats.columns if c != column]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            score = model.score(matrix(part.column(part.schema.get_field_index(column)))) if part.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), pa.array(score, pa.float64())], [*kept, to])

    return stats.mapInArrow(run, T.StructType([*(f for f in stats.schema if f.name in kept), T.StructField(to, T.DoubleType())]))


def rated(docs: DataFrame, model: Model, text_col: str = "text", to: str = "score") -> DataFrame:
    """docs with the score of text_col added: statistics and score by one Python worker a task."""
    docs, names = aside(docs, [to])
    kept, text_col = docs.columns, names[text_col]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            stats = np.array([statistics(x.as_py() or "") for x in part.column(part.schema.get_field_index(text_col))], float).reshape(-1, len(NAMES))
            score = model.score(stats) if len(stats) else np.empty(0)
            yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in kept), pa.array(score, pa.float64())], [*kept, to])

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, T.StructType([*(f for f in docs.schema if f.name in kept), T.StructField(to, T.DoubleType())]))


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3) -> DataFrame:
    """docs that score least or more, in their own columns.  Statistics to learn from are those of ``chosen`` rows alone, told to each task."""
    score = "__foliomill_score"
    own = stored(chosen(labels), "chosen")
    some = docs.select("doc_id", "text").join(F.broadcast(own.select("doc_id")), "doc_id", "left_semi")  # about MOST_LABELLED ids
    model = fit(with_statistics(some), own)
    docs, names = aside(docs, [score])
    return restored(rated(docs, model, names["text"], score).where(F.col(score) >= least), names)
