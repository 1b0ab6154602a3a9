"""Filter interaction audit: every order of five document filters is replayed.

Each document's five failures are found once, in its row.  They are crossed with
the 120 orders, a broadcast table of fixed size; an order's first failing filter
decides where the document goes; five steps are exploded, and conditional sums
by (part, order, step) are combined in each task before they are shuffled, so
what travels grows with parts and tasks, not with documents.

Filter E asks for the smallest doc_id of each text.  Texts are compared by their
SHA-256, the least id of repeated ones is written as a table, and its join and
that with labels are plain equi-joins of short rows which Spark may split where a
text, or an id, holds much of the table.

Defined cases: a null text is empty; a null part is the empty string and shares
its rows; a null doc_id is neither smaller nor larger than any, has no label and
never fails E; rows that repeat an id and a text don't fail E by each other; an
id that labels mention more than once is good (toxic) if any of its rows says
so; a null label says nothing; an empty table has no part and gives no rows;
further columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, UPPER, stored

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_UPPER, MARKS = 200, 50, 3, "#$%&*|"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]


def text_failures(text: Column) -> dict[str, Column]:
    """Failures of the filters that look at one text."""
    words = F.array_remove(F.split(text, f"[{SPACE}]+", -1), "")
    upper = F.octet_length(F.regexp_replace(text, f"[^{UPPER[0]}-{UPPER[-1]}]+", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * upper > MOST_UPPER * F.length(text),
        "D": text.rlike(f"[{MARKS}]"),
    }


def failures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(doc_id, part, A, B, C, D, E) for each document: whether each filter fails it."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = stored(rows.select("doc_id", "part", *(x.alias(k) for k, x in text_failures(F.col("text")).items()), F.unhex(F.sha2("text", 256)).alias("digest")), "failures")
    repeated = rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "least")
    return rows.join(stored(repeated, "repeated"), "digest", "left").select("doc_id", "part", *"ABCD", F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).alias("E"))


def with_labels(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """flags with good and toxic added."""
    says = lambda c, name: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(name)
    own = stored(labels.where("doc_id is not null").groupBy("doc_id").agg(says("quality", "good"), says("toxic", "toxic")), "labels")
    return flags.join(own, "doc_id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})


def orders(flags: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(filter_order, o1, o2, ...): every order of the filters."""
    rows = [("".join(p), *p) for p in permutations(filters)]
    return flags.sparkSession.createDataFrame(rows, "filter_order string, " + ", ".join(f"o{k} string" for k in range(1, len(filters) + 1)))


def replay(flags: DataFrame, filters: str = FILTERS) -> DataFrame:
    """(part, filter_order, step, COUNTS, shapley) from rows of (part, one flag for each filter, good, toxic)."""
    n = len(filters)
    fails = lambda letter: F.coalesce(*(F.when(letter == x, F.col(x)) for x in filters))
    own = flags.withColumn("n_fails", sum(F.col(x).cast("int") for x in filters))
    met = own.crossJoin(F.broadcast(orders(flags, filters)))  # n! rows, whatever the input
    met = met.withColumn("first", F.coalesce(*(F.when(fails(F.col(f"o{k}")), F.lit(k)) for k in range(1, n + 1)), F.lit(n + 1)))
    met = met.select("part", "filter_order", "first", "n_fails", "good", "toxic", *(fails(F.col(f"o{k}")).alias(f"f{k}") for k in range(1, n + 1)), F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    here = F.coalesce(*(F.when(F.col("step") == k, F.col(f"f{k}")) for k in range(1, n + 1)))
    step, first = F.col("step"), F.col("first")
    many = lambda c, name: F.sum(c.cast("long")).alias(name)
    sums = met.groupBy("part", "filter_order", "step").agg(
        many(first > step, "kept"), many(first == step, "removed"), many(here & (first < step), "redundant"), many(here & (F.col("n_fails") == 1), "unique_fails"),
        many((first == step) & F.col("good"), "good_lost"), many((first == step) & F.col("toxic"), "toxic_lost"),
    )
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    return sums.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", letter)))  # n! rows for each part and filter


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """(part, filter_order, step, COUNTS, shapley): each part's documents through each order of the filters, step by step."""
    return replay(with_labels(failures(docs, id_col, text_col, part_col), labels))
