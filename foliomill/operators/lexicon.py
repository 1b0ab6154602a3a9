"""Word frequencies of a corpus, attested compounds, and repair of compounds that lost their hyphen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LETTERS = "A-Za-zÀ-ÿ"
WORD = f"[{LETTERS}]{{2,}}"
COMPOUND = f"[{LETTERS}]{{3,}}-[{LETTERS}]{{3,}}"
RARE, LEAST_LENGTH, LEAST_PART, COMMON = 2, 12, 4, 4


def frequencies(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(word, n): occurrences of each word in lower case."""
    found = texts.select(F.explode_outer(F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1))).alias("word")).where("word is not null")
    return found.groupBy(F.lower("word").alias("word")).agg(F.count(F.lit(1)).alias("n"))


def compounds(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(compound): distinct hyphenated compounds in lower case."""
    found = texts.select(F.explode_outer(F.regexp_extract_all(F.col(text_col), F.lit(f"({COMPOUND})"), F.lit(1))).alias("compound")).where("compound is not null")
    return found.select(F.lower("compound").alias("compound")).distinct()


def repairs(freq: DataFrame, known: DataFrame) -> DataFrame:
    """(word, at): rare long words whose halves are common and attested as a compound; at: length of the left half, the smallest that fits.

    Candidates come from attested compounds, not from all splits of all words."""
    halves = known.select(F.split("compound", "-").alias("p")).select(F.get("p", 0).alias("left"), F.get("p", 1).alias("right"))
    halves = halves.where((F.length("left") >= LEAST_PART) & (F.length("right") >= LEAST_PART)).withColumn("word", F.concat("left", "right")).where(F.length("word") >= LEAST_LENGTH)
    count = lambda name: freq.select(F.col("word").alias(name), F.col("n").alias(f"n_{name}"))
    met = halves.join(count("left"), "left").join(count("right"), "right").where((F.col("n_left") >= COMMON) & (F.col("n_right") >= COMMON))
    rare = freq.where(F.col("n") <= RARE).select("word")
    return met.join(rare, "word", "left_semi").groupBy("word").agg(F.min(F.length("left")).alias("at"))


def repaired(texts: DataFrame, fixes: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, text, n_repaired): hyphens put back.  Words are met with the repairs, and each text is rewritten in its own row."""
    found = texts.select(*keys, F.explode(F.array_distinct(F.regexp_extract_all(F.col(text_col), F.lit(f"({WORD})"), F.lit(1)))).alias("written")).where(F.length("written") >= LEAST_LENGTH)
    hits = found.withColumn("word", F.lower("written")).join(fixes, "word").groupBy(*keys).agg(F.collect_list(F.struct("written", "at")).alias("fixes"))
    met = texts.select(*keys, F.col(text_col).alias("text")).join(hits, keys, "left")

    def mended(text: Column) -> Column:
        whole = lambda w: F.concat(F.lit(f"(?<![{LETTERS}])"), w, F.lit(f"(?![{LETTERS}])"))
        return F.aggregate("fixes", text, lambda acc, x: F.regexp_replace(acc, whole(x["written"]), F.concat(F.substring(x["written"], F.lit(1), x["at"]), F.lit("-"), F.substring(x["written"], x["at"] + 1, F.length(x["written"])))))

    return met.select(*keys, F.when(F.col("fixes").isNull(), F.col("text")).otherwise(mended(F.col("text"))).alias("text"), F.when(F.col("fixes").isNull(), 0).otherwise(F.size("fixes")).alias("n_repaired"))
