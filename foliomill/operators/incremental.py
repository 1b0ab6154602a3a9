"""What is new since the last run: anti-joins, upserts and the journal."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

#: Categories that are taken, and first words of file names that are types themselves; all other words mean OTHER.
CATEGORIES = ("Instruction", "Circulaire", "Decision", "Rapport")
TYPE_WORDS, OTHER = ("decision", "instruction", "circulaire"), "autre"
#: How ids of deposited files begin, and the most characters of a name that follow.
DEPOSITED, NAME = "apport_", 80


def unseen(items: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """Items whose key isn't known."""
    return items.join(known.select(key).distinct(), key, "left_anti")


def upserted(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """existing and those of new that it hasn't: existing rows are kept as they are."""
    return existing.unionByName(unseen(new, existing, key).select(*existing.columns))


def journal(added: DataFrame, anomalies: DataFrame, day: str) -> DataFrame:
    """One row: the day, documents added and anomalies."""
    return added.agg(F.count(F.lit(1)).alias("added")).crossJoin(anomalies.agg(F.count(F.lit(1)).alias("anomalies"))).select(F.lit(day).alias("day"), "added", "anomalies")  # one row each


def wanted(category: Column, url: Column, categories: tuple[str, ...] = CATEGORIES) -> Column:
    """Whether an item is of a category that is taken, and has an address."""
    return F.coalesce(category.isin(*categories), F.lit(False)) & (F.coalesce(url, F.lit("")) != "")


def manifest_lines(items: DataFrame, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """(line): id and category of the wanted items (id, category, url), each once, in binary order."""
    own = items.where(wanted(F.col("category"), F.col("url"), categories))
    return own.select(F.concat_ws(" ", F.col("id").cast("string"), "category").alias("line")).distinct().orderBy("line")


def deposited(files: DataFrame) -> DataFrame:
    """files (name) with doc, title and type: the title is the name without its ending, its first word the type."""
    title = T.collapsed(F.replace(F.regexp_replace("name", r"(?<=.)\.[^.]*$", ""), F.lit("_"), F.lit(" ")))
    first = T.slug(F.substring_index("title", " ", 1))
    own = files.withColumn("title", title)
    return own.withColumn("doc", F.concat(F.lit(DEPOSITED), T.slug(F.col("title"), NAME))).withColumn("type", F.when(first.isin(*TYPE_WORDS), first).otherwise(OTHER))


def file_order(ident: Column) -> Column:
    """The key by which file names sort: a full stop comes before digits and letters, so `a_1` before `a_10`."""
    return F.concat(ident, F.lit(".json"))
