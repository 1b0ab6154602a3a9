"""Metadata from several sources with precedence, statuses, unique slugs and the global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

#: Document types with their labels, folders and plurals, in rank order.
TYPES = [("base", "Texte de base", "textes-de-base", "Textes de base"), ("instruction", "Instruction", "instructions", "Instructions"), ("circulaire", "Circulaire", "circulaires", "Circulaires"), ("decision", "Décision", "decisions", "Décisions"), ("autre", "Autre acte", "autres-actes", "Autres actes"), ("rapport", "Rapport", "rapports", "Rapports")]


def resolved(ids: DataFrame, sources: list[DataFrame], key: str, columns: list[str]) -> DataFrame:
    """ids with columns, each from the first source that has a row for the id; origin: its place from 0, null without any.

    A source has one row for each key (``last_of`` makes it so); small ones are broadcast by the optimizer from their sizes."""
    out = ids
    for i, s in enumerate(sources):
        out = out.join(s.select(key, F.struct(*columns).alias(f"__s{i}")), key, "left")
    first = F.coalesce(*[F.col(f"__s{i}") for i in range(len(sources))])
    origin = F.lit(None).cast("int")
    for i in reversed(range(len(sources))):
        origin = F.when(F.col(f"__s{i}").isNotNull(), i).otherwise(origin)
    return out.select(*ids.columns, *[first[c].alias(c) for c in columns], origin.alias("origin"))


def last_of(rows: DataFrame, key: str, place: str) -> DataFrame:
    """The last row of each key by its place in the file."""
    kept = [c for c in rows.columns if c not in (key, place)]
    return rows.groupBy(key).agg(F.max_by(F.struct(*kept), place).alias("r")).select(key, "r.*")


def repealed(flag: Column, title: Column) -> Column:
    return F.coalesce(flag, F.lit(False)) | F.contains(F.lower(F.coalesce(title, F.lit(""))), F.lit("abrog"))


def status(is_repealed: Column) -> Column:
    return F.when(is_repealed, "repealed").otherwise("not repealed")


def with_statuses(docs: DataFrame, statuses: DataFrame, key: str) -> DataFrame:
    """docs whose repealed flag is forced where there is a status row (key, by), with the citation."""
    met = docs.join(statuses.select(key, "by"), key, "left")
    return met.withColumn("repealed", F.col("by").isNotNull() | F.coalesce("repealed", F.lit(False)))


def unique_slugs(rows: DataFrame, order: str) -> DataFrame:
    """rows with slug made unique: the n-th row of a slug in order gets -n, from the second on."""
    n = F.row_number().over(Window.partitionBy("slug").orderBy(order))
    return rows.withColumn("__n", n).withColumn("slug", F.when(F.col("__n") == 1, F.col("slug")).otherwise(F.concat_ws("-", "slug", F.col("__n").cast("string")))).drop("__n")


def slug_core(number: Column, reference: Column, year: Column) -> Column:
    """Number, else reference, then the year unless it is contained."""
    base = F.when(number != "", number).otherwise(reference)
    return T.slug(F.when((year != "") & ~F.contains(base, year), F.concat_ws("-", base, year)).otherwise(base))


def list_order() -> list[Column]:
    """Order within a type's listing: base texts as they stand, others from the newest; ties in document order."""
    base = F.col("type") == "base"
    asc = lambda c: F.when(base, c)
    desc = lambda c: F.when(~base, c)
    return [asc(F.col("rank")).asc(), desc(F.col("rank")).desc(), asc(F.col("year")).asc(), desc(F.col("year")).desc(), asc(T.padded(F.col("number"))).asc(), desc(T.padded(F.col("number"))).desc(), F.col("doc").asc()]


def neighbours(docs: DataFrame) -> DataFrame:
    """docs (doc, type, rank, year, number) with the documents before and after in the listing of their type, and the place."""
    w = Window.partitionBy("type").orderBy(*list_order())
    return docs.withColumn("before", F.lag("doc").over(w)).withColumn("after", F.lead("doc").over(w)).withColumn("place", F.row_number().over(w))


def placed(docs: DataFrame) -> DataFrame:
    """docs (doc, rank, year, number, title) with place: from 0, in the global order of rank, year ('0000' if null or empty), number and title; ties by doc.

    Rows are numbered within each rank and year; of these only counts are summed up in order, so no task sorts all documents."""
    year = F.when(F.coalesce("year", F.lit("")) == "", "0000").otherwise(F.col("year"))
    own = docs.withColumn("__year", year)
    counts = own.groupBy("rank", "__year").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("rank", "__year").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each rank and year
    within = F.row_number().over(Window.partitionBy("rank", "__year").orderBy("number", "title", "doc")) - 1
    met = own.withColumn("__within", within).join(F.broadcast(counts.withColumn("__before", before).drop("n")), ["rank", "__year"])
    return met.withColumn("place", F.col("__before") + F.col("__within")).select(*docs.columns, "place")
