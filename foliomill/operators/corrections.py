"""Ordered, idempotent corrections of pages, and their outcomes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def outcomes(rules: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Corrected pages (doc, page, text, patched) and (applied, already, missing, n rules of missing pages counted as missing).

    rules: doc, page, place, old, new, whole.  A rule with whole replaces the page if it differs; else all of old becomes
    new where it occurs, or the rule was applied already if new occurs, or it is missing.  Rules are folded in order
    within a page's row; a rule without old or new, or whole, counts nowhere."""
    ordered = rules.groupBy("doc", "page").agg(F.array_sort(F.collect_list(F.struct("place", "old", "new", "whole"))).alias("rules"))
    met = pages.select("doc", "page", "text").join(ordered, ["doc", "page"], "full")
    start = F.struct(F.coalesce("text", F.lit("")).alias("text"), F.lit(0).alias("applied"), F.lit(0).alias("already"), F.lit(0).alias("missing"))

    def step(acc, r):  # noqa: ANN001, ANN202
        def state(text, applied, already, missing):  # noqa: ANN001, ANN202
            return F.struct(text.alias("text"), (acc["applied"] + applied).cast("int").alias("applied"), (acc["already"] + already).cast("int").alias("already"), (acc["missing"] + missing).cast("int").alias("missing"))

        return (
            F.when(r["whole"].isNotNull() & (acc["text"] != r["whole"]), state(r["whole"], 1, 0, 0))
            .when(r["whole"].isNotNull(), state(acc["text"], 0, 1, 0))
            .when(r["old"].isNull() | r["new"].isNull(), state(acc["text"], 0, 0, 0))
            .when(F.contains(acc["text"], r["old"]), state(F.replace(acc["text"], r["old"], r["new"]), 1, 0, 0))
            .when(F.contains(acc["text"], r["new"]), state(acc["text"], 0, 1, 0))
            .otherwise(state(acc["text"], 0, 0, 1))
        )

    empty = F.array().cast("array<struct<place:int,old:string,new:string,whole:string>>")
    done = met.withColumn("r", F.aggregate(F.coalesce(F.col("rules").cast("array<struct<place:int,old:string,new:string,whole:string>>"), empty), start, step))
    fixed = done.where(F.col("text").isNotNull()).select("doc", "page", F.col("r.text").alias("text"), (F.col("r.applied") > 0).alias("patched"))
    lost = F.col("text").isNull()
    count = lambda name: F.coalesce(F.sum(F.when(~lost, F.col(f"r.{name}"))), F.lit(0))
    totals = done.where("rules is not null").agg(count("applied").alias("applied"), count("already").alias("already"), (count("missing") + F.coalesce(F.sum(F.when(lost, F.size("rules"))), F.lit(0))).alias("missing"))
    return fixed, totals
