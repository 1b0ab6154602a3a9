"""What recognition may have misread: suspect passages with their contexts, amounts, pages to read again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Labels and patterns of suspect passages, white space and amounts, thresholds.
SUSPECTS = [
    ("digit-letter-digit", r"(?U)\d[a-zA-Z]\d"),
    ("letter on a number", r"(?U)[a-zA-Z]\d{3,}"),
    ("I, l or 1", r"(?U)\b[Il1]{2,}\b"),
    ("O or 0", r"(?U)\b0[a-zA-Z]|\b[a-zA-Z]0\b"),
    ("lone punctuation", r"(?U)\s[,;:]\s"),
    ("open quotation mark", r"(?Umd)[«»\"]\s*$"),
    ("number to verify", r"(?U)\b\d{1,3}\s\d{3}\s\d{3}\s\d{3}\b"),
    ("unexpected character", r"(?U)[^\s\w.,;:()\[\]«»’'\-–—/%°§\"!?&+=…]"),
    ("article misread", r"(?iuU)\bartlcle|\barticie|\bartide"),
    ("rn for m", r"(?iuU)\brnillion|\brnontant|\brnarché"),
]
BLANK = r"\s\p{Z}\x0B\x1C-\x1F"
AMOUNT = rf"\p{{Nd}}[\p{{Nd}}{BLANK}]{{2,}}"
LEAST_AMOUNT, MOST_AMOUNTS, MOST_ALERTS, AROUND, LOW_CONFIDENCE, LEAST_LAYER = 7, 8, 14, 45, 82.0, 120
RETRY_BELOW, MARGIN_OF_TURNED, FINE_DPI = 78, 3, 400
# End of the fixed values.


def amounts(text: Column) -> Column:
    """The first distinct amounts of a text, to be compared with its source."""
    found = F.transform(F.regexp_extract_all(text, F.lit(AMOUNT), F.lit(0)), lambda x: F.regexp_replace(x, f"[{BLANK}]+$", ""))
    return F.slice(F.array_sort(F.array_distinct(F.filter(found, lambda x: F.length(x) >= LEAST_AMOUNT))), 1, MOST_AMOUNTS)


def counts(pages: DataFrame) -> DataFrame:
    """(label, n): suspect passages of each kind in all pages (text), one scan for all patterns."""
    sums = pages.agg(*[F.sum(F.regexp_count("text", F.lit(p))).alias(f"c{i}") for i, (_, p) in enumerate(SUSPECTS)])
    each = [F.struct(F.lit(label).alias("label"), F.coalesce(F.col(f"c{i}"), F.lit(0)).cast("long").alias("n")) for i, (label, _) in enumerate(SUSPECTS)]
    return sums.select(F.explode(F.array(*each)).alias("x")).select("x.*")


def contexts(pages: DataFrame, most: int = MOST_ALERTS) -> DataFrame:
    """(doc, page, place, label, context): the first alerts of each page (doc, page, text), kind by kind, with the characters around them.

    No more than the first matches of a kind can be among them, so positions are sums of so many lengths at most."""

    def of(label: str, pattern: str) -> Column:
        got, gaps = F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), F.split("text", pattern, -1)
        lengths = F.arrays_zip(F.transform(F.slice(gaps, 1, most), F.length).alias("g"), F.transform(F.slice(got, 1, most), F.length).alias("m"))
        found = F.filter(lengths, lambda x: x["m"].isNotNull())
        reach = lambda i: F.aggregate(F.slice(found, 1, i + 1), F.lit(0), lambda n, x: n + x["g"] + x["m"])

        def shown(x: Column, i: Column) -> Column:
            begin = F.greatest(reach(i) - x["m"] - AROUND, F.lit(0))
            return F.struct(F.lit(label).alias("label"), T.stripped(F.replace(F.substring(F.col("text"), begin + 1, reach(i) + AROUND - begin), F.lit("\n"), F.lit(" "))).alias("context"))

        return F.when(F.col("text").rlike(pattern), F.transform(found, shown)).otherwise(F.array().cast("array<struct<label:string,context:string>>"))

    alerts = F.slice(F.concat(*[of(label, p) for label, p in SUSPECTS]), 1, most)
    return pages.select("doc", "page", F.posexplode(alerts).alias("place", "a")).select("doc", "page", "place", "a.*")


def to_reread(pages: DataFrame) -> DataFrame:
    """Pages (confidence) that are to be read again as a whole."""
    return pages.where(F.col("confidence") < LOW_CONFIDENCE)


def has_text_layer(text: Column) -> Column:
    return F.length(T.stripped(F.coalesce(text, F.lit("")))) >= LEAST_LAYER


def accepted(pages: DataFrame) -> DataFrame:
    """pages (confidence, dpi, turned: confidences of turned images in the order tried, finer: that of a finer image) with accepted and of_turned, of_finer.

    Below RETRY_BELOW the first turned image that gains more than the margin is taken; if that is still low and the image coarse, the finer one if it is better.  A null wasn't tried."""
    gains = F.get(F.filter("turned", lambda c: c > F.col("confidence") + MARGIN_OF_TURNED), F.lit(0))
    turned = F.when(F.col("confidence") < RETRY_BELOW, gains)
    now = F.coalesce("turned_to", "confidence")
    finer = F.when((now < RETRY_BELOW) & (F.col("dpi") < FINE_DPI) & (F.col("finer") > now), F.col("finer"))
    own = pages.withColumn("turned_to", turned).withColumn("finer_to", finer)
    return own.select(*pages.columns, F.coalesce("finer_to", now).alias("accepted"), F.col("turned_to").isNotNull().alias("of_turned"), F.col("finer_to").isNotNull().alias("of_finer"))
