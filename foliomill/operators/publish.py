"""Listings, chronology, totals, sitemap, structured data and plain-text pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNDATED, SCHEMA = "Sans date", "https://schema.org"
#: Priority of each class of page in the sitemap.
PRIORITY = {"home": "1.0", "about": "0.5", "search": "0.7", "chronology": "0.5", "list": "0.8", "document": "0.9"}
#: The most characters of a text that each place shows, and those where an ellipsis tells of more.
SHOWN = {"description": 300, "card": 230, "index": 180, "contents": 110, "neighbour": 80, "tab": 80}
WITH_ELLIPSIS = {"card"}


def by_type(docs: DataFrame) -> DataFrame:
    """(type, n, in_force): documents of each type, and those not repealed."""
    return docs.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("repealed")).alias("in_force"))


def chronology(docs: DataFrame) -> DataFrame:
    """(year, n): newest first in binary string order, so documents without a year lead."""
    return docs.groupBy(F.coalesce(F.nullif("year", F.lit("")), F.lit(UNDATED)).alias("year")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("year"))


def recent(docs: DataFrame, most: int = 8) -> DataFrame:
    """The most recent documents, document order among equals: a top-k, not a sort of all."""
    return docs.orderBy(F.desc("date"), F.asc("doc")).limit(most)


def totals(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("documents"), F.sum("pages").alias("pages"), F.sum("chars").alias("chars"))


def sitemap(pages: DataFrame, base: str) -> DataFrame:
    """(loc, priority) from pages (path, class)."""
    priority = F.element_at(F.create_map(*[F.lit(x) for kv in PRIORITY.items() for x in kv]), F.col("class"))
    return pages.select(F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace("path", "^/+", "")).alias("loc"), priority.alias("priority"))


def sitemap_xml(urls: DataFrame) -> DataFrame:
    """One text row for each entry, to write as a file part."""
    return urls.select(F.format_string("<url><loc>%s</loc><priority>%s</priority></url>", "loc", "priority").alias("value"))


def plain_page(docs: DataFrame) -> DataFrame:
    """(doc, page): title, a rule of its length, a blank line, the text."""
    rule = F.repeat(F.lit("="), F.length("title"))
    return docs.select("doc", F.concat("title", F.lit("\n"), rule, F.lit("\n\n"), "text", F.lit("\n")).alias("page"))


def identifier(kind: Column, label: Column, number: Column, short: Column) -> Column:
    """What a document is called by: its kind's label and its number, else its short title; base texts by their short title."""
    named = F.trim(F.concat_ws(" ", F.nullif(label, F.lit("")), F.nullif(number, F.lit(""))))
    return F.when((kind == "base") | (named == ""), short).otherwise(named)


def _thing(kind: str, **members: Column | str | None) -> Column:
    """An object of linked data: its type, then its members; null ones are left out when it becomes JSON."""
    return F.struct(*_members(kind, **members))


def _members(kind: str, **members: Column | str | None) -> list[Column]:
    return [F.lit(kind).alias("@type"), *[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in members.items()]]


def structured_data(docs: DataFrame, base: str, jurisdiction: str, publisher: str, language: str = "fr") -> DataFrame:
    """(doc, json): schema.org Legislation of each document (doc, slug, type, label, number, title, short, year, date, summary, repealed, pdf).

    The date is that of publication; it is the act's date too only if its year is that of the act.  An empty date or summary isn't stated."""
    date = F.nullif(F.coalesce("date", F.lit("")), F.lit(""))
    url = F.concat(F.lit(base.rstrip("/") + "/textes/"), "slug", F.lit("/"))
    body = _members(
        "Legislation", name=F.col("title"), legislationIdentifier=identifier(F.col("type"), F.col("label"), F.col("number"), F.col("short")), legislationType=F.col("label"), legislationJurisdiction=jurisdiction,
        legislationLegalForce=F.when(F.coalesce("repealed", F.lit(False)), "NotInForce").otherwise("InForce"), inLanguage=language, url=url, publisher=_thing("GovernmentOrganization", name=publisher),
        isBasedOn=_thing("DigitalDocument", name=F.col("title"), url=F.col("pdf"), encodingFormat="application/pdf"),
        datePublished=date, legislationDate=F.when((F.col("year") != "") & (F.substring(date, 1, 4) == F.col("year")), date), abstract=F.nullif(F.coalesce("summary", F.lit("")), F.lit("")),
    )
    return docs.select("doc", F.to_json(F.struct(F.lit(SCHEMA).alias("@context"), *body)).alias("json"))


def breadcrumbs(docs: DataFrame, base: str, home: str = "Accueil") -> DataFrame:
    """(doc, json): schema.org BreadcrumbList of each document (doc, type, label, number, short, plural, folder): home, its kind's list, itself."""
    root = base.rstrip("/") + "/"
    step = lambda n, name, item: _thing("ListItem", position=F.lit(n), name=name, item=item)
    own = identifier(F.col("type"), F.col("label"), F.col("number"), F.col("short"))
    steps = F.array(step(1, F.lit(home), F.lit(root)), step(2, F.col("plural"), F.concat(F.lit(root), "folder", F.lit("/"))), step(3, own, F.lit(None).cast("string")))
    return docs.select("doc", F.to_json(F.struct(F.lit(SCHEMA).alias("@context"), F.lit("BreadcrumbList").alias("@type"), steps.alias("itemListElement"))).alias("json"))


def shown(text: Column, place: str) -> Column:
    """As much of a text as a place shows."""
    most = SHOWN[place]
    start = F.substring(text, 1, most)
    return F.when(F.length(text) > most, F.concat(start, F.lit("…"))).otherwise(start) if place in WITH_ELLIPSIS else start


def citation(identifier: Column, title: Column, year: Column, authority: str) -> Column:
    """How a document is cited; without a year, nothing stands in its place."""
    dated = F.when(F.coalesce(year, F.lit("")) != "", F.concat(F.lit(" ("), year, F.lit(")"))).otherwise("")
    return F.concat(identifier, F.lit(", "), title, dated, F.lit(f". {authority}."))


def tab_title(identifier: Column, short: Column) -> Column:
    """The identifier and the short title, once where they are equal."""
    return F.when(identifier == short, identifier).otherwise(F.concat(identifier, F.lit(" — "), shown(short, "tab")))


def counted(n: Column, singular: str, plural: str | None = None, none_is_plural: bool = False) -> Column:
    """A number and its noun: the plural from two on, and for none where that is said."""
    several = (n != 1) if none_is_plural else (n > 1)
    return F.concat(n.cast("string"), F.lit(" "), F.when(several, plural or singular + "s").otherwise(singular))


def findings(rows: DataFrame, caps: dict[str, int]) -> DataFrame:
    """(level, place, text): the first findings (level, place, text) of each level by place, and a last line, without a place, that counts those left out.

    Ranks end at the largest cap, which Spark applies before it shuffles; all are counted by partial sums."""
    cap = F.element_at(F.create_map(*[F.lit(x) for kv in caps.items() for x in kv]), F.col("level"))
    known = rows.where(F.col("level").isin(*caps))
    rank = F.row_number().over(Window.partitionBy("level").orderBy("place", "text"))
    listed = known.withColumn("r", rank).where(F.col("r") <= max(caps.values())).where(F.col("r") <= cap).select("level", "place", "text")
    left = known.groupBy("level").agg(F.count(F.lit(1)).alias("n")).withColumn("more", F.col("n") - cap).where("more > 0")
    return listed.unionByName(left.select("level", F.lit(None).cast(known.schema["place"].dataType).alias("place"), F.concat(F.lit("… and "), F.col("more").cast("string"), F.lit(" more")).alias("text")))
