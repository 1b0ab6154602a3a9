"""Integrity of what is published: sitemap against files, index against pages, notes on new documents, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import references


def unmatched_urls(urls: DataFrame, files: DataFrame) -> DataFrame:
    """urls (url) whose path no file (path) has, as it is or without its first segment, and no index.html of such a folder.

    Percent signs are decoded; a last slash, a query and a fragment don't matter."""
    path = F.regexp_replace(F.regexp_replace("url", "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", ""), "[?#].*$", "")
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    own = urls.distinct().select("url", F.regexp_replace(F.regexp_replace(plain, "/+", "/"), "^/|/$", "").alias("p"))
    inner = F.when(F.contains("p", F.lit("/")), F.regexp_replace("p", "^[^/]*/", "")).otherwise("")
    places = F.flatten(F.transform(F.array("p", inner), lambda v: F.when(v == "", F.array(F.lit("index.html"))).otherwise(F.array(v, F.concat(v, F.lit("/index.html"))))))
    variants = own.select("url", F.explode(F.array_distinct(places)).alias("path"))
    return urls.distinct().join(variants.join(files.select("path").distinct(), "path", "left_semi").select("url"), "url", "left_anti")


def index_faults(docs: DataFrame, postings: DataFrame, pages: DataFrame) -> DataFrame:
    """(fault, doc): indexed documents (doc) without a page (doc), and postings (doc) without an indexed document."""
    lost = docs.join(pages.select("doc").distinct(), "doc", "left_anti").select(F.lit("no page").alias("fault"), "doc")
    stray = postings.select("doc").distinct().join(docs.select("doc"), "doc", "left_anti").select(F.lit("stray posting").alias("fault"), "doc")
    return lost.unionByName(stray)


def notes(new: DataFrame, recognised: DataFrame) -> DataFrame:
    """(doc, note) for new documents: confidence and weak pages of their recognition (doc, confidence, weak), or that there is none."""
    met = new.select("doc").join(recognised.withColumn("hit", F.lit(True)), "doc", "left")
    said = F.format_string("%.1f %%, %d weak", F.bround("confidence", 1), F.col("weak"))  # half to even, as stored figures are
    return met.select("doc", F.when(F.col("hit").isNull(), "no output produced").otherwise(said).alias("note"))


def listed(numbers: Column, most: int = 8) -> Column:
    """Numbers as text: the first ones and how many more; over 30 only their extent."""
    n = F.size(numbers)
    first = F.array_join(F.slice(numbers, 1, most).cast("array<string>"), ", ")
    extent = F.format_string("%d missing from %d to %d", n, F.array_min(numbers), F.array_max(numbers))
    return F.when(n > 30, extent).when(n > most, F.concat(first, F.lit(" (+"), (n - most).cast("string"), F.lit(")"))).otherwise(first)


def amending(refs: DataFrame, docs: DataFrame) -> DataFrame:
    """(source, target): other documents (target, title) whose title holds "article " and the article of a reference (source, article: "premier", or up to three digits).

    Titles give up the articles they hold, 3 with 37, so containment is an equality join."""
    found = F.regexp_extract_all(T.normalised(F.col("title")), F.lit(r"article (premier|\d{1,3})"), F.lit(1))
    starts = lambda x: F.when(x == "premier", F.array(x)).otherwise(F.transform(F.sequence(F.lit(1), F.length(x)), lambda n: F.substring(x, F.lit(1), n)))
    named = docs.select("target", F.explode(F.array_distinct(F.flatten(F.transform(found, starts)))).alias("article"))
    return references.paired(refs.select("source", "article"), named, ["article"]).where("source <> target")


def html(blocks: DataFrame) -> DataFrame:
    """(doc, html) of blocks (doc, place, kind, text, mark, anchor): headings and articles with anchors, items in lists, paragraphs."""
    text, mark = T.escaped_html(F.col("text")), T.escaped_html(F.col("mark"))
    head = lambda tag: F.concat(F.lit(f'<{tag} id="'), "anchor", F.lit('">'), mark, F.when(F.col("text") != "", F.concat(F.lit(" — "), text)).otherwise(""), F.lit(f"</{tag}>"))
    shown = F.when(F.col("kind") == "titre", head("h2")).when(F.col("kind") == "section", head("h3")).when(F.col("kind") == "article", head("h4")).when(F.col("kind").isin("puce", "numerote"), F.concat(F.lit("<li>"), text, F.lit("</li>"))).otherwise(F.concat(F.lit("<p>"), text, F.lit("</p>")))
    part = F.array_sort(F.collect_list(F.struct("place", shown.alias("shown"))))
    return blocks.groupBy("doc").agg(part.alias("p")).select("doc", F.array_join("p.shown", "\n").alias("html"))


def contents(heads: DataFrame, least: int = 3) -> DataFrame:
    """(doc, place, anchor) of headings and articles of documents that have least of them: their table of contents."""
    own = heads.where(F.col("kind").isin("titre", "article"))
    enough = own.groupBy("doc").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("doc")
    return own.join(enough, "doc", "left_semi").select("doc", "place", "anchor")


def key_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, only_in): keys of one table that the other lacks, such as those of postings and of a table of weights; none where both agree."""
    one, two = a.select(key).distinct(), b.select(key).distinct()
    return one.join(two, key, "left_anti").withColumn("only_in", F.lit("first")).unionByName(two.join(one, key, "left_anti").withColumn("only_in", F.lit("second")))
