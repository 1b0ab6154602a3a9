"""Queries of integrity checks and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import integrity, quality, search, structure
from . import audits, retrieval
from .registry import query, table
from .retrieval import _COVER, _INDEX, _SCORES, _TERMS
from .structure import _BLOCKS, _blocks


_PATH = "regexp_replace(regexp_replace(url, '^[A-Za-z]+://[^/?#]*', ''), '[?#].*$', '')"


@query(f"""
WITH u AS (SELECT DISTINCT CASE page_id % 4 WHEN 1 THEN url || '/' WHEN 2 THEN url || '?x=1#y' WHEN 3 THEN replace(url, 'e', '%65') ELSE url END AS url FROM pages),
c AS (SELECT url, trim(url_decode(replace({_PATH}, '+', '%2B')), '/') AS p FROM u),
v AS (SELECT url, unnest([p, CASE WHEN contains(p, '/') THEN substr(p, strpos(p, '/') + 1) ELSE '' END]) AS v FROM c),
own AS (SELECT CASE WHEN page_id % 2 = 0 THEN p || '/index.html' ELSE p END AS path FROM (SELECT page_id, trim({_PATH}, '/') AS p FROM pages WHERE page_id % 3 = 0)),
met AS (SELECT url FROM v WHERE v <> '' AND (v IN (SELECT path FROM own) OR v || '/index.html' IN (SELECT path FROM own)))
SELECT url FROM u WHERE url NOT IN (SELECT url FROM met)""")
def sitemap_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as a sitemap, with last slashes, queries and percent signs; those with a key divisible by three as the files there are, half of them as folders."""
    own, k = table(spark, sf_dir, "pages"), F.col("page_id")
    url = F.when(k % 4 == 1, F.concat("url", F.lit("/"))).when(k % 4 == 2, F.concat("url", F.lit("?x=1#y"))).when(k % 4 == 3, F.replace("url", F.lit("e"), F.lit("%65"))).otherwise(F.col("url"))
    path = F.regexp_replace(F.regexp_replace("url", "^[A-Za-z]+://[^/?#]*", ""), "^/+|[?#].*$|/+$", "")
    return integrity.unmatched_urls(own.select(url.alias("url")), own.where("page_id % 3 = 0").select(F.when(k % 2 == 0, F.concat(path, F.lit("/index.html"))).otherwise(path).alias("path")))


@query("""
WITH t AS (SELECT DISTINCT l_orderkey AS doc FROM lineitem)
SELECT 'no page' AS fault, c_custkey AS doc FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) UNION ALL SELECT 'stray posting', doc FROM t WHERE doc NOT IN (SELECT c_custkey FROM customer)""")
def index_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as indexed documents, order lines as postings, orders as pages."""
    docs, pages = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc")), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"))
    return integrity.index_faults(docs, table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc")), pages)


@query(audits._PAGES + """
SELECT c_custkey AS doc, CASE WHEN r.doc IS NULL THEN 'no output produced' ELSE printf('%.1f %%, %d weak', round_even(r.confidence, 1), r.weak) END AS note FROM customer LEFT JOIN r ON r.doc = c_custkey""")
def ingest_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"))
    return integrity.notes(new, quality.rollup(audits._recognised(spark, sf_dir)).select("doc", "confidence", "weak"))


@query(audits._KINDS + """,
a AS (SELECT doc, list_sort(list(page)) AS p FROM empty GROUP BY doc)
SELECT doc, CASE WHEN len(p) > 4 THEN array_to_string(p[1:4], ', ') || ' (+' || (len(p) - 4) || ')' ELSE array_to_string(p, ', ') END AS pages FROM a""")
def coherence_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Empty pages of each document as a report lists them."""
    empty = quality.empty_pages(audits._customers(spark, sf_dir), audits._kinds(spark, sf_dir))
    return empty.groupBy("doc").agg(F.array_sort(F.collect_list("page")).alias("p")).select("doc", integrity.listed(F.col("p"), 4).alias("pages"))


@query("""
WITH t AS (SELECT p_partkey AS target, CASE WHEN p_partkey % 50 = 0 THEN 'Modifiant l''Article premier du règlement' WHEN p_partkey % 7 = 0 THEN p_name ELSE 'Modifiant l''Article ' || (p_partkey % 1000) || ' et ' || p_name END AS title FROM part),
r AS (SELECT s_suppkey AS source, CASE WHEN s_suppkey % 10 = 0 THEN 'premier' ELSE CAST(s_suppkey % 1000 AS VARCHAR) END AS article FROM supplier)
SELECT source, target FROM r JOIN t ON contains(lower(strip_accents(title)), 'article ' || article) WHERE source <> target""")
def amending_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as references to articles, parts as texts whose titles name some; 3 is held by 37."""
    k, s = F.col("p_partkey"), F.col("s_suppkey")
    refs = table(spark, sf_dir, "supplier").select(s.alias("source"), F.when(s % 10 == 0, "premier").otherwise((s % 1000).cast("string")).alias("article"))
    title = F.when(k % 50 == 0, "Modifiant l'Article premier du règlement").when(k % 7 == 0, F.col("p_name")).otherwise(F.concat(F.lit("Modifiant l'Article "), (k % 1000).cast("string"), F.lit(" et "), "p_name"))
    return integrity.amending(refs, table(spark, sf_dir, "part").select(k.alias("target"), title.alias("title")))


def _anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.when(F.col("kind") == "article", F.concat(F.lit("Article "), (F.col("place") % 3).cast("string"))).when(F.col("kind") == "titre", F.concat(F.lit("Titre "), (F.col("place") % 2).cast("string"))).otherwise("")
    own = _blocks(spark, sf_dir).withColumn("mark", mark)
    heads = structure.anchors(own.where("mark <> ''").select("doc", "place", "mark")).select("doc", "place", "anchor")
    return own.join(heads, ["doc", "place"], "left")


_ANCHORED = _BLOCKS + """,
a AS (SELECT *, CASE kind WHEN 'article' THEN 'article-' || (place % 3) WHEN 'titre' THEN 'titre-' || (place % 2) END AS base FROM block),
n AS (SELECT *, row_number() OVER (PARTITION BY doc, base ORDER BY place) AS n FROM a),
h AS (SELECT *, CASE WHEN base IS NOT NULL THEN CASE WHEN n = 1 THEN base ELSE base || '-' || n END END AS anchor FROM n)"""


@query(_ANCHORED + """
SELECT doc, string_agg(CASE kind WHEN 'article' THEN '<h4 id="' || anchor || '">Article ' || (place % 3) || ' — ' || text || '</h4>' WHEN 'titre' THEN '<h2 id="' || anchor || '">Titre ' || (place % 2) || ' — ' || text || '</h2>'
  WHEN 'puce' THEN '<li>' || text || '</li>' ELSE '<p>' || text || '</p>' END, chr(10) ORDER BY place) AS html FROM h GROUP BY doc""")
def html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.html(_anchored(spark, sf_dir))


@query(_ANCHORED + " SELECT doc, place, anchor FROM h WHERE base IS NOT NULL AND doc IN (SELECT doc FROM h WHERE base IS NOT NULL GROUP BY doc HAVING count(*) >= 3)")
def table_of_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.contents(_anchored(spark, sf_dir))


@query(_INDEX + _TERMS + _SCORES + f""",
rated AS (SELECT query, doc, round({_COVER} * CASE WHEN repealed THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END, 6) AS score FROM raw JOIN useful USING (query) JOIN own USING (doc)),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS r, max(score) OVER (PARTITION BY query) AS top FROM rated) WHERE r <= 6)
SELECT query, doc, score, round(0.7::DOUBLE + 0.3::DOUBLE * score / top, 6) AS prior FROM best""")
def answer_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The six documents whose passages answer a question, and the prior that their rank gives those passages."""
    found, docs = retrieval._scored(spark, sf_dir)
    best = search.top(search.ranked(found, docs.drop("type")), 6)
    prior = 0.7 + 0.3 * F.col("score") / F.max("score").over(Window.partitionBy("query"))
    return best.select("query", "doc", "score", F.round(prior, 6).alias("prior"))


