"""Queries of what pages show, of files to take in, and of recognition retries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import incremental, integrity, proofreading, publish
from .registry import query, table

_AUTHORITY = "Autorité des marchés"


@query("""
SELECT doc_id, substr(text, 1, 300) AS description, substr(text, 1, 230) || CASE WHEN length(text) > 230 THEN '…' ELSE '' END AS card, substr(text, 1, 180) AS abstract,
  substr(text, 1, 110) AS contents, substr(text, 1, 80) AS neighbour FROM documents""")
def truncations(spark: SparkSession, sf_dir: str) -> DataFrame:
    of = lambda place: publish.shown(F.col("text"), place)
    return table(spark, sf_dir, "documents").select("doc_id", of("description").alias("description"), of("card").alias("card"), of("index").alias("abstract"), of("contents").alias("contents"), of("neighbour").alias("neighbour"))


@query(f"""
WITH d AS (SELECT p_partkey AS doc, p_brand AS ident, p_name AS title, CASE WHEN p_partkey % 4 = 0 THEN p_brand ELSE repeat(p_name || ' ', 6) END AS short, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE CAST(1990 + p_partkey % 30 AS VARCHAR) END AS year FROM part)
SELECT doc, ident || ', ' || title || CASE WHEN year = '' THEN '' ELSE ' (' || year || ')' END || '. {_AUTHORITY}.' AS citation, CASE WHEN ident = short THEN ident ELSE ident || ' — ' || left(short, 80) END AS tab FROM d""")
def citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    year = F.when(k % 3 == 0, "").otherwise((1990 + k % 30).cast("string"))
    short = F.when(k % 4 == 0, F.col("p_brand")).otherwise(F.repeat(F.concat("p_name", F.lit(" ")), F.lit(6)))
    own = table(spark, sf_dir, "part").select(k.alias("doc"), F.col("p_brand").alias("ident"), F.col("p_name").alias("title"), short.alias("short"), year.alias("year"))
    return own.select("doc", publish.citation(F.col("ident"), F.col("title"), F.col("year"), _AUTHORITY).alias("citation"), publish.tab_title(F.col("ident"), F.col("short")).alias("tab"))


@query("""
WITH n AS (SELECT c_custkey AS doc, count(o_orderkey) % 4 AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey)
SELECT doc, n || CASE WHEN n > 1 THEN ' documents' ELSE ' document' END AS documents, n || CASE WHEN n = 1 THEN ' page est signalée' ELSE ' pages sont signalées' END AS pages FROM n""")
def agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of customers, modulo four, as numbers of documents and of pages."""
    n = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    own = table(spark, sf_dir, "customer").join(n, F.col("o_custkey") == F.col("c_custkey"), "left").withColumn("n", F.coalesce("n", F.lit(0)) % 4)
    return own.select(F.col("c_custkey").alias("doc"), publish.counted(F.col("n"), "document").alias("documents"), publish.counted(F.col("n"), "page est signalée", "pages sont signalées", none_is_plural=True).alias("pages"))


@query("""
WITH f AS (SELECT o_orderkey AS place, CASE WHEN o_orderkey % 3 = 0 THEN 'error' ELSE 'warning' END AS level, o_orderpriority AS text FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY level ORDER BY place, text) AS r, CASE level WHEN 'error' THEN 40 ELSE 25 END AS cap FROM f)
SELECT level, place, text FROM r WHERE r <= cap UNION ALL
SELECT level, NULL, '… and ' || (count(*) - cap) || ' more' FROM r GROUP BY level, cap HAVING count(*) > cap""")
def report_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as findings: a report lists 25 warnings and 40 errors."""
    level = F.when(F.col("o_orderkey") % 3 == 0, "error").otherwise("warning")
    return publish.findings(table(spark, sf_dir, "orders").select(level.alias("level"), F.col("o_orderkey").alias("place"), F.col("o_orderpriority").alias("text")), {"warning": 25, "error": 40})


@query("""
SELECT c_custkey AS doc, lead('c_' || c_custkey) OVER (PARTITION BY c_nationkey ORDER BY 'c_' || c_custkey || '.json') AS next FROM customer""")
def file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The file after each, among customers of one nation."""
    own = table(spark, sf_dir, "customer").withColumn("ident", F.concat(F.lit("c_"), F.col("c_custkey").cast("string")))
    return own.select(F.col("c_custkey").alias("doc"), F.lead("ident").over(Window.partitionBy("c_nationkey").orderBy(incremental.file_order(F.col("ident")))).alias("next"))


_ITEMS = "SELECT c_custkey // 2 AS id, CASE c_custkey % 6 WHEN 0 THEN 'Instruction' WHEN 1 THEN 'Circulaire' WHEN 2 THEN 'Avis' WHEN 3 THEN 'Decision' WHEN 4 THEN 'Rapport' END AS category, CASE c_custkey % 5 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE c_name END AS url FROM customer"


@query(f"SELECT DISTINCT id || ' ' || category AS line FROM ({_ITEMS}) WHERE category IN ('Instruction', 'Circulaire', 'Decision', 'Rapport') AND coalesce(url, '') <> ''")
def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as items of a list; some have no category or address."""
    k = F.col("c_custkey")
    category = F.get(F.array(*map(F.lit, ("Instruction", "Circulaire", "Avis", "Decision", "Rapport", None))), (k % 6).cast("int"))
    url = F.when(k % 5 == 0, "").when(k % 5 == 1, None).otherwise(F.col("c_name"))
    return incremental.manifest_lines(table(spark, sf_dir, "customer").select(F.floor(k / 2).alias("id"), category.alias("category"), url.alias("url")))


@query("""
WITH f AS (SELECT p_partkey AS file, ['Décision_n°', 'instruction', 'Avis', '_ CIRCULAIRE _'][p_partkey % 4 + 1] || '  ' || repeat(p_name || ' ', 1 + p_partkey % 5) || '_v1.' || p_partkey || '.pdf' AS name FROM part),
t AS (SELECT file, name, trim(regexp_replace(replace(regexp_replace(name, '[.][^.]*$', ''), '_', ' '), '\\s+', ' ', 'g')) AS title FROM f)
SELECT file, title, 'apport_' || substr(trim(regexp_replace(lower(strip_accents(replace(title, '°', ''))), '[^a-z0-9]+', '-', 'g'), '-'), 1, 80) AS doc,
  CASE lower(split_part(title, ' ', 1)) WHEN 'décision' THEN 'decision' WHEN 'instruction' THEN 'instruction' WHEN 'circulaire' THEN 'circulaire' ELSE 'autre' END AS type FROM t""")
def deposited_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as files; most names are longer than an id shows."""
    k = F.col("p_partkey")
    first = F.get(F.array(*map(F.lit, ("Décision_n°", "instruction", "Avis", "_ CIRCULAIRE _"))), (k % 4).cast("int"))
    name = F.concat(first, F.lit("  "), F.repeat(F.concat("p_name", F.lit(" ")), (k % 5 + 1).cast("int")), F.lit("_v1."), k.cast("string"), F.lit(".pdf"))
    return incremental.deposited(table(spark, sf_dir, "part").select(k.alias("file"), name.alias("name"))).select("file", "title", "doc", "type")


@query("""
WITH p AS (SELECT event_id AS page, value AS c, CASE WHEN event_id % 3 = 0 THEN 400 ELSE 300 END AS dpi, value + event_id % 5 AS t1, value + event_id % 7 AS t2, value + event_id % 11 - 2 AS finer FROM events),
t AS (SELECT *, CASE WHEN c < 78 THEN CASE WHEN t1 > c + 3 THEN t1 WHEN t2 > c + 3 THEN t2 END END AS turned_to FROM p),
f AS (SELECT *, CASE WHEN coalesce(turned_to, c) < 78 AND dpi < 400 AND finer > coalesce(turned_to, c) THEN finer END AS finer_to FROM t)
SELECT page, coalesce(finer_to, turned_to, c) AS accepted, turned_to IS NOT NULL AS of_turned, finer_to IS NOT NULL AS of_finer FROM f""")
def recognition_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as pages: their value is the first confidence, their key says what further attempts gain."""
    k, c = F.col("event_id"), F.col("value")
    own = table(spark, sf_dir, "events").select(k.alias("page"), c.alias("confidence"), F.when(k % 3 == 0, 400).otherwise(300).alias("dpi"), F.array(c + k % 5, c + k % 7).alias("turned"), (c + k % 11 - 2).alias("finer"))
    return proofreading.accepted(own).select("page", "accepted", "of_turned", "of_finer")


@query("""
SELECT key, 'first' AS only_in FROM (SELECT o_custkey AS key FROM orders EXCEPT SELECT l_orderkey FROM lineitem) UNION ALL
SELECT key, 'second' FROM (SELECT l_orderkey AS key FROM lineitem EXCEPT SELECT o_custkey FROM orders)""")
def stale_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of orders as keys of postings, orders of lines as keys of their weights."""
    return integrity.key_differences(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key")), table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("key")), "key")
