"""Queries of metadata, listings, corrections and incremental ingest."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import corrections, incremental, metadata, publish
from ..sources.store import shared_dir
from ..streaming.ingest import gained
from .registry import query, table


@query("""
SELECT c_custkey AS ident, CASE WHEN c_custkey % 7 = 0 THEN 'base ' || c_custkey WHEN s_suppkey IS NOT NULL THEN s_name WHEN n_nationkey IS NOT NULL AND c_custkey % 2 = 0 THEN n_name END AS title,
  CAST(CASE WHEN c_custkey % 7 = 0 THEN 0 WHEN s_suppkey IS NOT NULL THEN 1 WHEN n_nationkey IS NOT NULL AND c_custkey % 2 = 0 THEN 2 END AS INTEGER) AS origin
FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey LEFT JOIN nation ON n_nationkey = c_custkey""")
def metadata_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base constants before contributions (suppliers) before the manifest (nations with even keys)."""
    ids = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ident"))
    base = ids.where("ident % 7 = 0").select("ident", F.concat(F.lit("base "), F.col("ident").cast("string")).alias("title"))
    contributed = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("ident"), F.col("s_name").alias("title"))
    manifest = table(spark, sf_dir, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").cast("long").alias("ident"), F.col("n_name").alias("title"))
    return metadata.resolved(ids, [base, contributed, manifest], "ident", ["title"])


@query("SELECT CAST(p_size AS BIGINT) AS id, max_by(p_name, p_partkey) AS name FROM part GROUP BY p_size")
def manifest_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("id"), F.col("p_partkey").alias("place"), F.col("p_name").alias("name"))
    return metadata.last_of(own, "id", "place")


@query("""
SELECT doc_id, repealed, CASE WHEN repealed THEN 'repealed' ELSE 'not repealed' END AS status FROM (
  SELECT doc_id, doc_id IN (SELECT doc_id FROM labels WHERE quality = 0) OR contains(lower(source), 'src1') AS repealed FROM documents)""")
def status_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Low-quality labels are status rows; sources whose name has src1 are repealed by themselves."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.contains(F.lower("source"), F.lit("src1")).alias("repealed"))
    rows = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id").distinct().withColumn("by", F.lit("label"))
    return metadata.with_statuses(docs, rows, "doc_id").select("doc_id", "repealed", metadata.status(F.col("repealed")).alias("status"))


def _catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as documents: a brand is a type (the first is base), the size the rank, digits of the key number and year."""
    kind = F.when(F.col("p_brand") == "Brand#11", "base").otherwise(F.col("p_brand"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("doc"), kind.alias("type"), F.col("p_size").alias("rank"), F.when(F.col("p_partkey") % 11 == 0, "").otherwise((F.lit(1996) + F.col("p_partkey") % 30).cast("string")).alias("year"),
        (F.col("p_partkey") % 137).cast("string").alias("number"), F.col("p_name").alias("title"), (F.col("p_partkey") % 10 == 0).alias("repealed"), F.col("p_retailprice").alias("price"),
    )


_CATALOGUE = """
WITH d AS (SELECT p_partkey AS doc, CASE WHEN p_brand = 'Brand#11' THEN 'base' ELSE p_brand END AS type, p_size AS rank, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE CAST(1996 + p_partkey % 30 AS VARCHAR) END AS year,
  CAST(p_partkey % 137 AS VARCHAR) AS number, p_name AS title, p_partkey % 10 = 0 AS repealed, p_retailprice AS price FROM part),
o AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY CASE WHEN type = 'base' THEN rank END, CASE WHEN type <> 'base' THEN rank END DESC, CASE WHEN type = 'base' THEN year END, CASE WHEN type <> 'base' THEN year END DESC,
  CASE WHEN type = 'base' THEN lpad(number, 8, '0') END, CASE WHEN type <> 'base' THEN lpad(number, 8, '0') END DESC, doc) AS place FROM d)"""


@query(_CATALOGUE + " SELECT doc, lag(doc) OVER (PARTITION BY type ORDER BY place) AS before, lead(doc) OVER (PARTITION BY type ORDER BY place) AS after FROM o")
def neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.neighbours(_catalogue(spark, sf_dir)).select("doc", "before", "after")


@query(_CATALOGUE + " SELECT doc, type, CAST(place AS INTEGER) AS place FROM o")
def listing_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metadata.neighbours(_catalogue(spark, sf_dir)).select("doc", "type", "place")


@query(_CATALOGUE + " SELECT coalesce(nullif(year, ''), 'Sans date') AS year, count(*) AS n FROM d GROUP BY 1")
def chronology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.chronology(_catalogue(spark, sf_dir))


@query("SELECT o_orderkey AS doc, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date FROM orders ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey LIMIT 8")
def recent_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.recent(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), F.col("o_orderdate").cast("date").cast("string").alias("date")))


@query(_CATALOGUE + " SELECT type, count(*) AS n, count(*) FILTER (NOT repealed) AS in_force FROM d GROUP BY type")
def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.by_type(_catalogue(spark, sf_dir))


@query("SELECT count(*) AS documents, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS pages, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents")
def corpus_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select(F.size(F.split("text", "\n", -1)).alias("pages"), F.col("n_chars").alias("chars"))
    return publish.totals(own)


@query("SELECT r_name AS type FROM region WHERE EXISTS (SELECT 1 FROM nation JOIN customer ON c_nationkey = n_nationkey WHERE n_regionkey = r_regionkey AND c_acctbal > 9900)")
def sections_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types, here regions, that have a document, here a customer of high balance."""
    rich = table(spark, sf_dir, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("n_nationkey"))
    nations = table(spark, sf_dir, "nation").join(rich, "n_nationkey", "left_semi").select(F.col("n_regionkey").alias("r_regionkey"))
    return table(spark, sf_dir, "region").join(nations, "r_regionkey", "left_semi").select(F.col("r_name").alias("type"))


@query("SELECT doc_id FROM documents WHERE lang IN ('fr', 'en') AND source <> '' AND doc_id NOT IN (SELECT doc_id FROM labels)")
def new_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "documents").where(F.col("lang").isin("fr", "en") & (F.coalesce("source", F.lit("")) != "")).select("doc_id")
    return incremental.unseen(items, table(spark, sf_dir, "labels"), "doc_id")


@query("""
WITH old AS (SELECT s_suppkey AS id, s_name AS name FROM supplier), new AS (SELECT c_custkey AS id, c_name AS name FROM customer)
SELECT * FROM old UNION ALL SELECT * FROM new WHERE id NOT IN (SELECT id FROM old)""")
def metadata_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    old = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    new = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    return incremental.upserted(old, new, "id")


@query("SELECT '2026-08-01' AS day, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS added, (SELECT count(*) FROM labels WHERE quality = 0) AS anomalies")
def journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return incremental.journal(incremental.unseen(table(spark, sf_dir, "documents").select("doc_id"), labels, "doc_id"), labels.where("quality = 0"), "2026-08-01")


def _rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules on parts' names as pages: two replacements in order, a whole page now and then, one for a page that isn't there."""
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc"), "p_name")
    word = F.substring_index("p_name", " ", 1)
    none = F.lit(None).cast("string")
    rules = F.array(
        F.struct(F.lit(0).alias("place"), word.alias("old"), F.upper(word).alias("new"), none.alias("whole")),
        F.struct(F.lit(1).alias("place"), F.upper(word).alias("old"), F.concat(F.upper(word), F.lit("!")).alias("new"), none.alias("whole")),
        F.struct(F.lit(2).alias("place"), F.lit("#absent#").alias("old"), F.upper(word).alias("new"), none.alias("whole")),
        F.struct(F.lit(3).alias("place"), F.lit("#absent#").alias("old"), F.lit("#never#").alias("new"), none.alias("whole")),
        F.struct(F.lit(4).alias("place"), none.alias("old"), none.alias("new"), F.when(F.col("doc") % 5 == 0, F.lit("page entière")).alias("whole")),
    )
    on = part.select("doc", F.lit(1).alias("page"), F.explode(rules).alias("r")).select("doc", "page", "r.*")
    off = part.where("doc % 9 = 0").select("doc", F.lit(2).alias("page"), F.lit(0).alias("place"), F.lit("a").alias("old"), F.lit("b").alias("new"), none.alias("whole"))
    return on.unionByName(off)


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc"), F.lit(1).alias("page"), F.col("p_name").alias("text"))


_PATCH = """
WITH w AS (SELECT p_partkey AS doc, p_name AS t0, split_part(p_name, ' ', 1) AS w FROM part),
a AS (SELECT *, replace(t0, w, upper(w)) AS t1 FROM w), b AS (SELECT *, replace(t1, upper(w), upper(w) || '!') AS t2 FROM a)"""


@query(_PATCH + " SELECT doc, CASE WHEN doc % 5 = 0 THEN 'page entière' ELSE t2 END AS text, true AS patched FROM b")
def patch_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrections.outcomes(_rules(spark, sf_dir), _parts(spark, sf_dir))[0].select("doc", "text", "patched")


@query(_PATCH + " SELECT 2 * count(*) + count(*) FILTER (doc % 5 = 0) AS applied, count(*) AS already, count(*) + count(*) FILTER (doc % 9 = 0) AS missing FROM b")
def patch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corrections.outcomes(_rules(spark, sf_dir), _parts(spark, sf_dir))[1]


@query("""
SELECT 'https://example.org/' || path AS loc, priority FROM (
  SELECT regexp_replace(regexp_replace(url, '^https?://[^/]*', ''), '^/+', '') AS path, '0.9' AS priority FROM pages UNION ALL VALUES ('', '1.0'), ('search/', '0.7'), ('about/', '0.5'))""")
def sitemap_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "pages").select(F.regexp_replace("url", "^https?://[^/]*", "").alias("path"), F.lit("document").alias("class"))
    fixed = spark.createDataFrame([("", "home"), ("search/", "search"), ("about/", "about")], "path string, class string")
    return publish.sitemap(own.union(fixed), "https://example.org")


@query("SELECT p_partkey AS doc, p_name || chr(10) || repeat('=', length(p_name)) || chr(10) || chr(10) || p_type || chr(10) AS page FROM part")
def plain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.plain_page(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc"), F.col("p_name").alias("title"), F.col("p_type").alias("text")))


_SHORT = "CASE WHEN type = 'base' OR label || number = '' THEN 'court ' || doc ELSE trim(label || ' ' || number) END"
_LABELLED = """, l AS (SELECT * REPLACE (CASE WHEN doc % 13 = 0 THEN '' ELSE number END AS number), CASE WHEN doc % 3 = 0 THEN '' ELSE 'Instruction' END AS label FROM d)"""


def _acts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with labels, short titles, dates (of the act's year for even keys, none for each seventh) and addresses."""
    k = F.col("doc")
    date = F.when(k % 7 == 0, "").when(k % 2 == 0, F.concat("year", F.lit("-01-01"))).otherwise("1900-01-01")
    return _catalogue(spark, sf_dir).withColumns({
        "number": F.when(k % 13 == 0, "").otherwise(F.col("number")), "label": F.when(k % 3 == 0, "").otherwise("Instruction"), "short": F.concat(F.lit("court "), k.cast("string")), "date": date,
        "summary": F.when(k % 5 == 0, "").otherwise(F.col("title")), "slug": F.concat(F.lit("s"), k.cast("string")), "pdf": F.concat(F.lit("https://example.org/"), k.cast("string"), F.lit(".pdf")),
        "plural": F.lit("Instructions"), "folder": F.concat(F.lit("f"), "rank"),
    })


@query(_CATALOGUE + _LABELLED + f"""
SELECT doc, title AS name, {_SHORT} AS identifier, CASE WHEN doc % 7 <> 0 AND doc % 2 = 0 AND year <> '' THEN year || '-01-01' END AS legislation_date,
  CASE WHEN doc % 7 <> 0 THEN CASE WHEN doc % 2 = 0 THEN year || '-01-01' ELSE '1900-01-01' END END AS published, CASE WHEN repealed THEN 'NotInForce' ELSE 'InForce' END AS force,
  'https://example.org/textes/s' || doc || '/' AS url, 'https://example.org/' || doc || '.pdf' AS based_on, CASE WHEN doc % 5 <> 0 THEN title END AS abstract FROM l""")
def structured_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read back from the JSON: the act's date is there only if its year is the act's."""
    made = publish.structured_data(_acts(spark, sf_dir), "https://example.org/", "Union", "Autorité")
    paths = {"name": "name", "identifier": "legislationIdentifier", "legislation_date": "legislationDate", "published": "datePublished", "force": "legislationLegalForce", "url": "url", "based_on": "isBasedOn.url", "abstract": "abstract"}
    return made.select("doc", *[F.get_json_object("json", f"$.{path}").alias(name) for name, path in paths.items()])


@query(_CATALOGUE + _LABELLED + f"""
SELECT doc, '{{"@context":"https://schema.org","@type":"BreadcrumbList","itemListElement":[{{"@type":"ListItem","position":1,"name":"Accueil","item":"https://example.org/"}},{{"@type":"ListItem","position":2,"name":"Instructions","item":"https://example.org/f'
  || rank || '/"}},{{"@type":"ListItem","position":3,"name":"' || {_SHORT} || '"}}]}}' AS json FROM l""")
def breadcrumb_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.breadcrumbs(_acts(spark, sf_dir), "https://example.org")


@query("SELECT c_custkey AS doc, CASE WHEN c_custkey % 3 = 0 THEN CAST(c_custkey % 50 AS VARCHAR) || '-' || (1990 + c_custkey % 30) WHEN c_custkey % 3 = 1 THEN 'cm-' || (1990 + c_custkey % 30) ELSE 'x-' || (1990 + c_custkey % 30) END AS slug FROM customer")
def slug_cores(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    year = (F.lit(1990) + k % 30).cast("string")
    number = F.when(k % 3 == 0, (k % 50).cast("string")).otherwise("")
    reference = F.when(k % 3 == 1, "CM").otherwise(F.concat(F.lit("X/"), year))
    return table(spark, sf_dir, "customer").select(k.alias("doc"), metadata.slug_core(number, reference, year).alias("slug"))


@query()
def incremental_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents folder as a file stream, one AvailableNow run from a fresh checkpoint; a second run adds nothing (tested)."""
    own = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    schema = table(spark, sf_dir, "labels").schema
    return gained(spark, f"{sf_dir}/labels.parquet*", schema, f"{own}/checkpoint", f"{own}/out")


@query("""
SELECT p_partkey, array_to_string(list_sort(list_distinct(list_concat(range(a, a + b + 1), [a + 100]))), ',') AS pages
FROM (SELECT p_partkey, CAST(p_partkey % 17 AS INTEGER) AS a, CAST(p_partkey % 4 AS INTEGER) AS b FROM part)""")
def page_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = F.col("p_partkey") % 17, F.col("p_partkey") % 4
    spec = F.concat(a.cast("string"), F.lit("-"), (a + b).cast("string"), F.lit(","), (a + 100).cast("string"))
    bounds = F.transform(F.split(spec, ","), lambda x: F.transform(F.split(x, "-"), lambda y: y.try_cast("int")))
    pages = F.flatten(F.transform(bounds, lambda x: F.sequence(F.get(x, 0), F.element_at(x, -1))))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.array_sort(F.array_distinct(pages)), ",").alias("pages"))
