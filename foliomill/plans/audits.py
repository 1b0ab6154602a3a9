"""Queries of numbering audits, confidence, recognition lines and site checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import cleaning, quality
from .registry import SQL, query, table

_SERIES = """
WITH n AS (SELECT l_orderkey AS doc, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity) AS place, l_linenumber AS n FROM lineitem),
f AS (SELECT *, CASE WHEN n < lag(n) OVER (PARTITION BY doc ORDER BY place) THEN 1 ELSE 0 END AS falls FROM n),
s AS (SELECT doc, place, n, CAST(1 + sum(falls) OVER (PARTITION BY doc ORDER BY place) AS INTEGER) AS series FROM f)"""


def _numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order is a document, its line numbers in order of parts the numbers of its articles."""
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_linenumber", "l_quantity"))
    own = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), place.alias("place"), F.col("l_linenumber").alias("n"))
    return quality.series(own)


@query(_SERIES + " SELECT doc, max(series) AS series FROM s GROUP BY doc")
def article_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(spark, sf_dir).groupBy("doc").agg(F.max("series").alias("series"))


@query(_SERIES + """
, r AS (SELECT doc, series, unnest(range(min(n), max(n) + 1)) AS n FROM s GROUP BY doc, series)
SELECT doc, series, CAST(n AS INTEGER) AS n FROM r WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.doc = r.doc AND s.series = r.series AND s.n = r.n)""")
def article_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.missing(_numbered(spark, sf_dir))


@query("""
WITH t AS (SELECT l_orderkey AS doc, CAST(4 * l_linenumber - 2 AS INTEGER) AS n FROM lineitem WHERE 4 * l_linenumber - 2 <= 20)
SELECT doc, n FROM (SELECT doc, CAST(unnest(range(1, max(n) + 1)) AS INTEGER) AS n FROM t GROUP BY doc HAVING count(*) >= 2) r WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.doc = r.doc AND t.n = r.n)""")
def missing_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers of an order as its titles 2, 6, 10 and so on: 1 is missing, and from 22 on they are misread."""
    return quality.missing_titles(table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("doc"), (4 * F.col("l_linenumber") - 2).cast("int").alias("n")))


@query(_SERIES + " SELECT DISTINCT doc, n FROM (SELECT doc, series, n FROM s GROUP BY ALL HAVING count(*) > 1)")
def article_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicates(_numbered(spark, sf_dir))


_KINDS = """
WITH b AS (SELECT o_custkey AS doc, o_orderkey AS place, CAST(o_orderkey % 9 AS INTEGER) AS page, CASE o_orderpriority WHEN '1-URGENT' THEN 'article' WHEN '2-HIGH' THEN 'titre' ELSE 'paragraphe' END AS kind FROM orders),
bodiless AS (SELECT doc, place FROM (SELECT *, lead(kind) OVER (PARTITION BY doc ORDER BY place) AS after FROM b) WHERE kind = 'article' AND (after IS NULL OR after IN ('titre', 'section', 'article'))),
every AS (SELECT c_custkey AS doc, unnest(range(1, 9)) AS page FROM customer),
empty AS (SELECT doc, CAST(page AS INTEGER) AS page FROM every WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.doc = every.doc AND b.page = every.page))"""


def _kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "article").when(F.col("o_orderpriority") == "2-HIGH", "titre").otherwise("paragraphe")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("place"), (F.col("o_orderkey") % 9).cast("int").alias("page"), kind.alias("kind"))


def _customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc"), F.lit(8).alias("pages"))


@query(_KINDS + " SELECT doc, place FROM bodiless")
def article_bodiless(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.bodiless(_kinds(spark, sf_dir))


@query(_KINDS + " SELECT doc, page FROM empty")
def empty_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.empty_pages(_customers(spark, sf_dir), _kinds(spark, sf_dir))


@query(_KINDS + """
SELECT c_custkey AS doc, coalesce(x.n, 0) AS bodiless, coalesce(y.n, 0) AS empty_pages, CAST(2 * coalesce(x.n, 0) + coalesce(y.n, 0) AS BIGINT) AS severity
FROM customer LEFT JOIN (SELECT doc, count(*) AS n FROM bodiless GROUP BY doc) x ON x.doc = c_custkey LEFT JOIN (SELECT doc, count(*) AS n FROM empty GROUP BY doc) y ON y.doc = c_custkey""")
def severity_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, blocks = _customers(spark, sf_dir), _kinds(spark, sf_dir)
    return quality.severity(docs, {"bodiless": (quality.bodiless(blocks), 2), "empty_pages": (quality.empty_pages(docs, blocks), 1)})


def _recognised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user is a document, an event a page: its value is a confidence."""
    mode = F.when((F.col("user_id") % 3 == 0) | ((F.col("user_id") % 3 == 1) & (F.col("event_id") % 2 == 0)), "ocr").otherwise("natif")
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("doc"), F.col("event_id").alias("page"), mode.alias("mode"), F.least(F.round("value"), F.lit(100.0)).alias("confidence"), F.length("props").cast("long").alias("chars"))


_PAGES = """
WITH p AS (SELECT user_id AS doc, event_id AS page, CASE WHEN user_id % 3 = 0 OR (user_id % 3 = 1 AND event_id % 2 = 0) THEN 'ocr' ELSE 'natif' END AS mode, least(round(value), 100.0) AS confidence, length(props) AS chars FROM events),
r AS (SELECT doc, CASE WHEN count(*) FILTER (mode = 'ocr') = 0 THEN 'natif' WHEN count(*) FILTER (mode <> 'ocr') = 0 THEN 'ocr' ELSE 'mixte' END AS mode,
  coalesce(round_even(avg(confidence) FILTER (mode = 'ocr'), 2), 100.0) AS confidence, CAST(sum(chars) AS BIGINT) AS chars, count(*) FILTER (mode = 'ocr' AND confidence < 78) AS weak FROM p GROUP BY doc)"""


@query(_PAGES + " SELECT * FROM r")
def confidence_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rollup(_recognised(spark, sf_dir))


@query(_PAGES + " SELECT doc, page FROM p WHERE mode = 'ocr' AND confidence < 78")
def weak_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recognised(spark, sf_dir).where("mode = 'ocr' and confidence < 78").select("doc", "page")


@query(_PAGES + " SELECT mode, count(*) AS n FROM r GROUP BY mode")
def doc_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rollup(_recognised(spark, sf_dir)).groupBy("mode").agg(F.count(F.lit(1)).alias("n"))


@query(_PAGES + " SELECT count(*) AS documents, round_even(avg(confidence), 1) AS confidence, CAST(sum(weak) AS BIGINT) AS weak FROM r WHERE mode <> 'natif'")
def about_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = quality.rollup(_recognised(spark, sf_dir)).where("mode <> 'natif'")
    return own.agg(F.count(F.lit(1)).alias("documents"), F.bround(F.avg("confidence"), 1).alias("confidence"), F.sum("weak").alias("weak"))


def _words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recognised words: a document is a page, a line a line, its length mod 100 the confidence."""
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page"), F.posexplode(F.split("text", "\n", -1)).alias("line", "l"))
    each = lines.select("page", (F.col("line") % 2).alias("block"), F.lit(0).alias("par"), "line", (F.length("l") % 100).cast("double").alias("conf"), F.posexplode(F.split("l", " ", -1)).alias("word_no", "word"))
    return each.where("word <> ''")


_WORDS = """
WITH l AS (SELECT page, generate_subscripts(l, 1) - 1 AS line, unnest(l) AS l FROM (SELECT doc_id AS page, string_split(text, chr(10)) AS l FROM documents)),
w AS (SELECT page, line, line % 2 AS block, CAST(length(l) % 100 AS DOUBLE) AS confidence, list_filter(string_split(l, ' '), lambda x: x <> '') AS w FROM l),
k AS (SELECT *, len(w) >= 4 AND len(list_filter(w, lambda x: length(regexp_replace(x, '[^A-Za-zÀ-ÿ]', '', 'g')) >= 4)) = 0 AS noise FROM w WHERE len(w) > 0)"""


@query(_WORDS + " SELECT page, CAST(line AS INTEGER) AS line FROM k WHERE noise")
def noise_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = _words(spark, sf_dir).groupBy("page", "line").agg(F.collect_list("word").alias("w"))
    return words.where(cleaning.noise(F.col("w"))).select("page", "line")


@query(_WORDS + """
SELECT page, CAST(line AS INTEGER) AS line, array_to_string(w, ' ') AS text, confidence, coalesce(block <> lag(block) OVER (PARTITION BY page ORDER BY block, line), false) AS new_paragraph
FROM k WHERE NOT (noise AND confidence < 75)""")
def tsv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.recognised_lines(_words(spark, sf_dir)).select("page", "line", "text", "confidence", "new_paragraph")


def _site(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("page"), "url", "html")


_BODY = "(?is)<body[^>]*>(.*)</body>"


@query(rf"""
WITH c AS (SELECT page_id AS page, page_id % 2 = 0 AS is_text, html,
  trim(regexp_replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '<[^>]+>', '', 'g')) AS title,
  trim(regexp_extract(html, '<meta name="description" content="([^"]*)"', 1)) AS description,
  len(regexp_extract_all(html, '(?s)<h1[^>]*>.*?</h1>')) AS heads,
  length(regexp_replace(regexp_replace(regexp_extract(html, '{_BODY}', 1), '<[^>]+>', ' ', 'g'), '^\s+|\s+$', '', 'g')) AS body FROM (SELECT page_id, {{html}} AS html FROM pages))
SELECT page, level, rule FROM (
  SELECT page, 'error' AS level, 'no title' AS rule FROM c WHERE NOT regexp_matches(html, '(?s)<title>.*?</title>')
  UNION ALL SELECT page, 'error', 'empty title' FROM c WHERE title = '' AND regexp_matches(html, '(?s)<title>.*?</title>')
  UNION ALL SELECT page, 'warning', 'long title' FROM c WHERE length(title) > 130
  UNION ALL SELECT page, 'error', 'no description' FROM c WHERE NOT regexp_matches(html, '<meta name="description" content="[^"]*"')
  UNION ALL SELECT page, 'error', 'empty description' FROM c WHERE description = '' AND regexp_matches(html, '<meta name="description" content="[^"]*"')
  UNION ALL SELECT page, 'error', 'no canonical link' FROM c WHERE NOT regexp_matches(html, '<link rel="canonical" href="[^"]+"')
  UNION ALL SELECT page, 'error', 'no h1' FROM c WHERE heads = 0 UNION ALL SELECT page, 'warning', 'several h1' FROM c WHERE heads > 1
  UNION ALL SELECT page, 'error', 'no body' FROM c WHERE is_text AND NOT regexp_matches(html, '{_BODY}')
  UNION ALL SELECT page, 'error', 'short body' FROM c WHERE is_text AND body < 200)""".replace("{html}", "CASE page_id % 7 WHEN 0 THEN replace(html, '<h1>', '<h1></h1><h1>') WHEN 1 THEN replace(replace(html, '<title>', '<title> <b></b> </title><title>'), '</head>', '<meta name=\"description\" content=\" \"></head>') WHEN 2 THEN replace(replace(html, '<body', '<frame'), '</head>', '<link rel=\"canonical\" href=\"/x\"></head>') WHEN 3 THEN replace(html, '<h1>', '<p>') WHEN 4 THEN substr(html, 1, 400) || '<body>' || substr(html, 1, 250) || '</body>' ELSE html END"))
def html_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages, those of even keys as texts; some are made faulty: second or no headings, empty parts, no or a short body."""
    k, html = F.col("page") % 7, F.col("html")
    made = (
        F.when(k == 0, F.replace(html, F.lit("<h1>"), F.lit("<h1></h1><h1>")))
        .when(k == 1, F.replace(F.replace(html, F.lit("<title>"), F.lit("<title> <b></b> </title><title>")), F.lit("</head>"), F.lit('<meta name="description" content=" "></head>')))
        .when(k == 2, F.replace(F.replace(html, F.lit("<body"), F.lit("<frame")), F.lit("</head>"), F.lit('<link rel="canonical" href="/x"></head>')))
        .when(k == 3, F.replace(html, F.lit("<h1>"), F.lit("<p>")))
        .when(k == 4, F.concat(F.substring(html, 1, 400), F.lit("<body>"), F.substring(html, 1, 250), F.lit("</body>")))
        .otherwise(html)
    )
    return quality.page_findings(_site(spark, sf_dir).withColumn("html", made).withColumn("is_text", F.col("page") % 2 == 0), _BODY)


_LINKS = r"""
WITH l AS (SELECT page_id AS page, unnest(regexp_extract_all(html, '(?i)(?:href|src)="([^"]*)"', 1)) AS link FROM pages),
k AS (SELECT *, regexp_replace(link, '[?#].*$', '') AS path, CASE WHEN regexp_matches(link, '(?i)^(https?:|mailto:|data:|#)') THEN 'external' WHEN regexp_replace(link, '[?#].*$', '') = '' THEN 'empty' WHEN lower(regexp_replace(link, '[?#].*$', '')) LIKE '%.pdf' THEN 'pdf' ELSE 'internal' END AS kind FROM l)"""


@query(_LINKS + " SELECT kind, count(*) AS n FROM k GROUP BY kind")
def link_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.links(_site(spark, sf_dir)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query(_LINKS + r"""
, t AS (SELECT DISTINCT CASE WHEN p LIKE '%/' OR p = '' THEN p || 'index.html' ELSE p END AS path FROM (SELECT regexp_replace(regexp_replace(url, '^https?://[^/]*/?', ''), '[?#].*$', '') AS p FROM pages)),
r AS (SELECT page, link, kind, CASE WHEN path LIKE '/%' THEN url_decode(replace(path, '+', '%2B')) ELSE 'a/b/' || url_decode(replace(path, '+', '%2B')) END AS p FROM (
  SELECT page, link, kind, CASE page % 3 WHEN 0 THEN '.' || path WHEN 1 THEN '..' || path ELSE path END AS path FROM k WHERE kind IN ('internal', 'pdf'))),
s AS (SELECT *, regexp_replace(regexp_replace(replace(replace(replace(p, 'a/b/../', 'a/'), 'a/b/./', 'a/b/'), '//', '/'), '^/', ''), '/$', '/index.html') AS path FROM r)
SELECT page, link, kind, CASE kind WHEN 'pdf' THEN 'warning' ELSE 'error' END AS level FROM s WHERE path NOT IN (SELECT path FROM t)""")
def dead_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages in folder a/b; a third with ./ and a third with ../ in front."""
    own = _site(spark, sf_dir)
    path = F.regexp_replace(F.regexp_replace("url", "^https?://[^/]*/?", ""), "[?#].*$", "")
    targets = own.select(F.when(path.endswith("/") | (path == ""), F.concat(path, F.lit("index.html"))).otherwise(path).alias("path"))
    dots = F.element_at(F.array(F.lit("."), F.lit(".."), F.lit("")), (F.col("page") % 3 + 1).cast("int"))
    found = quality.links(own).withColumn("path", F.when(F.col("kind").isin("internal", "pdf"), F.concat(dots, "path")).otherwise(F.col("path")))
    return quality.dead(found.withColumn("folder", F.lit("a/b")), targets).select("page", "link", "kind", "level")


_CANON = "regexp_extract(url, '^([A-Za-z]+://[^/]*)', 1)"


@query(f"SELECT lower({_CANON}) || substr(url, length({_CANON}) + 1) AS canonical, count(*) AS n FROM (SELECT regexp_replace(url, '[0-9]+', '#', 'g') AS url FROM pages) GROUP BY ALL HAVING count(*) > 1")
def canonical_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses with their numbers masked, so that some coincide; only scheme and host are lowered."""
    own = _site(spark, sf_dir).select(F.regexp_replace("url", "[0-9]+", "#").alias("url"))
    host = F.regexp_extract("url", "^([A-Za-z]+://[^/]*)", 1)
    canonical = F.concat(F.lower(host), F.substring(F.col("url"), F.length(host) + 1, F.length("url")))
    return own.groupBy(canonical.alias("canonical")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("SELECT event_id, json_valid(props) AS valid, CASE WHEN json_valid(props) THEN json_extract_string(props, '$.k') END AS k FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN substr(props, 1, length(props) - 1) ELSE props END AS props FROM events)")
def jsonld_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects that parse, and a member of them; each tenth is cut off."""
    own = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 10 == 0, F.expr("substr(props, 1, length(props) - 1)")).otherwise(F.col("props")).alias("props"))
    valid = F.expr("try_parse_json(props)").isNotNull()
    return own.select("event_id", F.coalesce(valid, F.lit(False)).alias("valid"), F.when(valid, F.get_json_object("props", "$.k")).alias("k"))


@query(_SERIES + """,
missing AS (SELECT doc, count(*) AS n FROM (SELECT doc, series, unnest(range(min(n), max(n) + 1)) AS n FROM s GROUP BY doc, series) r WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.doc = r.doc AND s.series = r.series AND s.n = r.n) GROUP BY doc),
twice AS (SELECT doc, count(*) AS n FROM (SELECT DISTINCT doc, n FROM (SELECT doc, series, n FROM s GROUP BY ALL HAVING count(*) > 1)) GROUP BY doc),
titles AS (SELECT doc, count(*) AS n FROM (SELECT doc, unnest(range(1, max(n) + 1)) AS n FROM s WHERE n NOT IN (1, 3) GROUP BY doc HAVING count(*) >= 2) r WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.doc = r.doc AND s.n = r.n AND s.n NOT IN (1, 3)) GROUP BY doc),
body AS (SELECT doc, count(*) AS n FROM s WHERE n = 7 GROUP BY doc), page AS (SELECT doc, count(*) AS n FROM s WHERE n = 6 GROUP BY doc),
rated AS (SELECT o_orderkey AS doc, coalesce(missing.n, 0) AS missing, coalesce(body.n, 0) AS bodiless, coalesce(titles.n, 0) AS missing_titles, coalesce(twice.n, 0) AS duplicates, coalesce(page.n, 0) AS empty_pages
  FROM orders LEFT JOIN missing ON missing.doc = o_orderkey LEFT JOIN body ON body.doc = o_orderkey LEFT JOIN titles ON titles.doc = o_orderkey LEFT JOIN twice ON twice.doc = o_orderkey LEFT JOIN page ON page.doc = o_orderkey),
sev AS (SELECT *, CAST(3 * missing + 2 * bodiless + 2 * missing_titles + duplicates + empty_pages AS BIGINT) AS severity FROM rated)
SELECT * FROM sev""")
def coherence_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five parts of each order's severity: its line numbers as articles; those but 1 and 3 as titles, 7 as articles without a body, 6 as empty pages."""
    return quality.severities(*_coherence(spark, sf_dir))


def _coherence(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, DataFrame]]:
    own = _numbered(spark, sf_dir)
    titles = own.where("n not in (1, 3)").select("doc", "n")
    parts = {"missing": quality.missing(own), "bodiless": own.where("n = 7"), "missing_titles": quality.missing_titles(titles), "duplicates": quality.duplicates(own), "empty_pages": own.where("n = 6")}
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc")), parts


@query(SQL["coherence_severity"].replace("SELECT * FROM sev", "SELECT doc, severity FROM sev WHERE severity > 0 ORDER BY severity DESC, doc LIMIT 20"))
def coherence_worst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.worst(quality.severities(*_coherence(spark, sf_dir)).select("doc", "severity"))


@query(SQL["coherence_severity"].replace("SELECT * FROM sev", "SELECT count(*) AS documents, count(*) FILTER (severity > 0) AS affected, count(*) FILTER (severity = 0) AS sound, (SELECT CAST(sum(l_linenumber) AS BIGINT) FROM lineitem) AS residues FROM sev"))
def coherence_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    residues = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("residues"))
    return quality.totals(quality.severities(*_coherence(spark, sf_dir)), residues)


@query("""
WITH b AS (SELECT o_orderkey AS page, unnest(CASE o_orderkey % 5 WHEN 0 THEN ['{"@context": "x", "@type": "y"}'] WHEN 1 THEN ['{"@context": "x"}', '{"@type": 1, "@context": null}'] WHEN 2 THEN ['{"@type": "y", ', '{}'] WHEN 3 THEN ['[1]'] ELSE [] END) AS block,
  unnest(CASE o_orderkey % 5 WHEN 0 THEN [0] WHEN 1 THEN [0, 1] WHEN 2 THEN [0, 1] WHEN 3 THEN [0] ELSE [] END) AS place FROM orders)
SELECT page, place, CASE WHEN NOT json_valid(block) THEN 'invalid' ELSE 'no context or type' END AS rule FROM b WHERE NOT json_valid(block) OR NOT coalesce(list_contains(json_keys(block), '@context') AND list_contains(json_keys(block), '@type'), false)""")
def linked_data_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages made of orders, with blocks that are sound, lack members or are no JSON."""
    some = [['{"@context": "x", "@type": "y"}'], ['{"@context": "x"}', '{"@type": 1, "@context": null}'], ['{"@type": "y", ', "{}"], ["[1]"], []]
    html = F.element_at(F.array(*[F.lit("".join(f'<script type="application/ld+json">{b}</script>' for b in x)) for x in some]), (F.col("o_orderkey") % 5 + 1).cast("int"))
    return quality.linked_data_findings(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page"), html.alias("html")))


@query("SELECT lower(url) AS url, count(*) AS n FROM (SELECT regexp_replace(url, '[0-9].*$', '') AS url FROM pages) GROUP BY ALL HAVING count(*) > 1")
def repeated_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses cut at their first digit, as entries of a sitemap."""
    return quality.repeated(_site(spark, sf_dir).select(F.lower(F.regexp_replace("url", "[0-9].*$", "")).alias("url")))
