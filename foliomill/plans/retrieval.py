"""Queries over the inverted index and passages, on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import index, passages, search
from ..sources.store import stored
from .registry import query, table
from .sqltext import QUESTION, STOP, tokens

#: A batch of queries: common words, a rare one with a prefix, one repeated word, one that nothing matches.
ASKED = [(1, "Which reading of the station and thing"), (2, "ciónosra mente ción"), (3, "erstes zu gehen heit"), (4, "ouvre éauxque mention"), (5, "station station qqqzzz"), (6, "zzzzqq")]


def asked(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ASKED, "query int, text string")


def indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as index input: source is the title, lang tag and type, doc_id the number, the first 180 characters the abstract; toxic labels repeal."""
    toxic = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id").distinct().withColumn("hit", F.lit(True))
    own = table(spark, sf_dir, "documents").join(toxic, "doc_id", "left")
    return own.select(
        F.col("doc_id").alias("doc"), F.col("source").alias("title"), F.col("doc_id").cast("string").alias("number"), F.col("lang").alias("tags"), F.substring("text", 1, 180).alias("abstract"),
        F.col("text").alias("body"), F.col("lang").alias("type"), F.coalesce("hit", F.lit(False)).alias("repealed"),
    )


TYPES = {"fr": 1.35, "en": 1.2, "de": 0.75}
_WEIGHT = "CASE type WHEN 'fr' THEN 1.35::DOUBLE WHEN 'en' THEN 1.2::DOUBLE WHEN 'de' THEN 0.75::DOUBLE ELSE 1.0::DOUBLE END"
_ASKED = ", ".join(f"({q}, '{t}')" for q, t in ASKED)
#: field, weight, stop words dropped, then capped postings.
_INDEX = f"""
WITH own AS (
  SELECT d.doc_id AS doc, source AS title, CAST(d.doc_id AS VARCHAR) AS number, lang AS tags, substr(text, 1, 180) AS abstract, text AS body, lang AS type,
         d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS repealed FROM documents d),
field AS (
  SELECT doc, 6 AS weight, {tokens('title')} AS t FROM own UNION ALL SELECT doc, 6, {tokens('number')} FROM own UNION ALL SELECT doc, 4, {tokens('tags')} FROM own
  UNION ALL SELECT doc, 3, {tokens('abstract')} FROM own UNION ALL SELECT doc, 1, {tokens('body')} FROM own),
token AS (SELECT * FROM (SELECT doc, weight, unnest(t) AS term FROM field) WHERE term NOT IN ({STOP})),
size AS (SELECT doc, count(token.term) AS length FROM own LEFT JOIN token USING (doc) GROUP BY doc),
stats AS (SELECT count(*) AS n, round_even(avg(length), 0) AS average FROM size),
tf AS (SELECT term, doc, CAST(sum(weight) AS BIGINT) AS tf FROM token GROUP BY term, doc),
posting AS (
  SELECT term, doc, least(tf, 255) AS tf FROM (
    SELECT *, row_number() OVER (PARTITION BY term ORDER BY tf DESC, doc) AS r, count(*) OVER (PARTITION BY term) AS df FROM tf)
  WHERE r <= 400 AND NOT (length(term) <= 4 AND df > (SELECT n FROM stats) * 0.75))"""
_WORDS = f""",
asked(query, text) AS (VALUES {_ASKED}),
word AS (SELECT query, generate_subscripts(w, 1) AS place, unnest(w) AS word FROM (SELECT query, {tokens('text')} AS w FROM asked)),"""
_EXPANDED = """
voc AS (SELECT DISTINCT term FROM posting),
exact AS (SELECT query, place, word, term FROM word JOIN voc ON term = word),
prefix AS (
  SELECT query, place, word, term FROM (
    SELECT *, row_number() OVER (PARTITION BY query, place ORDER BY CASE WHEN regexp_full_match(term, '0|[1-9][0-9]{0,8}') THEN CAST(term AS BIGINT) END NULLS LAST, term) AS r
    FROM word JOIN voc ON starts_with(term, word) WHERE length(word) >= 4 AND word NOT IN (SELECT term FROM voc)) WHERE r <= 24),
term AS (SELECT * FROM exact UNION ALL SELECT * FROM prefix)"""
_TERMS = _WORDS + _EXPANDED
_SCORES = """,
df AS (SELECT term, count(*) AS df FROM posting GROUP BY term),
useful AS (SELECT query, count(DISTINCT place) AS useful FROM term GROUP BY query),
raw AS (
  SELECT query, doc, sum(ln(1 + n / df.df) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.4::DOUBLE + 0.6::DOUBLE * greatest(length, 1) / average))) AS raw, count(*) AS matched
  FROM term JOIN posting USING (term) JOIN df USING (term) JOIN size USING (doc), stats GROUP BY query, doc)"""


def _top(score: str, most: int, where: str = "") -> str:
    return f"""
SELECT query, doc, score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT query, doc, score, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS rank FROM (
    SELECT query, doc, round({score}, 6) AS score FROM raw JOIN useful USING (query) JOIN own USING (doc) {where})) WHERE rank <= {most}"""


_COVER = "raw * (0.35::DOUBLE + 0.65::DOUBLE * least(matched, useful) / useful)"


_WRITTEN: dict[tuple[str, str, str], tuple[DataFrame, DataFrame, DataFrame, DataFrame]] = {}
_WHOLE: dict[tuple[str, str, str], tuple[DataFrame, DataFrame, DataFrame]] = {}


def _listing(spark: SparkSession, sf_dir: str) -> str:
    """What the input's files are: their paths, sizes and times, as one figure; no column is read."""
    names = [table(spark, sf_dir, name).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct() for name in ("documents", "labels")]
    one = names[0].unionByName(names[1]).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("file_path", "file_size", "file_modification_time")).alias("h"))
    return str(tuple(one.collect()[0]))  # one row


def shared_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Indexed documents, postings, statistics and the terms asked for: written once in a session for each state of the input's files, read by every search."""
    key = (spark.sparkContext.applicationId, sf_dir, _listing(spark, sf_dir))
    if key not in _WRITTEN:
        docs, postings, stats = index.write(indexed(spark, sf_dir))
        terms = stored(search.expanded(search.query_terms(asked(spark)), postings.select("term").distinct()), "terms")
        _WRITTEN[key] = (docs, postings, stats, terms)
    return _WRITTEN[key]


def whole_index(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Indexed documents, postings and statistics, as ``shared_index``; posting lists keep all their documents."""
    key = (spark.sparkContext.applicationId, sf_dir, _listing(spark, sf_dir))
    if key not in _WHOLE:
        _WHOLE[key] = index.write(indexed(spark, sf_dir), whole=True)
    return _WHOLE[key]


def _scored(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs, postings, stats, terms = shared_index(spark, sf_dir)
    return search.scores(terms, docs, postings, stats), docs


@query(_INDEX + _TERMS + _SCORES + _top("raw", 10))
def bm25_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, docs = _scored(spark, sf_dir)
    return search.top(search.ranked(found, docs.select("doc", "length"), coverage=False), 10).select("query", "doc", "score", "rank")


@query(_INDEX + _TERMS + _SCORES + _top(_COVER, 60))
def bm25_coverage_boost(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, docs = _scored(spark, sf_dir)
    return search.top(search.ranked(found, docs.select("doc", "length"))).select("query", "doc", "score", "rank")


@query(_INDEX + _TERMS + _SCORES + _top(f"{_COVER} * {_WEIGHT}", 60, "WHERE type = 'fr'"))
def bm25_type_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, docs = _scored(spark, sf_dir)
    rated = search.ranked(found, docs.drop("repealed"), types=TYPES).where("type = 'fr'")
    return search.top(rated).select("query", "doc", "score", "rank")


@query(_INDEX + _TERMS + _SCORES + _top(f"{_COVER} * {_WEIGHT} * CASE WHEN repealed THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END", 60))
def bm25_repealed_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, docs = _scored(spark, sf_dir)
    return search.top(search.ranked(found, docs, types=TYPES)).select("query", "doc", "score", "rank")


@query(_INDEX + _TERMS + " SELECT query, CAST(place - 1 AS INTEGER) AS place, word, term FROM term")
def prefix_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    postings = shared_index(spark, sf_dir)[1]
    return search.expanded(search.query_terms(asked(spark)), postings.select("term").distinct())


@query(_INDEX + " SELECT term, doc, tf FROM posting")
def postings_capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.build(indexed(spark, sf_dir))[1]


@query(_INDEX + " SELECT term, doc, tf FROM tf")
def field_weighted_tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.term_frequencies(index.field_tokens(indexed(spark, sf_dir)))


@query(_INDEX + " SELECT doc, length FROM size")
def doc_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = indexed(spark, sf_dir)
    return index.lengths(own, index.field_tokens(own))


@query(_INDEX + " SELECT n, average FROM stats")
def doc_length_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.build(indexed(spark, sf_dir))[2]


@query(f"""
WITH t AS (SELECT DISTINCT lang, doc_id, unnest({tokens('text')}) AS term FROM documents WHERE lang IN ('en', 'fr')),
df AS (SELECT lang, term, count(*) AS df FROM t GROUP BY ALL), n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang)
SELECT lang, term, df FROM df JOIN n USING (lang) WHERE length(term) <= 4 AND df > n * 0.75""")
def high_df_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms that the index drops if English or French texts are a corpus of their own."""
    found = []
    for lang in ("en", "fr"):
        docs = table(spark, sf_dir, "documents").where(F.col("lang") == lang).select(F.col("doc_id").alias("doc"), F.col("text").alias("body"))
        tf = index.term_frequencies(index.field_tokens(docs, stop=[]))
        lost = tf.join(index.pruned(tf, docs.agg(F.count(F.lit(1)).alias("n"))), ["term", "doc"], "left_anti")
        found.append(lost.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(F.lit(lang).alias("lang"), "term", "df"))
    return found[0].unionByName(found[1])


@query(f"""
WITH t AS (SELECT conv_id, turn, {tokens('text')} AS w FROM conversations WHERE role = 'user'),
f AS (SELECT *, list_filter(w, lambda x: x NOT IN ({QUESTION})) AS strict, list_filter(w, lambda x: x NOT IN ({STOP})) AS loose FROM t)
SELECT conv_id, turn, array_to_string(CASE WHEN len(strict) > 0 THEN strict ELSE loose END, ' ') AS terms FROM f""")
def query_terms_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").where("role = 'user'")
    return own.select("conv_id", "turn", F.array_join(T.bearing(T.tokens(F.col("text"))), " ").alias("terms"))


@query(f"""
WITH u AS (SELECT conv_id, turn, {tokens('text')} AS w FROM conversations WHERE role = 'user'),
p AS (SELECT *, lag(w) OVER (PARTITION BY conv_id ORDER BY turn) AS before, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM u)
SELECT conv_id, turn, CAST(len(w) AS INTEGER) AS own_terms, CAST(len(list_distinct(list_concat(w, CASE WHEN len(w) <= 12 THEN coalesce(before, []) ELSE [] END))) AS INTEGER) AS all_terms FROM p WHERE back <= 14""")
def context_carry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A short turn inherits the terms of the turn before; the transcript keeps its last 14 turns."""
    own = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", T.tokens(F.col("text")).alias("w"))
    return passages.carried(own, short=12).select("conv_id", "turn", F.size("w").alias("own_terms"), F.size("terms").alias("all_terms"))


#: Passages are the lines of documents; heads are lines of three words or fewer.
_SEGMENTS = f"""
WITH line AS (SELECT doc_id, generate_subscripts(l, 1) AS i, unnest(l) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
seg AS (SELECT doc_id, i, line, {tokens('line')} AS t, lower(strip_accents(line)) AS norm FROM line WHERE len({tokens('line')}) > 0),
asked(query, text) AS (VALUES {_ASKED}),
word AS (SELECT DISTINCT query, unnest({tokens('text')}) AS word FROM asked),
words AS (SELECT query, count(*) AS k FROM word GROUP BY query),
tok AS (SELECT doc_id, i, unnest(t) AS term FROM seg),
cnt AS (SELECT doc_id, i, term, count(*) AS c FROM tok GROUP BY ALL),
met AS (
  SELECT query, doc_id, i, word, coalesce(sum(c) FILTER (term = word), 0) AS exact, coalesce(sum(c) FILTER (term <> word), 0) AS more
  FROM word JOIN cnt ON term = word OR (length(word) >= 4 AND starts_with(term, word)) GROUP BY ALL),
tf AS (SELECT *, CASE WHEN exact > 0 THEN exact::DOUBLE ELSE more * 0.85::DOUBLE END AS tf FROM met),
score AS (
  SELECT query, doc_id, i, count(*) AS found, sum(2.5::DOUBLE * tf * 2.4::DOUBLE / (tf + 1.4::DOUBLE * (0.6::DOUBLE + 0.4::DOUBLE * len(t) / 120))) AS raw
  FROM tf JOIN seg USING (doc_id, i) GROUP BY ALL),
passage AS (
  SELECT query, doc_id, CAST(i - 1 AS INTEGER) AS segment, round(raw * pow(0.3::DOUBLE + 0.7::DOUBLE * found / k, 1.4), 6) AS score, round(found / k, 6) AS coverage
  FROM score JOIN words USING (query))"""


def lines(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("segment", "text"))


def _passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.scored(lines(table(spark, sf_dir, "documents")), asked(spark), keys=["doc_id", "segment"])


@query(_SEGMENTS + " SELECT query, doc_id, segment, score, coverage FROM passage")
def passage_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _passages(spark, sf_dir)


_QUESTIONS = [(1, "that the"), (2, " Attion to "), (3, "station"), (4, "the that mention")]


@query(_SEGMENTS.replace(_ASKED, ", ".join(f"({q}, '{x}')" for q, x in _QUESTIONS)) + """,
headed AS (
  SELECT query, doc_id, i, count(*) AS found,
    sum(2.5::DOUBLE * tf * 2.4::DOUBLE / (tf + 1.4::DOUBLE * (0.6::DOUBLE + 0.4::DOUBLE * len(t) / 120)) * CASE WHEN contains(lower(strip_accents(substr(line, 1, 20))), word) THEN 1.9::DOUBLE ELSE 1.0::DOUBLE END) AS raw
  FROM tf JOIN seg USING (doc_id, i) GROUP BY ALL)
SELECT query, doc_id, CAST(i - 1 AS INTEGER) AS segment,
  round(raw * pow(0.3::DOUBLE + 0.7::DOUBLE * found / k, 1.4) * CASE WHEN k >= 2 AND contains(norm, lower(trim(text))) THEN 1.4::DOUBLE ELSE 1.0::DOUBLE END * CASE WHEN i % 3 = 1 THEN 1.12::DOUBLE ELSE 1.0::DOUBLE END, 6) AS score,
  round(found / k, 6) AS coverage
FROM headed JOIN words USING (query) JOIN asked USING (query) JOIN seg USING (doc_id, i)""")
def passage_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as passages; their first 20 characters as headings, every third as an article."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("segment", "text"))
    own = lines.select("*", F.substring("text", 1, 20).alias("head"), (F.col("segment") % 3 == 0).alias("article"))
    return passages.scored(own, spark.createDataFrame(_QUESTIONS, "query int, text string"), keys=["doc_id", "segment"], factors=True)


_DIVERSE = """,
two AS (SELECT *, row_number() OVER (PARTITION BY query, doc_id ORDER BY score DESC, segment) AS r FROM passage),
three AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id, segment) AS rank FROM two WHERE r <= 2)"""


@query(_SEGMENTS + _DIVERSE + " SELECT query, doc_id, segment, score, coverage, CAST(rank AS INTEGER) AS rank FROM three WHERE rank <= 3")
def passage_diversified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.diversified(_passages(spark, sf_dir))


@query(_SEGMENTS + _DIVERSE + """
SELECT query, coalesce(coverage >= CASE WHEN coalesce(k, 0) >= 3 THEN 0.45 ELSE 0.9 END AND score >= 1.1, false) AS answered
FROM asked LEFT JOIN words USING (query) LEFT JOIN (SELECT * FROM three WHERE rank = 1) USING (query)""")
def answer_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.answered(passages.diversified(_passages(spark, sf_dir)), asked(spark))


_INTENT = [("greeting", "^(bonjour|bonsoir|salut|hello|coucou)"), ("thanks", "^(merci|parfait|super)"), ("statistics", "combien (de )?(documents?|textes?)|taille du (recueil|corpus)"), ("reference", "(instruction|circulaire|decision) n?[^a-z0-9]*[0-9]+|article [0-9]+")]
_UTTERED = ["Bonjour", "Merci beaucoup !", "Combien de documents ?", "Instruction n° 12 de 2010", "Que dit l'article 5 ?", "agrément des sociétés"]


@query(f"""
WITH said AS (SELECT unnest([{", ".join("'" + x.replace("'", "''") + "'" for x in _UTTERED)}]) AS text UNION ALL SELECT text FROM conversations)
SELECT intent, count(*) AS n FROM (SELECT CASE {" ".join(f"WHEN regexp_matches(lower(strip_accents(text)), '{p}') THEN '{k}'" for k, p in _INTENT)} ELSE 'search' END AS intent FROM said) GROUP BY intent""")
def intents(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = spark.createDataFrame([(x,) for x in _UTTERED], "text string").union(table(spark, sf_dir, "conversations").select("text"))
    return said.select(passages.intent(F.col("text"), _INTENT).alias("intent")).groupBy("intent").agg(F.count(F.lit(1)).alias("n"))


@query(f"""
WITH d AS (SELECT doc_id, text, lower(strip_accents(text)) AS norm, instr(lower(strip_accents(text)), 'tion') AS pos FROM documents)
SELECT doc_id, CASE WHEN greatest(pos - 131, 0) > 0 THEN '… ' ELSE '' END
  || trim(regexp_replace(substr(text, greatest(pos - 131, 0) + 1, least(length(text), pos + 233) - greatest(pos - 131, 0)), '[ \\t\\n\\r\\x0B\\f]+', ' ', 'g'))
  || CASE WHEN pos + 233 < length(text) THEN ' …' ELSE '' END AS snippet FROM d WHERE pos > 0""")
def snippet(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "documents").select("doc_id", T.snippet(F.col("text"), F.array(F.lit("tion"))).alias("snippet"))
    return own.where("snippet is not null")


@query()
def highlight(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interval merging has no fold in the oracle: tested against a plain version."""
    return table(spark, sf_dir, "benchmark").select("item_id", T.highlighted(F.col("text"), F.array(F.lit("tion"), F.lit("on"), F.lit("re")), least=2).alias("html"))


@query()
def excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.excerpts(table(spark, sf_dir, "documents").select("doc_id", "text"), ["tion", "ment"])
