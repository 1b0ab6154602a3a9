"""The registered query of each operator, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, chat, decontam, langid, lmscore, quality, rules, secrets, sharding, simhash, spm, substrings, trie
from .common import held_out, stored, table


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digests(chat.format_conversations(own.unionByName(more)))


OP1_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, length(regexp_replace(regexp_replace(role, '(<)(\\*/?s>)', '\1\\\2', 'g'), '(\[)(\\*/?INST\])', '\1\\\2', 'g'))
          + length(regexp_replace(regexp_replace(text, '(<)(\\*/?s>)', '\1\\\2', 'g'), '(\[)(\\*/?INST\])', '\1\\\2', 'g'))
          + length('<s>[INST]  [/INST] </s>' || chr(10)) AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = secrets.joined(F.filter("spans", lambda s: s["kind"] != "markov"))
    return found.select("doc_id", of("assign"), of("access"), of("hex"), of("markov"), F.sha2(base, 256).alias("base_sha256"), secrets.joined(F.col("spans")).alias("spans"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


OP4_SQL = r"""
WITH item AS (
  SELECT item_id, w, least(len(w), 13) AS need FROM (
    SELECT CAST(item_id AS VARCHAR) AS item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark) WHERE len(w) > 0),
gram AS (
  SELECT DISTINCT item_id, need, array_to_string(w[i:i + need - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - need + 2)) AS i FROM item)),
doc AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
size AS (SELECT DISTINCT need FROM gram),
hit AS (
  SELECT k, i, d.need, item_id
  FROM (SELECT k, w, need, unnest(range(1, len(w) - need + 2)) AS i FROM doc, size) d
  JOIN gram g ON g.need = d.need AND g.g = array_to_string(w[i:i + d.need - 1], ' ')),
word AS (SELECT k, count(*) AS n FROM (SELECT DISTINCT k, unnest(range(i, i + need)) AS p FROM hit) GROUP BY k),
ids AS (SELECT k, count(DISTINCT item_id) AS n, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS s FROM hit GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(word.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(ids.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids.s, '')) AS items_sha256, coalesce(word.n, 0) > 0 AND 20 * coalesce(word.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (k) LEFT JOIN ids USING (k)
""".replace("\\\\", "\\")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    return spm.digests(spm.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = stored(quality.with_statistics(table(spark, sf_dir, "documents").select("doc_id", "text")), "stats")
    model = quality.fit(stats, quality.chosen(table(spark, sf_dir, "labels")))
    found = quality.scored(stats, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_QUOTED = lambda x: x.replace("'", "''")
_NOTICE = " OR ".join([f"starts_with(low, '{rules.OPENING}')", *(f"contains(low, '{_QUOTED(x)}')" for x in rules.NOTICES)])
OP7_SQL = rf"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT k, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM doc)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT k, count(*) AS n FROM (SELECT DISTINCT k, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY k),
line AS (SELECT k, unnest(string_split(text, chr(10))) AS line FROM doc),
m AS (SELECT k, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w, lower(line) AS low, length(regexp_replace(line, '[^\p{{L}}]+', '', 'g')) AS letters, length(regexp_replace(line, '[^\p{{Lu}}]+', '', 'g')) AS upper,
  length(regexp_replace(line, '[^#*$%&|<>]+', '', 'g')) AS symbols, length(regexp_replace(line, '[^|›»]+', '', 'g')) AS separators FROM line),
f AS (SELECT k, line, len(w) AS n, len(w) > 0 AND ((separators >= 3 AND 3 * separators >= len(w) - separators) OR (letters >= 20 AND 10 * upper > 7 * letters) OR 3 * symbols > len(w) OR (len(w) <= 30 AND ({_NOTICE})) OR NOT regexp_matches(line, '{_QUOTED(rules.END_MARK)}')
  OR len(list_filter(range(1, len(w) - 6), lambda i: len(list_distinct(w[i:i + 7])) = 1)) > 0) AS fails FROM m),
own AS (SELECT k, CAST(coalesce(sum(n) FILTER (NOT fails), 0) AS BIGINT) AS left_words, count(*) FILTER (n > 0) - count(DISTINCT line) FILTER (n > 0) AS dup FROM f GROUP BY k),
base AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(dup AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, left_words FROM doc JOIN own USING (k) LEFT JOIN rep USING (k))
SELECT doc_id, n_words, coalesce(word_chars, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 1 - left_words / n_words <= 0.5 AND left_words >= 20 AS kept FROM base
"""


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.train(langid.learning_rows(docs)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "home")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lmscore.score(table(spark, sf_dir, "documents").select("doc_id", "text"), good)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


#: The checksum of the reduction is CRC-32, bit by bit, for which DuckDB has no function.
OP11_SQL = r"""
WITH turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(u)) AS k, u, size FROM (
  SELECT conv_id, turn, coalesce(role, '') AS role, length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '') AS u, length(coalesce(text, '')) AS size
  FROM conversations WHERE conv_id IS NOT NULL)),
own AS (SELECT conv_id, list(sha256(u) ORDER BY k) AS us, list(size ORDER BY k) AS sizes FROM turns GROUP BY conv_id),
step AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda acc, b: list_reduce(list_prepend(xor(acc, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END)), 4294967295::BIGINT) % 6 AS h
  FROM own),
built AS (
  SELECT a.conv_id, list_concat(coalesce(b.us, [])[1:a.h], a.us[a.h + 1:]) AS us, list_concat(coalesce(b.sizes, [])[1:a.h], a.sizes[a.h + 1:]) AS sizes
  FROM step a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
pre AS (
  SELECT conv_id, d, len(us) = d AS ends, sha256(array_to_string(us[1:d], '')) AS pk, CASE WHEN d > 0 THEN sha256(array_to_string(us[1:d - 1], '')) END AS up,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS size, list_transform(range(0, d + 1), lambda i: sha256(array_to_string(us[1:i], ''))) AS above
  FROM (SELECT *, unnest(range(0, len(us) + 1)) AS d FROM built)),
node AS (
  SELECT pk, min(conv_id) AS conv_id, any_value(d) AS depth, any_value(up) AS up, any_value(above) AS above, count(*) AS n, any_value(size) AS size,
         sha256(coalesce(string_agg(conv_id, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM pre GROUP BY pk),
child AS (SELECT up AS pk, count(*) AS n FROM node WHERE up IS NOT NULL GROUP BY up),
below AS (
  SELECT a AS pk, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved
  FROM (SELECT unnest(above) AS a, child.pk IS NULL AS leaf, (node.n - 1) * size AS saved FROM node LEFT JOIN child ON child.pk = node.pk) GROUP BY a)
SELECT node.conv_id, CAST(node.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, node.n AS n_convs, coalesce(child.n, 0) AS n_children, n_leaves, saved AS saved_tokens, node.ends_sha256
FROM node JOIN below ON below.pk = node.pk LEFT JOIN child ON child.pk = node.pk LEFT JOIN node p ON p.pk = node.up
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"), table(spark, sf_dir, "labels"))


OP12_SQL = r"""
WITH lab AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
doc AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
own AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         map {'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w), 'C': 100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 3 * length(text),
              'D': regexp_matches(text, '[#$%&*|]'), 'E': coalesce(doc.doc_id > min(doc.doc_id) OVER (PARTITION BY text), false)} AS f
  FROM doc LEFT JOIN lab ON lab.doc_id = doc.doc_id),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
step AS (
  SELECT part, filter_order, k AS step, good, toxic, f[filter_order[k]] AS here,
         len(list_filter(range(1, k), lambda i: f[filter_order[i]])) > 0 AS before, len(list_filter(map_values(f), lambda v: v)) = 1 AS alone
  FROM own, orders, (SELECT unnest(range(1, 6)) AS k)),
sums AS (
  SELECT part, filter_order, step, count(*) FILTER (NOT here AND NOT before) AS kept, count(*) FILTER (here AND NOT before) AS removed, count(*) FILTER (here AND before) AS redundant,
         count(*) FILTER (here AND alone) AS unique_fails, count(*) FILTER (here AND NOT before AND good) AS good_lost, count(*) FILTER (here AND NOT before AND toxic) AS toxic_lost
  FROM step GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley
FROM sums
"""


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.remove(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP13_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT k, i, hash(array_to_string(w[i:i + 34], ' ')) AS g, md5(array_to_string(w[i:i + 34], ' ')) AS m FROM (SELECT k, w, unnest(range(1, len(w) - 33)) AS i FROM doc)),
twice AS (SELECT k, i FROM win JOIN (SELECT g, m FROM win GROUP BY g, m HAVING count(*) > 1) USING (g, m)),
gone AS (SELECT DISTINCT k, unnest(range(i, i + 35)) AS p FROM twice),
own AS (SELECT k, list(p) AS ps FROM gone GROUP BY k),
word AS (SELECT k, p, w[p] AS x FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS p FROM doc) ANTI JOIN gone USING (k, p)),
kept AS (SELECT k, string_agg(x, ' ' ORDER BY p) AS t FROM word GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN own USING (k) LEFT JOIN kept USING (k)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_chat": op1_chat, "op2_secrets": op2_secrets, "op3_simhash": op3_simhash, "op4_decontamination": op4_decontamination, "op5_sentencepiece": op5_sentencepiece, "op6_quality": op6_quality, "op7_quality_rules": op7_quality_rules, "op8_language": op8_language, "op9_sharding": op9_sharding, "op10_lm_score": op10_lm_score, "op11_prefix_trie": op11_prefix_trie, "op12_filter_audit": op12_filter_audit, "op13_substring_dedup": op13_substring_dedup}
SQL: dict[str, str] = {"op1_chat": OP1_SQL, "op4_decontamination": OP4_SQL, "op7_quality_rules": OP7_SQL, "op11_prefix_trie": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_substring_dedup": OP13_SQL}
