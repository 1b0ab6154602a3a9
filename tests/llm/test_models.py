"""Quality classifier, language ID and LM scoring: held-out accuracy and defined cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliomill.llm import langid, lmscore, quality
from foliomill.llm.common import held_out

from .helpers import TEXTS, documents, labels

SF = "/root/testdata/sf0.01"


def test_folds_follow_the_checksum(spark):
    got = {r["doc_id"]: r["h"] for r in spark.range(50).select(F.col("id").alias("doc_id")).select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in range(50)}


def test_quality_is_learned(spark):
    docs, own = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    stats = quality.with_statistics(docs.select("doc_id", "text"))
    rows = quality.scored(stats, quality.fit(stats, quality.chosen(own))).join(own, "doc_id").where(held_out(F.col("doc_id"))).collect()
    hit = np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in rows])
    assert len(rows) > 50 and hit >= 0.95 and all(0 <= r["score"] <= 1 for r in rows)


@pytest.mark.parametrize("rows", [[], [(1, 1, 0), (2, 1, 0)], [(1, None, 0), (None, 0, 0), (2, 0, 0), (2, 1, 0), (3, 0, 0), (6, 1, 0)]])
def test_quality_without_enough_labels(spark, rows):
    docs = documents(spark)
    stats = quality.with_statistics(docs.select("doc_id", "text"))
    got = quality.scored(stats, quality.fit(stats, quality.chosen(labels(spark, rows)))).collect()
    assert len(got) == len(TEXTS) and all(0 <= r["score"] <= 1 for r in got)
    model = quality.fit(stats, quality.chosen(labels(spark, rows)))
    assert {(r["doc_id"], round(r["score"], 9)) for r in quality.rated(docs, model).collect()} == {(r["doc_id"], round(r["score"], 9)) for r in quality.scored(stats, model).collect()}
    kept = quality.keep_good(docs, labels(spark, rows), 0.0)
    assert kept.columns == docs.columns and kept.count() == len(TEXTS)
    assert quality.keep_good(documents(spark, [], []), labels(spark, rows)).count() == 0


def test_isotonic_rises():
    got = quality.isotonic(np.array([2.0, 1, 3, 1, 1]), np.array([0.0, 1, 1, 0, 1]))
    assert (np.diff(got) >= 0).all() and np.isclose(got @ [2, 1, 3, 1, 1], 3)


def test_language_is_learned(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = langid.identify(docs.select("doc_id", "text"), langid.train(langid.learning_rows(docs))).join(docs.select("doc_id", "lang"), "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) >= 0.97


def test_language_filters_return_every_language_of_a_gram():
    a, b = langid.grams(["the cat sat"])[0], langid.grams(["le chat sat"])[0]
    both = np.unique(np.concatenate((a, b)))
    masks = (np.isin(both, a) * 1 | np.isin(both, b) * 2).astype(np.uint64)
    own = langid.Filters.of(both, masks, ["x", "y"])
    assert ((own.containing(both) & masks) == masks).all()  # no false negatives
    assert own.predict(["the cat", "le chat", "123 !?", "", "日本"])[0] == ["x", "y", "und", "und", "x"]


def test_no_language_is_left_out(spark):
    words = ["".join(chr(0x4E00 + 40 * k + (7 * i + j) % 40) for j in range(8)) for k in range(140) for i in range(3)]
    rows = [(f"l{k // 3:03d}", " ".join([w] * (2 if k else 3000))) for k, w in enumerate(words)]  # 140 languages of little text, one of which dominates
    filters = langid.train(spark.createDataFrame(rows, "lang string, text string").repartition(3))
    assert len(filters.languages) == 140
    assert filters.predict([t[:40] for _, t in rows])[0] == [x for x, _ in rows]


def test_language_of_odd_texts(spark):
    docs = documents(spark)
    got = {r["doc_id"]: r for r in langid.identify(docs, langid.train(langid.learning_rows(docs))).collect()}
    assert [got[i]["lang_pred"] for i in (0, 1, 2)] == ["und"] * 3 and got[3]["lang_pred"] in ("en", "fr")
    nothing = langid.train(docs.where("false"))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}
    assert langid.identify(documents(spark, [], []), nothing).count() == 0


def plain_losses(texts, target, text, counted=None):
    """The models by dictionaries, without hashing; counted: whether each text is in the models."""
    from collections import Counter

    seen = Counter("".join(texts))
    known = sorted(c for c, n in seen.items() if n >= lmscore.LEAST)
    token = {c: i + 2 for i, c in enumerate(known)}
    size = len(known) + 2
    ids = lambda t: [0] * (lmscore.ORDER - 1) + [token.get(c, 1) for c in t]
    out = []
    counted = counted or [True] * len(texts)
    for own in ([t for t, c in zip(texts, counted, strict=True) if c], [t for t, y, c in zip(texts, target, counted, strict=True) if y and c]):
        grams, ctx = Counter(), Counter()
        for t in own:
            s = ids(t)
            for i in range(lmscore.ORDER - 1, len(s)):
                for k in range(1, lmscore.ORDER + 1):
                    grams[tuple(s[i - k + 1 : i + 1])] += 1
                    ctx[k, tuple(s[i - k + 1 : i])] += 1
        s, loss = ids(text), 0.0
        for i in range(lmscore.ORDER - 1, len(s)):
            p = 1 / size
            for k in range(1, lmscore.ORDER + 1):
                p = (grams[tuple(s[i - k + 1 : i + 1])] + lmscore.ALPHA * p) / (ctx[k, tuple(s[i - k + 1 : i])] + lmscore.ALPHA)
            loss -= np.log2(p)
        out.append(loss / max(1, len(text)))
    return out


def test_losses_equal_a_plain_version(spark):
    texts = ["the station of the nation", "la mention de la station", "abc abc abc the the", "éé the station", ""] * 3
    target = [1, 0, 0, 1, 0] * 3
    good = spark.createDataFrame([(i,) for i, y in enumerate(target) if y] + [(None,), (0,)], "doc_id long")
    rows = {r["doc_id"]: r for r in lmscore.score(documents(spark, texts).select("doc_id", "text"), good, folds=1).collect()}
    for i, t in enumerate(texts):
        background, wanted = plain_losses(texts, target, t)
        assert rows[i]["n_tokens"] == len(t)
        assert np.isclose(rows[i]["background_loss"], background, atol=1e-3) and np.isclose(rows[i]["target_loss"], wanted, atol=1e-3)
        assert np.isclose(rows[i]["score"], wanted - background, atol=2e-3)
    assert rows[0]["score"] < rows[1]["score"]


def alphabet(n, least):
    """Texts in an alphabet of n code points, each met least times."""
    r = np.random.default_rng(4)
    points = np.repeat(np.arange(0x4E00, 0x4E00 + n), least)
    return ["".join(map(chr, part.tolist())) for part in np.array_split(r.permutation(points), 40)]


@pytest.mark.parametrize("most", [1 << 21, 0])  # broadcast, and by groups of rows
def test_losses_stay_exact_with_many_grams(spark, monkeypatch, most):
    monkeypatch.setattr(lmscore, "MOST_GRAMS", most)
    monkeypatch.setattr(lmscore, "GROUP", 7)
    texts = alphabet(3000, 40) + ["", None]  # 120,000 characters, nearly as many grams of order 4
    good = spark.createDataFrame([(i,) for i in range(0, len(texts), 2)], "doc_id long")
    rows = {r["doc_id"]: r for r in lmscore.score(documents(spark, texts).select("doc_id", "text", "lang"), good, folds=1).collect()}
    assert len(rows) == len(texts) and rows[41]["n_tokens"] == 0 and rows[41]["score"] == 0
    plain = [t or "" for t in texts]
    for i in (0, 1):
        background, wanted = plain_losses(plain, [k % 2 == 0 for k in range(len(texts))], plain[i])
        assert np.isclose(rows[i]["background_loss"], background, atol=1e-9) and np.isclose(rows[i]["target_loss"], wanted, atol=1e-9)


@pytest.mark.parametrize("most", [1 << 20, 0])
def test_no_text_is_scored_by_models_that_counted_it(spark, monkeypatch, most):
    monkeypatch.setattr(lmscore, "MOST_GRAMS", most)
    monkeypatch.setattr(lmscore, "GROUP", 3)
    texts = ["the station of the nation", "la mention de la station", "abc abc abc the the", "a station, the one", "nation", ""] * 4
    good = [i % 3 == 0 for i in range(len(texts))]
    docs = documents(spark, texts).withColumn("score", F.lit("mine"))
    fold = {r["doc_id"]: r["f"] for r in docs.select("doc_id", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(4)).alias("f")).collect()}
    rows = {r["doc_id"]: r for r in lmscore.score(docs, spark.createDataFrame([(i,) for i, y in enumerate(good) if y], "doc_id long")).collect()}
    assert len(set(fold.values())) == 4 and rows[0]["score_"] == "mine"
    for i, t in enumerate(texts):
        background, wanted = plain_losses(texts, good, t, [fold[k] != fold[i] for k in range(len(texts))])
        assert np.isclose(rows[i]["background_loss"], background, atol=1e-9) and np.isclose(rows[i]["target_loss"], wanted, atol=1e-9)
        assert np.isclose(rows[i]["score"], wanted - background, atol=1e-9)


@pytest.mark.parametrize("size", [2, 300, 1 << 15, 1 << 16, 0x110000])
def test_keys_of_grams_are_exact(size):
    r = np.random.default_rng(5)
    tokens = np.concatenate((r.integers(0, size, (1000, 4)), [[size - 1] * 4, [0, 0, 0, size - 1]]))
    older, newer = tokens[:, 0] << lmscore.TOKEN_BITS | tokens[:, 1], tokens[:, 2] << lmscore.TOKEN_BITS | tokens[:, 3]
    got = lmscore.pairs(lmscore.keys(older, newer, size), size)
    assert (got[0] == older).all() and (got[1] == newer).all()


def test_scores_of_odd_tables(spark):
    none = spark.createDataFrame([], "doc_id long")
    got = lmscore.score(documents(spark).select("doc_id", "text", "lang"), none)
    assert got.count() == len(TEXTS) and got.columns == ["doc_id", "lang", "n_tokens", "target_loss", "background_loss", "score"]
    assert lmscore.score(documents(spark, [], []).select("doc_id", "text"), none).count() == 0


def test_languages_of_spread_masks_equal_those_of_one_table(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    own = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, ""), (-3, "12 34"), (-4, "word " * 40_000)], "doc_id long, text string"))
    one = {r["doc_id"]: r for r in langid.identify(own, langid.train(docs)).collect()}
    monkeypatch.setattr(langid, "MOST_MASKS", 0)
    monkeypatch.setattr(langid, "GROUP", 16)
    monkeypatch.setattr(langid, "GROUP_BYTES", 1 << 14)
    spread = langid.train(docs)
    assert isinstance(spread, langid.Spread)
    got = {r["doc_id"]: r for r in langid.identify(own, spread).collect()}
    assert got.keys() == one.keys() and len(got) == own.count()
    for i, r in got.items():
        assert r["lang_pred"] == one[i]["lang_pred"], i
        assert abs(r["score"] - one[i]["score"]) < 0.02, i


def test_groups_are_bounded_in_rows_and_bytes(spark):
    from foliomill.llm.common import grouped

    sizes = [0, 1, 3, 100, 1000, 5000, 70_000] * 40
    docs = spark.createDataFrame([("x" * n,) for n in sizes], "text string").coalesce(1)
    rows = grouped(docs, "text", "g", 16, 20_000).groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("size")).collect()
    assert sum(r["n"] for r in rows) == len(sizes)
    assert all(r["n"] <= 16 and (r["size"] <= 20_000 or r["n"] == 1) for r in rows) and max(r["n"] for r in rows) > 1
