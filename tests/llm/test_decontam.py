import random
import re

from pyspark.sql import functions as F

from foliomill.llm import decontam

from .helpers import TEXTS, documents


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items):
    own, hit, ids = words(text), set(), set()
    for i, t in items:
        item = words(t)
        n = min(13, len(item))
        grams = {tuple(item[k : k + n]) for k in range(len(item) - n + 1)} if n else set()
        for k in range(len(own) - n + 1):
            if n and tuple(own[k : k + n]) in grams:
                hit |= set(range(k, k + n))
                ids.add(str(i))
    return len(own), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(own)


def check(spark, texts, items):
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontam.annotate(documents(spark, texts), bench)
    rows = {r["doc_id"]: (r["n_words"], r["n_hit"], r["item_ids"], r["contaminated"]) for r in got.collect()}
    assert rows == {i: plain(t, items) for i, t in enumerate(texts)}


def test_windows_equal_brute_force(spark):
    r = random.Random(4)
    voc = ["the", "of", "Énd", "x1", "réa", "tion", "it"]
    say = lambda n: " ".join(r.choice(voc) for _ in range(n))
    items = [(i, say(r.randint(14, 40))) for i in range(12)]
    texts = TEXTS + [say(50) + ", " + ". ".join(r.choice(items)[1].split()[r.randint(0, 2) :]).upper() + say(r.randint(0, 60)) for _ in range(40)] + [items[0][1], items[1][1] * 2]
    check(spark, texts, items)


def test_short_items_nulls_and_equal_items(spark):
    items = [(1, "alpha beta gamma"), (2, "alpha beta gamma"), (3, None), (4, "--"), (5, "solo"), (6, " ".join(f"w{i}" for i in range(20)))]
    texts = ["alpha, beta gamma!", "x alpha beta x gamma solo solo", " ".join(f"w{i}" for i in range(20)), "w1 w2 w3", None, "", "ALPHA Beta gamma alpha beta gamma"]
    check(spark, texts, items)


def test_repetitive_texts(spark):
    items = [(1, "la " * 15), (2, "la la la li " * 5)]
    check(spark, ["la " * k for k in (5, 12, 13, 14, 30, 200)] + ["la la la li " * 9, "li " + "la la la li " * 4], items)


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    for name in ("BROADCAST_ROWS", "BROADCAST_WINDOWS", "BROADCAST_BYTES"):
        monkeypatch.setattr(decontam, name, 0)
    check(spark, ["one two three four five six seven eight nine ten eleven twelve thirteen fourteen " * 2, "no"], [(9, "two three four five six seven eight nine ten eleven twelve thirteen fourteen")])


def test_empty_tables_and_columns(spark):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = documents(spark)
    assert decontam.clean(docs, bench).count() == docs.count() and decontam.clean(docs, bench).columns == docs.columns
    assert decontam.annotate(documents(spark, [], []), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
    twice = decontam.annotate(documents(spark, ["a b"] * 2, [3, 3]), spark.createDataFrame([(1, "a b")], "item_id long, text string"))
    assert [r["n_hit"] for r in twice.collect()] == [2, 2]


def test_long_texts_of_many_words_and_items_of_mixed_length(spark):
    r = random.Random(8)
    voc = [f"w{i}" for i in range(900)]
    long = [r.choice(voc) for _ in range(40_000)]
    items = [(1, " ".join(long[5000:9000])), (2, "w17"), (3, "w3 w5"), (4, " ".join(long[100:112])), (5, " ".join(long[30_000:30_013])), (6, " ".join(r.choice(voc) for _ in range(3000)))]
    check(spark, [" ".join(long), "w17, w3 W5", None, " ".join(long[:200]) * 2], items)


def test_items_without_an_id_mark_words(spark):
    bench = spark.createDataFrame([(None, "solo tango"), (4, "alpha beta"), (4, "gamma delta")], "item_id long, text string")
    got = {r["doc_id"]: (r["n_hit"], r["item_ids"]) for r in decontam.annotate(documents(spark, ["x solo tango", "alpha beta gamma delta solo tango"]), bench).collect()}
    assert got == {0: (2, []), 1: (6, ["4"])}


def test_columns_of_the_input_keep_their_values(spark):
    extra = documents(spark, ["solo x", "y z"]).withColumn("n_words", F.lit("mine")).withColumn("Contaminated", F.col("doc_id") * 2.5).withColumn("__foliomill_a", F.lit(7)).withColumn("a.b", F.lit(1))
    bench = spark.createDataFrame([(1, "solo")], "item_id long, text string")
    out = decontam.clean(extra, bench)
    assert out.schema == extra.schema and [tuple(r) for r in out.collect()] == [tuple(r) for r in extra.where("doc_id = 1").collect()]
    got = {r["doc_id"]: r for r in decontam.annotate(extra, bench).collect()}
    assert got[0]["n_words"] == 2 and got[0]["n_words_"] == "mine" and got[1]["Contaminated_"] == 2.5 and got[0]["contaminated"]
