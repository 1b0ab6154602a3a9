"""Rows that every operator must stand: nulls, empties, long texts, repeats, further columns with clashing names."""

LONG = "mot " * 30_000 + "x" * 50_000
TEXTS = [None, "", " \n\t ", "a", "one two three four five six seven eight nine ten " * 3, LONG, "same text here for all of us", "same text here for all of us", "Ünï çödé 日本語 😀 \x00 end", "|".join("abc" for _ in range(50))]


def documents(spark, texts=None, ids=None):
    texts = TEXTS if texts is None else texts
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, ("en", "fr", None)[k % 3], "src", len(t or ""), "s", 1.0, "k") for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, spans string, score double, stats string").repartition(3)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
