"""Benchmark decontamination with a broadcast hash set of test n-grams; DataFrame functions only.

Words are runs of ASCII letters and digits and of all characters beyond ASCII,
A-Z in lower case.  A window is ``WINDOW`` consecutive words of a benchmark
item, or the whole of a shorter item.

Windows of each length n are looked for by themselves, with m = (n + 1) // 2:
a window that occurs in a document covers a whole chunk of m words at a
position divisible by m, and begins less than m words before the first such
chunk.  Documents are cut once by one regular expression into chunks of m
words, each of which travels with its two neighbours only, and their hashes
probe the set of all m-grams of windows.  Around each chunk met, the up to m
windows that begin there are spelled out and compared, word by word, with the
distinct windows, so an occurrence gives one row however many items share it.

The set and the windows are broadcast only after a count of their rows.  A
larger set is first cut to the grams that the documents have; what is still
larger is joined by a shuffle.

Defined cases: a null text has no words, n_words 0 and is not contaminated; an
item that is null or has no words is left out, one without an id marks words but isn't counted; repeated rows of either table
give the same figures for each row, and an item_id counts once a document; of
windows that tie or overlap each counts, a word under several once; texts and
items may be of any length, as no row holds more than one text or three chunks;
an empty table on either side gives no hits.  Columns of the input whose names
``annotate`` adds stay under that name and an underscore; ``clean`` returns all
columns as they were.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import aside, col, lower_ascii, restored, stored

WINDOW = 13
#: Rows of hashes, and of windows of some 13 words, that are broadcast at most; bytes of what was found in documents.
BROADCAST_ROWS, BROADCAST_WINDOWS, BROADCAST_BYTES = 2_000_000, 250_000, 32 << 20
#: Characters that are part of no word, after lower-casing; and those of words before it (a class of what is in it is matched much faster than its complement).
OTHER, INSIDE = r"\x00-\x2F\x3A-\x60\x7B-\x7F", r"A-Za-z0-9\x80-\x{10FFFF}"
KEY = ["__foliomill_a", "__foliomill_b"]
ADDED = ["n_words", "n_hit", "n_items", "item_ids", "hit_spans", "contaminated"]


def normal(text: Column) -> Column:
    """The words in lower case, each followed by one space."""
    return F.regexp_replace(F.regexp_replace(F.concat(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(" ")), f"[{OTHER}]++", " "), "^ ", "")


def words(normalised: Column) -> Column:
    return F.filter(F.split(normalised, " ", -1), lambda w: w != "")


def windows_of(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """(wid, need, window), the distinct windows and their lengths; (wid, item_id), the items that have them."""
    own = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    cut = chunks(own, ["item_id"], "text", window)  # a window begins in one chunk and ends in it or the next
    spelled = cut.select("item_id", "chunk", words(F.concat_ws("", "part.own", "part.after")).alias("w"), F.size(words(F.col("part.own"))).alias("own"))
    need = F.when(F.col("chunk") == 0, F.least(F.size("w"), F.lit(window))).otherwise(window)
    begun = F.transform(F.sequence(F.lit(1), F.least(F.col("own"), F.size("w") - need + 1)), lambda i: F.array_join(F.slice("w", i, need), " "))
    each = spelled.where(F.size("w") >= need).select("item_id", need.alias("need"), F.explode(begun).alias("window"))
    each = stored(each.distinct(), "item-windows")
    distinct = stored(each.select("need", "window").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows")
    return distinct, each.where(F.col("item_id").isNotNull()).join(distinct.select("wid", "window"), "window").select("wid", "item_id")


def chunks(docs: DataFrame, keys: list[str], text_col: str, m: int) -> DataFrame:
    """(keys, chunk, part, gram): every chunk of m words with the chunks beside it, null at the ends, and its hash."""
    cut = docs.select(*keys, F.regexp_extract_all(normal(col(text_col)), F.lit(f"(?:[^ ]++ ){{1,{m}}}"), F.lit(0)).alias("chunks"))
    beside = F.transform("chunks", lambda c, i: F.struct(F.get("chunks", i - 1).alias("before"), c.alias("own"), F.get("chunks", i + 1).alias("after")))
    return cut.select(*keys, F.posexplode(beside).alias("chunk", "part")).withColumn("gram", F.xxhash64("part.own"))


def hits(docs: DataFrame, windows: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """(keys, begin, end, wid): every occurrence of a window in a document, in words, end exclusive."""
    needs = [r[0] for r in windows.select("need").distinct().orderBy("need").collect()]  # WINDOW figures at most
    found = []
    for n in needs:
        m = (n + 1) // 2
        own = windows.where(F.col("need") == n).select("wid", "window")
        spelled = F.split("window", " ", -1)
        grams = own.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(m)), lambda d: F.xxhash64(F.concat(F.array_join(F.slice(spelled, d, m), " "), F.lit(" "))))).alias("gram")).distinct()
        cut = chunks(docs, keys, text_col, m)
        if grams.count() > BROADCAST_ROWS:
            grams = stored(grams.join(cut.select("gram").distinct(), "gram", "left_semi"), "grams")
        if grams.count() <= BROADCAST_ROWS:
            grams = F.broadcast(grams)
        if own.count() <= BROADCAST_WINDOWS:
            own = F.broadcast(own)
        met = cut.join(grams, "gram", "left_semi")
        met = met.select(*keys, (F.col("chunk") * m).alias("at"), F.when(F.col("part.before").isNull(), 0).otherwise(m).alias("base"), words(F.concat_ws("", "part.before", "part.own", "part.after")).alias("w"))
        # d: words of a window before the chunk
        least, most = F.greatest(F.lit(0), F.col("base") + n - F.size("w")), F.least(F.lit(m - 1), F.col("base"))
        begun = F.transform(F.sequence(least, most), lambda d: F.struct((F.col("at") - d).alias("begin"), F.array_join(F.slice("w", F.col("base") - d + 1, n), " ").alias("window")))
        each = met.where(least <= most).select(*keys, F.explode(begun).alias("x")).select(*keys, "x.begin", "x.window")
        found.append(each.join(own, "window").select(*keys, "begin", (F.col("begin") + n).alias("end"), "wid"))
    if not found:
        return docs.select(*keys, F.lit(0).alias("begin"), F.lit(0).alias("end"), F.lit(0).cast("long").alias("wid")).where("false")
    return reduce(DataFrame.unionAll, found)


def merged(found: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, begin, end): the union of the spans of each key."""
    before = Window.partitionBy(*keys).orderBy("begin", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opened = found.select(*keys, "begin", "end").distinct().withColumn("opens", F.when(F.col("begin") <= reach, 0).otherwise(1))
    return opened.withColumn("run", F.sum("opens").over(before)).groupBy(*keys, "run").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).drop("run")


def annotate(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """docs with n_words, n_hit, n_items, item_ids (sorted as strings), hit_spans (merged, by begin) and contaminated added.

    A row is told by two hashes of its text, as equal texts have equal hits.  What was found is stored and its size summed up:
    up to ``BROADCAST_BYTES`` it is broadcast and no text moves, beyond that the join shuffles."""
    told, names = aside(docs, [*ADDED, *KEY])
    text, none = F.coalesce(col(names[text_col]), F.lit("")), F.array().cast("array<string>")
    told = told.withColumn(KEY[0], F.xxhash64(text)).withColumn(KEY[1], F.xxhash64(F.lit(1), text))
    windows, of_items = windows_of(items, window)
    runs = stored(hits(told, windows, KEY, names[text_col]), "hits")
    spans = merged(runs, KEY).groupBy(*KEY).agg(F.sum(F.col("end") - F.col("begin")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("hit_spans"))
    ids = runs.select(*KEY, "wid").distinct().join(of_items, "wid").select(*KEY, "item_id").distinct().groupBy(*KEY).agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
    found = stored(spans.join(ids, KEY, "left").withColumn("item_ids", F.coalesce("item_ids", none)), "found")
    if (found.agg(F.sum(64 + 8 * F.size("hit_spans") + F.octet_length(F.array_join("item_ids", ",")))).first()[0] or 0) <= BROADCAST_BYTES:
        found = F.broadcast(found)
    met = told.join(found, KEY, "left")
    return met.select(
        *(col(c) for c in names.values()),
        F.regexp_count(text, F.lit(f"[{INSIDE}]++")).cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(F.coalesce("item_ids", none)).cast("long").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"),
        F.coalesce("hit_spans", F.array().cast("array<struct<begin:int,end:int>>")).alias("hit_spans"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs without the contaminated ones, in its own columns."""
    own, names = aside(docs, [*ADDED, *KEY])
    return restored(annotate(own, items, names["text"], window).where(~F.col("contaminated")), names)
