"""Quality rules, line first, with DataFrame functions only.

A line of a document fails if no sentence ends in it (no end mark, neither at its
end nor within it: headings, menus, lists of words), if it is navigation (three or
more separators between short cells), boilerplate (a licence, cookie, rights or
subscription notice in English, French, German or Spanish, ``MOST_NOTICE`` words
at most), shouting (nearly all letters upper case), symbol noise (more than one
symbol of ``#*$%&|<>`` for every three words), or one word over and over.  Lines
that fail are removed.  A document is rejected if it fails the base rules, or
if its failing lines hold over ``LOSS`` of its words, or if fewer than
``LEAST_WORDS`` words are left; the base rules reject texts of fewer words.

Everything is computed within a row: repeated windows are found by sorting the
64-bit hashes of a text's own windows, so nothing is shuffled and a hot source
or group of copies doesn't matter.

Defined cases: a null or empty text has no words, zero counts, fails the base
rules and keeps no line; a text is one line if it has no line feed; repeated
rows each get a row; texts may be of any length; lines that tie as repeats count
from the second on; an empty table gives an empty result; columns of the input
whose names ``annotate`` adds stay under that name and an underscore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, aside, col

SYMBOLS = "#*$%&|<>"  # within brackets
GRAM, LOSS, LEAST_WORDS = 8, 0.5, 20
WORD = f"[^{SPACE}]++"
#: A sentence's end: a mark before white space or the line's end, closing quotes and brackets between; or a mark of scripts without spaces.
END_MARK = r"""[.!?:;…]["'»”’)\]]*(?:[\x20\x09-\x0D]|\z)|[。！？；।؟]"""
#: Notices are lines of this many words at most: longer ones are text that mentions a phrase.
MOST_NOTICE = 30
#: Phrases of boilerplate lines, in lower case; the last only opens a line.
NOTICES = (
    "licensed under ", "all rights reserved", "terms of use", "terms of service", "privacy policy", "accept cookies", "accept all cookies", "subscribe to our ", "subscribe to the ", "sign up for ", "click here",
    "tous droits réservés", "conditions d’utilisation", "conditions d'utilisation", "politique de confidentialité", "accepter les cookies", "accepter tous les cookies", "abonnez-vous à ", "cliquez ici",
    "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "cookies akzeptieren", "newsletter abonnieren", "klicken sie hier", "hier klicken",
    "todos los derechos reservados", "términos de uso", "condiciones de uso", "política de privacidad", "aceptar cookies", "aceptar todas las cookies", "suscríbete a ", "haz clic aquí", "haga clic aquí",
)
OPENING = "copyright "


def word_array(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def window_hashes(words: Column, gram: int = GRAM) -> Column:
    """The hashes of all windows of gram words."""
    n = F.size(words)
    none = F.array().cast("array<bigint>")
    return F.when(n >= gram, F.transform(F.sequence(F.lit(1), F.greatest(n - gram + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, gram)))).otherwise(none)


def union_of(sorted_windows: Column, gram: int = GRAM) -> Column:
    """Words under windows that share a hash with another: from array<struct<h,i>> sorted by h."""
    size = F.size(sorted_windows)
    twice = F.filter(
        sorted_windows,
        lambda x, k: ((k > 0) & (F.get(sorted_windows, k - 1)["h"] == x["h"])) | ((k < size - 1) & (F.get(sorted_windows, k + 1)["h"] == x["h"])),
    )
    at = F.sort_array(F.transform(twice, lambda x: x["i"]))
    fold = F.aggregate(
        at,
        F.struct(F.lit(0).alias("n"), F.lit(-gram).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(i - acc["last"], F.lit(gram))).cast("int").alias("n"), i.cast("int").alias("last")),
    )
    return fold["n"].cast("long")


def of_class(text: Column, kind: str) -> Column:
    """Number of characters of a kind: the length of what stays when runs of others go."""
    return F.length(F.regexp_replace(text, f"[^{kind}]++", ""))


def measured(line: Column) -> Column:
    """What the line rules need, each figure once: words, letters, upper-case letters, symbols, separators."""
    counts = {"letters": r"\p{L}", "upper": r"\p{Lu}", "symbols": SYMBOLS, "separators": "|›»"}
    return F.struct(line.alias("line"), F.regexp_count(line, F.lit(WORD)).alias("words"), F.lower(line).alias("low"), *(of_class(line, kind).alias(name) for name, kind in counts.items()))


def failing(m: Column) -> Column:
    """The line rules on a measured line; a line without a word passes."""
    navigation = (m["separators"] >= 3) & (3 * m["separators"] >= m["words"] - m["separators"])
    shouting = (m["letters"] >= 20) & (10 * m["upper"] > 7 * m["letters"])
    one_word = (m["words"] >= 8) & m["line"].rlike(rf"(?:^|[{SPACE}])([^{SPACE}]++)(?:[{SPACE}]++\1(?=[{SPACE}]|\z)){{7}}")
    notice = F.startswith(m["low"], F.lit(OPENING))
    for phrase in NOTICES:
        notice = notice | F.contains(m["low"], F.lit(phrase))
    unmarked = ~m["line"].rlike(END_MARK)
    return (m["words"] > 0) & (unmarked | navigation | shouting | (3 * m["symbols"] > m["words"]) | ((m["words"] <= MOST_NOTICE) & notice) | one_word)


def annotate(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the base figures, base_failed, kept, cleaned (the text without failing lines) and lost (share of words in them) added."""
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "cleaned", "lost"]
    docs, names = aside(docs, [*added, "__words", "__lines", "__full", "__hash", "__any", "__sorted", "__good", "__left"])
    own = [col(c) for c in docs.columns]
    text = F.coalesce(col(names[text_col]), F.lit(""))
    step = docs.withColumn("__words", word_array(text)).withColumn("__lines", F.split(text, "\n", -1))
    step = step.select(
        *own,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        of_class(text, SYMBOLS).cast("long").alias("n_symbols"),
        "__lines",
        F.filter("__lines", lambda x: x.rlike(f"[^{SPACE}]")).alias("__full"),
        window_hashes(F.col("__words")).alias("__hash"),
    )
    step = step.withColumn("__any", F.size(F.array_distinct("__hash")) < F.size("__hash"))
    pairs = F.arrays_zip(F.col("__hash").alias("h"), F.sequence(F.lit(1), F.greatest(F.size("__hash"), F.lit(1))).alias("i"))
    step = step.withColumn("__sorted", F.when(F.col("__any"), F.sort_array(pairs)))
    step = step.withColumn("n_repeat_words", F.when(F.col("__any"), union_of(F.col("__sorted"))).otherwise(F.lit(0)).cast("long"))
    step = step.withColumn("n_dup_lines", (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long"))
    step = step.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))
    step = step.withColumn("__good", F.filter(F.transform("__lines", measured), lambda m: ~failing(m)))
    step = step.withColumn("cleaned", F.array_join("__good.line", "\n")).withColumn("__left", F.aggregate("__good.words", F.lit(0), lambda n, w: n + w).cast("long"))
    step = step.withColumn("lost", F.when(F.col("n_words") == 0, F.lit(0.0)).otherwise(1 - F.col("__left") / F.col("n_words")))
    step = step.withColumn("kept", ~F.col("base_failed") & (F.col("lost") <= LOSS) & (F.col("__left") >= LEAST_WORDS))
    return step.select(*own, *added)
