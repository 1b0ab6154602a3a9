"""Secret scans with DataFrame functions only: fixed patterns, and character Markov models for what they miss.

The base patterns are found as stated by the contract.  Beside them, every run
of ``TOKEN`` characters is scored with two first-order character Markov models,
one of random strings and one of ordinary identifiers: the sum over its
transitions of log p(b|a, random) / p(b|a, identifier).  A run of ``WHOLE`` or
more characters whose ratio is ``PER_CHAR`` or more a character is a further
span, of kind markov.  In any other run a running sum of the ratio, less
``DRIFT`` a transition, finds the parts that look random: a part ends where the
sum is used up or has fallen by ``FALL``, counts if its sum came to ``TOTAL`` and
it mixes digits with letters or has an upper-case letter after a lower-case one,
and reaches to the ends of its letters and digits.  Markov spans that lie within
a base span are left out.  Both models come from labelled samples: ``train`` takes
any table (label, token); ``samples`` makes the default one from fixed words and
hash digests.  The trained table has 65 x 65 entries whatever is scanned.

Positions count code points, ends are exclusive.  Nothing is done from a text's
start for each match, so the work grows in proportion to a text's length; a run
of over 1024 characters is scored in parts of that length.  Defined cases: a
null text is empty and has no spans; of spans that begin together the kind
decides; repeated rows each get a row; an empty table gives an empty result;
a column ``spans`` of the input stays as ``spans_``, in ``redact`` as it was.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import aside, col

KINDS = ("assign", "access", "hex", "markov")
ASSIGN = r"""(?=[pPsStTaA])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"
TOKEN = r"[A-Za-z0-9+/_=-]{12,1024}+(?:[A-Za-z0-9+/_=-]{1,11}(?![A-Za-z0-9+/_=-]))?"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
STATES = len(ALPHABET) + 1
WHOLE, PER_CHAR = 20, 0.4
TOTAL, DRIFT, FALL = 10.0, 0.3, 8.0
#: Values that one fold gathers, and characters of a piece that spans are cut from.
BLOCK, PIECE = 128, 512
MIXED = "[a-z][A-Z]|[0-9][+/_=-]*[A-Za-z]|[A-Za-z][+/_=-]*[0-9]"
#: Words of ordinary identifiers.
WORDS = (
    "account action active address after amount array audit before begin block board buffer build cache call category change channel check child class clear client "
    "close cluster code column command commit config connect content context control copy count create current customer data date default delete detail device "
    "document domain done drive edit element email enable entry error event exist export factory failure field file filter first folder format frame function "
    "general group handle header health history home image import index input insert instance integer invoice item issue join kernel label language last layer "
    "length level library limit line link list local location login main manager market master member memory message method mode model module month name network "
    "node number object offset open option order output owner package page parent part path payment percent person phone plan point policy position price process "
    "query queue quota range read record region release remove report request resource result return role route rule sample save schema scope score search section select "
    "server service session shape share size source stage state status storage stream string system table target task template text thread title total track type unit "
    "update usage user value vector version view visit volume wait weight window word worker"
).split()


def samples(spark: SparkSession, n: int = 4000) -> DataFrame:
    """(label, token): 1 for random strings (hex, Base64 and alphanumeric digests), 0 for identifiers of two to five words and rules of one character."""
    words = F.split(F.lit(" ".join(WORDS)), " ")

    def word(i: int) -> Column:
        return F.element_at(words, (F.crc32(F.encode(F.concat_ws("/", "id", F.lit(str(i))), "utf-8")) % len(WORDS) + 1).cast("int"))

    row = spark.range(0, n, 1, 4).select(F.col("id").cast("string").alias("id"), F.col("id").alias("k"))
    digest = F.sha2(F.encode("id", "utf-8"), 512)
    base = F.substring(F.base64(F.unhex(digest)), 1, 60)
    random = F.element_at(F.array(F.substring(digest, 1, 48), base, F.regexp_replace(base, "[+/]", ""), F.upper(F.regexp_replace(base, "[+/]", ""))), (F.col("k") % 4 + 1).cast("int"))
    several = F.slice(F.array(*[word(i) for i in range(5)]), 1, (F.col("k") % 4 + 2).cast("int"))
    camel = F.array_join(F.transform(several, F.initcap), "")
    kind = F.floor(F.col("k") / 4) % 7
    marks = ALPHABET + "-_=."
    rule = F.repeat(F.substring(F.lit(marks), (F.floor(F.col("k") / 28) % len(marks) + 1).cast("int"), F.lit(1)), 40)
    plain = F.when(kind == 0, camel).when(kind == 1, F.array_join(several, "_")).when(kind == 2, F.upper(F.array_join(several, "_"))).when(kind == 3, F.array_join(several, "-")).when(kind == 4, F.array_join(several, "/")).when(kind == 5, rule).otherwise(F.array_join(several, ""))
    return row.select(F.lit(1).alias("label"), random.alias("token")).union(row.select(F.lit(0), plain))


def state(char: Column) -> Column:
    """0 for a character outside the alphabet, else its place."""
    return F.call_function("instr", F.lit(ALPHABET), char)


def train(labelled: DataFrame, smooth: float = 0.5) -> list[float]:
    """Log-likelihood ratios of all transitions, row by row: STATES * STATES values."""
    step = labelled.where("length(token) > 1").select("label", "token", F.explode(F.sequence(F.lit(1), F.length("token") - 1)).alias("i"))
    pair = step.select("label", *(state(F.substring("token", F.col("i") + k, F.lit(1))).alias(c) for k, c in enumerate("ab")))
    counts = pair.groupBy("label", "a", "b").count().collect()  # at most 2 * 65 * 65 rows
    seen = {(r["label"], r["a"], r["b"]): r["count"] for r in counts}
    total = {(y, a): sum(seen.get((y, a, b), 0) for b in range(STATES)) for y in (0, 1) for a in range(STATES)}
    p = lambda y, a, b: (seen.get((y, a, b), 0) + smooth) / (total[y, a] + smooth * STATES)
    return [math.log(p(1, a, b) / p(0, a, b)) for a in range(STATES) for b in range(STATES)]


def placed(text: Column, pattern: str) -> Column:
    """array<struct<start,end,match>> of all leftmost matches, from the lengths of matches and of what lies between them."""
    kind = "array<struct<start:int,end:int,match:string>>"

    def of(got: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        both = F.arrays_zip(gaps.alias("g"), got.alias("m"))  # one gap more than matches
        return let(F.filter(both, lambda x: x["m"].isNotNull()), with_starts)

    def with_starts(both: Column) -> Column:
        before = prefix(F.transform(both, lambda x: x["g"] + F.length(x["m"])), lambda a, b: a + b)
        spans = F.arrays_zip(both.alias("x"), before.alias("at"))
        return F.transform(spans, lambda s: F.struct((s["at"] + s["x"]["g"]).alias("start"), (s["at"] + s["x"]["g"] + F.length(s["x"]["m"])).alias("end"), s["x"]["m"].alias("match")))

    return F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), of)).otherwise(F.array().cast(kind))


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """of(value), with value worked out once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def prefix(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of integers, what join makes of all before it, from 0 on.

    A fold copies what it has gathered at each step, so it runs over blocks of ``BLOCK`` values and then over the blocks."""
    none = F.array().cast("array<int>")

    def fold(own: Column, of: Callable[[Column], Column]) -> Column:
        return F.aggregate(own, F.struct(F.lit(0).alias("now"), none.alias("seen")), lambda acc, x: F.struct(join(acc["now"], of(x)).cast("int").alias("now"), F.concat(acc["seen"], F.array(acc["now"])).alias("seen")))

    def joined_blocks(folded: Column) -> Column:
        return let(fold(folded, lambda b: b["now"])["seen"], lambda before: F.flatten(F.transform(folded, lambda b, i: F.transform(b["seen"], lambda x: join(F.get(before, i), x).cast("int")))))

    def of_all(own: Column) -> Column:
        n = F.size(own)
        # F.slice copies the whole array each time, F.get doesn't
        blocks = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")), lambda b: F.transform(F.sequence(b * BLOCK, F.least(b * BLOCK + BLOCK, n) - 1), lambda i: F.get(own, i)))
        return F.when(n == 0, none).otherwise(let(F.transform(blocks, lambda b: fold(b, lambda x: x)), joined_blocks))

    return let(values, of_all)


def ratio(token: Column, table: Column) -> Column:
    """Log-likelihood ratio of a token, random against ordinary, a character."""
    codes = F.transform(F.split(token, ""), state)
    total = F.aggregate(codes, F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum")), lambda acc, c: F.struct(c.alias("last"), (acc["sum"] + F.when(acc["last"] < 0, 0.0).otherwise(F.element_at(table, acc["last"] * STATES + c + 1))).alias("sum")))
    return total["sum"] / (F.length(token) - 1)


def parts(token: Column, table: Column) -> Column:
    """array<struct<start,end>> of the parts of a token that look random, by a running sum of the ratio."""
    kind = "array<struct<start:int,end:int>>"
    codes = F.transform(F.split(token, ""), state)
    begin = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("i"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"), F.lit(0).alias("start"), F.lit(0).alias("end"), F.array().cast(kind).alias("found"))

    def ended(acc: Column) -> Column:
        return F.when(acc["best"] >= TOTAL, F.concat(acc["found"], F.array(F.struct(acc["start"].alias("start"), acc["end"].alias("end"))))).otherwise(acc["found"])

    def step(acc: Column, c: Column) -> Column:
        gain = F.when(acc["last"] < 0, 0.0).otherwise(F.element_at(table, acc["last"] * STATES + c + 1) - DRIFT)
        fresh = (acc["sum"] <= 0) | (acc["best"] - acc["sum"] > FALL)
        total = F.when(fresh, 0.0).otherwise(acc["sum"]) + gain
        best = F.when(fresh, 0.0).otherwise(acc["best"])
        return F.struct(
            c.alias("last"),
            (acc["i"] + 1).alias("i"),
            total.alias("sum"),
            F.greatest(total, best).alias("best"),
            F.when(fresh, F.greatest(acc["i"] - 1, F.lit(0))).otherwise(acc["start"]).alias("start"),
            F.when(total > best, acc["i"] + 1).otherwise(F.when(fresh, acc["i"]).otherwise(acc["end"])).alias("end"),
            F.when(fresh, ended(acc)).otherwise(acc["found"]).alias("found"),
        )

    found = F.filter(F.aggregate(codes, begin, step, ended), lambda s: F.substring(token, s["start"] + 1, s["end"] - s["start"]).rlike(MIXED))
    before = lambda s: F.length(F.regexp_extract(F.reverse(F.substring(token, F.lit(1), s["start"])), "^[A-Za-z0-9]*", 0))
    behind = lambda s: F.length(F.regexp_extract(F.substring(token, s["end"] + 1, F.length(token)), "^[A-Za-z0-9]*", 0))
    return F.array_distinct(F.transform(found, lambda s: F.struct((s["start"] - before(s)).alias("start"), (s["end"] + behind(s)).alias("end"))))


def random_spans(text: Column, table: Column) -> Column:
    """array<struct<start,end>> of runs that look random, or else of such parts of them."""

    def of(s: Column) -> Column:
        token = s["match"]
        whole = (F.length(token) >= WHOLE) & (ratio(token, table) >= PER_CHAR)
        some = F.transform(parts(token, table), lambda x: F.struct((s["start"] + x["start"]).alias("start"), (s["start"] + x["end"]).alias("end")))
        return F.when(whole, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))).when(token.rlike(MIXED), some).otherwise(F.array().cast("array<struct<start:int,end:int>>"))

    return F.flatten(F.transform(placed(text, TOKEN), of))


def annotate(docs: DataFrame, model: list[float] | None = None, text_col: str = "text") -> DataFrame:
    """docs with spans (array<struct<start,kind_no,end,kind>>, by start, then kind as in KINDS) added."""
    model = train(samples(docs.sparkSession)) if model is None else model
    table = F.split(F.lit(",".join(map(repr, model))), ",").cast("array<double>")
    docs, names = aside(docs, ["spans"])
    text = F.coalesce(col(names[text_col]), F.lit(""))

    def of(spans: Column, no: int) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(no).alias("kind_no"), s["end"].alias("end"), F.lit(KINDS[no]).alias("kind")))

    def free(spans: Column) -> Column:
        """Of sorted spans, those of the base and the markov ones that lie in none of these: none before them reaches so far."""
        reach = prefix(F.transform(spans, lambda s: F.when(s["kind_no"] == 3, 0).otherwise(s["end"])), F.greatest)
        return let(reach, lambda own: F.filter(spans, lambda s, i: (s["kind_no"] < 3) | (s["end"] > F.get(own, i))))

    assigned = F.filter(F.arrays_zip(placed(text, ASSIGN).alias("s"), F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(1)).alias("v")), lambda x: F.length(x["v"]) >= 8)
    found = F.concat(of(F.transform(assigned, lambda x: x["s"]), 0), of(placed(text, ACCESS), 1), of(placed(text, HEX), 2), of(random_spans(text, table), 3))
    return docs.withColumn("spans", let(F.array_sort(found), free))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def cut(pieces: Column, begin: Column, end: Column) -> Column:
    """Characters begin to end of a text that is given in pieces of ``PIECE`` characters: only those they lie in are read."""
    first = F.floor(begin / PIECE).cast("int")
    last = F.floor((end - 1) / PIECE).cast("int")
    own = F.array_join(F.transform(F.sequence(first, F.greatest(last, first)), lambda i: F.get(pieces, i)), "")
    return F.when(end > begin, F.substring(own, begin - first * PIECE + 1, end - begin)).otherwise("")


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """text with each group of overlapping spans replaced by one mark: what lies between groups is cut out and joined once."""

    def of(reach: Column) -> Column:
        groups = F.filter(F.arrays_zip(spans["start"].alias("start"), reach.alias("after")), lambda g: g["start"] >= g["after"])
        kept = F.concat(F.transform(groups, lambda g: F.struct(g["after"].alias("a"), g["start"].alias("b"))), F.array(F.struct(F.array_max(spans["end"]).alias("a"), F.length(text).alias("b"))))
        return let(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)), lambda pieces: F.array_join(F.transform(kept, lambda k: cut(pieces, k["a"], k["b"])), mark))

    return F.when(F.size(spans) == 0, text).otherwise(let(prefix(spans["end"], F.greatest), of))


def redact(docs: DataFrame, model: list[float] | None = None, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """docs with every span of text_col replaced; overlapping spans become one mark.  n_chars follows where there is one.  A null text stays null.  All columns stay."""
    new = "__foliomill_new"
    own, names = aside(docs, ["spans", new])
    text = names[text_col]
    out = annotate(own, model, text).withColumn(new, redacted(col(text), F.col("spans"), mark))
    changed = {text_col: col(new)}
    if "n_chars" in names and text_col != "n_chars":
        changed["n_chars"] = F.when(F.size("spans") == 0, F.col("n_chars")).otherwise(F.length(new).cast(docs.schema["n_chars"].dataType))
    return out.select(*(changed.get(c, col(renamed)).alias(c) for c, renamed in names.items()))
