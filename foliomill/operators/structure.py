"""Lines to typed blocks, paragraph fusion, anchors, page markers, list runs and rendering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# The forms of headings, articles and lists.
TITLE = r"(?iu)^\s*(TITRE|CHAPITRE|SOUS-TITRE|LIVRE)\s+([IVXLC]+|PREMIER|[0-9]+)\s*[:.\-–]?\s*(.*)$"
SECTION = r"(?iu)^\s*SECTION\s+([IVXLC]+|[0-9]+)\s*[:.\-–]?\s*(.*)$"
ARTICLE = r"(?iu)^\s*ART(?:ICLE|\.)\s*(premier|1\s*er|[0-9]+(?:\s*(?:bis|ter|quater))?)\s*[:.\-–)]?\s*(.*)$"
BULLET = r"^\s*[-–—•*·]\s+(.+)$"
NUMBERED = r"(?u)^\s*(\d{1,2}[.)°]|[a-z][.)])\s+(.+)$"
FOOTER = r"(?iu)^\s*(page\s+\d+(\s*/\s*\d+)?|\d{1,3}|[-–—\s]*\d+[-–—\s]*)\s*$"
# End of fixed values.
STRUCTURAL = "|".join(f"(?:{x})" for x in (TITLE, SECTION, ARTICLE, BULLET, NUMBERED))
SHORT, WIDTH = 45, 70
BLOCK = "struct<kind:string,text:string,mark:string>"


def kind(line: Column) -> Column:
    """titre, section, article, puce, numerote or paragraphe, in that order of precedence."""
    out = F.lit("paragraphe")
    for name, pattern in reversed((("titre", TITLE), ("section", SECTION), ("article", ARTICLE), ("puce", BULLET), ("numerote", NUMBERED))):
        out = F.when(line.rlike(pattern), name).otherwise(out)
    return out


def width(lines: Column) -> Column:
    """Upper median length of the lines that have more than 12 characters besides outer white space; 70 without one."""
    own = F.sort_array(F.transform(F.filter(lines, lambda x: F.length(T.stripped(x)) > 12), F.length))
    return F.coalesce(F.try_element_at(own, (F.size(own) / 2).cast("int") + 1), F.lit(WIDTH))


def ends_paragraph(line: Column, following: Column, wide: Column) -> Column:
    tail = T.stripped(line).rlike(r"[.;:!?»]$")
    return (T.stripped(following) == "") | F.when(tail, F.length(line) < wide * 0.85).otherwise(F.length(line) < wide * 0.55)


def blocks_of(page: Column) -> Column:
    """array<struct<kind,text,mark>> of one page's lines: a fold whose state is the blocks so far, the open paragraph, and what the next line may join."""
    lines = F.filter(F.transform(page, T.dotted_cleaned), lambda x: ~x.rlike(FOOTER))
    return F.transform(F.array(lines), _folded)[0]


def _folded(lines: Column) -> Column:
    wide_of = F.transform(F.array(width(lines)), lambda w: _fold(lines, w))
    return wide_of[0]


def _block(name: str, text: Column, mark: Column) -> Column:
    return F.struct(F.lit(name).alias("kind"), text.alias("text"), mark.alias("mark")).cast(BLOCK)


def _fold(lines: Column, wide: Column) -> Column:
    """taken: lines that an earlier line has absorbed; joins: '' or what the last block takes in (heading, puce)."""
    after = F.when(F.size(lines) == 0, F.array().cast("array<string>")).otherwise(F.concat(F.slice(lines, 2, F.size(lines)), F.array(F.lit(""))))
    pairs = F.zip_with(lines, after, lambda a, b: F.struct(a.alias("line"), b.alias("next")))
    start = F.struct(F.array().cast(f"array<{BLOCK}>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit("").alias("joins"))

    def closed(acc: Column) -> Column:
        text = F.array_join(acc["open"], " ")
        return F.when(F.size(acc["open"]) > 0, F.concat(acc["done"], F.array(_block("paragraphe", text, F.lit(""))))).otherwise(acc["done"])

    def state(done: Column, open_: Column, joins: Column) -> Column:
        return F.struct(done.alias("done"), open_.alias("open"), joins.alias("joins"))

    none = F.array().cast("array<string>")

    def last_with(acc: Column, more: Column) -> Column:
        last = F.element_at(acc["done"], -1)
        text = F.when(last["text"] == "", more).otherwise(F.concat_ws(" ", last["text"], more))
        return F.concat(F.slice(acc["done"], 1, F.size(acc["done"]) - 1), F.array(F.struct(last["kind"].alias("kind"), text.alias("text"), last["mark"].alias("mark")).cast(BLOCK)))

    def step(acc: Column, x: Column) -> Column:
        line, following = x["line"], x["next"]
        bare = T.stripped(line)
        group = lambda pattern, i: F.regexp_extract(line, pattern, i)
        absorbed = (acc["joins"] == "heading") & (bare != "") & (F.length(line) < wide)
        continued = (acc["joins"] == "puce") & (bare != "") & ~line.rlike(BULLET) & ~line.rlike(ARTICLE) & ~line.rlike(NUMBERED) & (F.length(line) >= wide * 0.5)
        put = lambda block, joins: state(F.concat(closed(acc), F.array(block)), none, joins)
        title = T.stripped(group(TITLE, 3))
        section = T.stripped(group(SECTION, 2))
        raw = F.regexp_replace(F.lower(T.stripped(group(ARTICLE, 1))), r"\s+", " ")
        number = F.when(raw.isin("premier", "1 er", "1er"), "premier").otherwise(raw)
        heading = lambda t: F.when(t == "", "heading").otherwise("")
        grown = F.concat(acc["open"], F.array(bare))
        return (
            F.when(absorbed, state(last_with(acc, bare), none, F.lit("")))
            .when(continued, state(last_with(acc, bare), none, F.lit("puce")))
            .when(bare == "", state(closed(acc), none, F.lit("")))
            .when(line.rlike(TITLE), put(_block("titre", title, F.concat_ws(" ", F.upper(group(TITLE, 1)), T.roman_repaired(group(TITLE, 2)))), heading(title)))
            .when(line.rlike(SECTION), put(_block("section", section, F.concat_ws(" ", F.lit("Section"), T.roman_repaired(group(SECTION, 1)))), heading(section)))
            .when(line.rlike(ARTICLE), put(_block("article", T.stripped(group(ARTICLE, 2)), F.concat_ws(" ", F.lit("Article"), number)), F.lit("")))
            .when(line.rlike(BULLET), put(_block("puce", group(BULLET, 1), F.lit("")), F.lit("puce")))
            .when(line.rlike(NUMBERED), put(_block("numerote", T.stripped(group(NUMBERED, 2)), group(NUMBERED, 1)), F.lit("")))
            .when(ends_paragraph(line, following, wide), state(F.concat(acc["done"], F.array(_block("paragraphe", F.array_join(grown, " "), F.lit("")))), none, F.lit("")))
            .otherwise(state(acc["done"], grown, F.lit("")))
        )

    return F.transform(F.array(F.aggregate(pairs, start, step)), closed)[0]


def structured(pages: DataFrame) -> DataFrame:
    """(doc, page, block_no, kind, text, mark) from pages (doc, page, text): no shuffle, a page is a row."""
    rows = pages.select("doc", "page", F.posexplode(blocks_of(F.split(F.coalesce("text", F.lit("")), "\n", -1))).alias("block_no", "b"))
    return rows.select("doc", "page", "block_no", "b.*")


def fused(blocks: DataFrame) -> DataFrame:
    """Short paragraphs joined to the paragraph before, unless that ends with . ; or : — across pages; the first page stays."""
    order = Window.partitionBy("doc").orderBy("page", "block_no")
    before = F.lag(F.struct("kind", "text")).over(order)
    joins = F.coalesce((F.col("kind") == "paragraphe") & (F.length("text") < SHORT) & (before["kind"] == "paragraphe") & ~T.stripped(before["text"]).rlike("[.;:]$"), F.lit(False))
    runs = blocks.withColumn("begins", (~joins).cast("int")).withColumn("run", F.sum("begins").over(order))
    part = F.array_sort(F.collect_list(F.struct("page", "block_no", "text", "kind", "mark")))
    got = runs.groupBy("doc", "run").agg(part.alias("p"))
    return got.select("doc", F.col("run").cast("int").alias("block_no"), F.get("p", 0)["page"].alias("page"), F.get("p", 0)["kind"].alias("kind"), F.array_join("p.text", " ").alias("text"), F.get("p", 0)["mark"].alias("mark"))


def anchors(heads: DataFrame) -> DataFrame:
    """heads (doc, place, mark) with an anchor that is unique in its document: the slug of the mark, numbered from its second use on."""
    base = T.slug(F.col("mark"))
    own = heads.withColumn("base", F.when(base == "", "section").otherwise(base))
    n = F.row_number().over(Window.partitionBy("doc", "base").orderBy("place"))
    return own.withColumn("n", n).withColumn("anchor", F.when(F.col("n") == 1, F.col("base")).otherwise(F.concat_ws("-", "base", F.col("n").cast("string")))).drop("base", "n")


def page_markers(blocks: DataFrame) -> DataFrame:
    """blocks (doc, place, page) with marker: the block is the first of a page that isn't 0 and isn't the last such page before."""
    seen = F.last(F.nullif("page", F.lit(0)), ignorenulls=True).over(Window.partitionBy("doc").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    return blocks.withColumn("marker", F.coalesce((F.col("page") != 0) & (F.coalesce(seen, F.lit(0)) != F.col("page")), F.lit(False)))


def list_runs(blocks: DataFrame) -> DataFrame:
    """(doc, run, kind, first, items): runs of list items of one kind, broken by other blocks and by page markers; blocks: doc, place, kind, marker."""
    order = Window.partitionBy("doc").orderBy("place")
    item = F.col("kind").isin("puce", "numerote")
    new = F.when(item & (F.lag("kind").over(order) == F.col("kind")) & ~F.col("marker"), 0).otherwise(1)
    return blocks.withColumn("run", F.sum(new).over(order)).where(item).groupBy("doc", "run", "kind").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("items")).drop("run")


def plain(blocks: DataFrame) -> DataFrame:
    """(doc, text): blocks joined by blank lines, marks before a dash."""
    shown = F.when(F.col("mark") != "", F.concat_ws(" — ", "mark", "text")).otherwise(F.col("text"))
    part = F.array_sort(F.collect_list(F.struct("block_no", shown.alias("shown"))))
    return blocks.groupBy("doc").agg(part.alias("p")).select("doc", F.array_join("p.shown", "\n\n").alias("text"))
