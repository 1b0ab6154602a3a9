"""Numbering audits, confidence roll-ups and site checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def series(numbers: DataFrame) -> DataFrame:
    """numbers (doc, place, n) with series, from 1: a new one begins where n falls."""
    order = Window.partitionBy("doc").orderBy("place")
    falls = F.when(F.col("n") < F.lag("n").over(order), 1).otherwise(0)
    return numbers.withColumn("falls", falls).withColumn("series", (F.sum("falls").over(order) + 1).cast("int")).drop("falls")


def duplicates(numbered: DataFrame) -> DataFrame:
    """(doc, n): numbers that come twice in a series, once a document."""
    return numbered.groupBy("doc", "series", "n").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc", "n").distinct()


def missing(numbered: DataFrame) -> DataFrame:
    """(doc, series, n): numbers between a series' least and greatest that it lacks."""
    got = numbered.groupBy("doc", "series").agg(F.min("n").alias("a"), F.max("n").alias("b"), F.collect_set("n").alias("seen"))
    return got.select("doc", "series", F.explode(F.array_except(F.sequence("a", "b"), "seen")).alias("n"))


def missing_titles(titles: DataFrame, most: int = 20) -> DataFrame:
    """(doc, n): numbers from 1 to the greatest of a document's titles (doc, n) that it lacks; greater numbers than ``most`` are misread, and a single title makes no sequence."""
    got = titles.where(F.col("n").between(1, most)).groupBy("doc").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("b"), F.collect_set("n").alias("seen"))
    return got.where("k >= 2").select("doc", F.explode(F.array_except(F.sequence(F.lit(1).cast(titles.schema["n"].dataType), "b"), "seen")).alias("n"))


def bodiless(blocks: DataFrame) -> DataFrame:
    """Articles (doc, place) that a heading or nothing follows; blocks: doc, place, kind."""
    after = F.lead("kind").over(Window.partitionBy("doc").orderBy("place"))
    return blocks.withColumn("after", after).where((F.col("kind") == "article") & (F.col("after").isNull() | F.col("after").isin("titre", "section", "article"))).select("doc", "place")


def empty_pages(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    """(doc, page): pages 1 to n of docs (doc, pages) without a block."""
    every = docs.where("pages > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("pages").cast("int"))).alias("page"))
    return every.join(blocks.select("doc", F.col("page").cast("int").alias("page")).distinct(), ["doc", "page"], "left_anti")


def severity(docs: DataFrame, parts: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """docs (doc) with the count of each part and the weighted sum."""
    out = docs.select("doc")
    for name, (rows, _) in parts.items():
        out = out.join(rows.groupBy("doc").agg(F.count(F.lit(1)).alias(name)), "doc", "left")
    total = sum((F.coalesce(name, F.lit(0)) * w for name, (_, w) in parts.items()), F.lit(0))
    return out.select("doc", *[F.coalesce(n, F.lit(0)).alias(n) for n in parts], total.cast("long").alias("severity"))


def rollup(pages: DataFrame) -> DataFrame:
    """(doc, mode, confidence, chars, weak) from pages (doc, page, mode, confidence, chars): means over recognised pages only, 100 without one; bankers' rounding."""
    ocr = F.col("mode") == "ocr"
    return pages.groupBy("doc").agg(
        F.when(~F.bool_or(ocr), "natif").when(F.bool_and(ocr), "ocr").otherwise("mixte").alias("mode"),
        F.coalesce(F.bround(F.avg(F.when(ocr, F.col("confidence"))), 2), F.lit(100.0)).alias("confidence"),
        F.sum("chars").alias("chars"),
        F.count_if(ocr & (F.col("confidence") < 78.0)).alias("weak"),
    )


#: Fixed value: where the text of a page of texts stands.
TEXT_BODY = r'(?s)<div class="corps-texte"[^>]*>(.*?)\n  </div>'
LONG_TITLE, SHORT_BODY = 130, 200


def page_findings(pages: DataFrame, body: str = TEXT_BODY) -> DataFrame:
    """(page, level, rule) for each check that a page (page, html, is_text) fails; only pages of texts need a body."""
    # Patterns of a page's parts.
    titles, descriptions, canonical, heads = r"(?s)<title>(.*?)</title>", r'<meta name="description" content="([^"]*)"', r'<link rel="canonical" href="([^"]+)"', r"(?s)<h1[^>]*>.*?</h1>"
    tags = "<[^>]+>"
    part = lambda pattern: F.regexp_extract("html", pattern, 1)
    own = pages.select(
        "page",
        F.col("html").rlike(titles).alias("titled"), T.stripped(F.regexp_replace(part(titles), tags, "")).alias("title"),
        F.col("html").rlike(descriptions).alias("has_description"), T.stripped(part(descriptions)).alias("description"),
        F.col("html").rlike(canonical).alias("has_canonical"), F.regexp_count("html", F.lit(heads)).alias("heads"),
        "is_text", F.col("html").rlike(body).alias("has_body"), F.length(T.stripped(F.regexp_replace(part(body), tags, " "))).alias("body"),
    )
    c = F.col
    checks = [
        ("error", "no title", ~c("titled")), ("error", "empty title", c("titled") & (c("title") == "")), ("warning", "long title", F.length("title") > LONG_TITLE),
        ("error", "no description", ~c("has_description")), ("error", "empty description", c("has_description") & (c("description") == "")), ("error", "no canonical link", ~c("has_canonical")),
        ("error", "no h1", c("heads") == 0), ("warning", "several h1", c("heads") > 1), ("error", "no body", c("is_text") & ~c("has_body")), ("error", "short body", c("is_text") & (c("body") < SHORT_BODY)),
    ]
    return own.select("page", F.explode(F.array(*[F.when(bad, F.struct(F.lit(level).alias("level"), F.lit(rule).alias("rule"))) for level, rule, bad in checks])).alias("f")).where("f is not null").select("page", "f.*")


def linked_data_findings(pages: DataFrame) -> DataFrame:
    """(page, place, rule) of each JSON-LD block of a page (page, html) that isn't valid JSON or has no @context or no @type."""
    blocks = F.regexp_extract_all("html", F.lit(r'(?s)<script type="application/ld\+json">(.*?)</script>'), F.lit(1))
    own = pages.select("page", F.posexplode(blocks).alias("place", "block")).withColumn("v", F.try_parse_json("block"))
    member = lambda name: F.expr(f"""array_contains(json_object_keys(block), '{name}')""")
    rule = F.when(F.col("v").isNull(), "invalid").when(~F.coalesce(member("@context") & member("@type"), F.lit(False)), "no context or type")
    return own.select("page", "place", rule.alias("rule")).where("rule is not null")


def links(pages: DataFrame) -> DataFrame:
    """(page, link, kind): external, empty, pdf or internal, of every href and src."""
    link = F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)(?:href|src)="([^"]*)\""""), F.lit(1)))
    own = pages.select("page", link.alias("link"))
    path = F.regexp_replace("link", r"[?#].*$", "")
    kind = F.when(F.col("link").rlike(r"(?i)^(https?:|mailto:|data:|#)"), "external").when(path == "", "empty").when(F.lower(path).endswith(".pdf"), "pdf").otherwise("internal")
    return own.select("page", "link", kind.alias("kind"), path.alias("path"))


def resolved_path(folder: Column, path: Column) -> Column:
    """Where a link's path leads from a folder: percent signs decoded, . and .. followed, a folder meaning its index.html; without a leading slash."""
    plain = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    whole = F.when(F.startswith(plain, F.lit("/")), plain).otherwise(F.concat_ws("/", folder, plain))
    steps = F.filter(F.split(whole, "/", -1), lambda x: (x != "") & (x != "."))
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda acc, x: F.when(x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))))
    shown = F.array_join(kept, "/")
    return F.when(plain.endswith("/") | (shown == ""), F.when(shown == "", "index.html").otherwise(F.concat(shown, F.lit("/index.html")))).otherwise(shown)


def dead(found: DataFrame, targets: DataFrame) -> DataFrame:
    """Internal and pdf links (page, folder, link, kind, path) that lead to no target (path): a warning for a pdf, else an error."""
    own = found.where("kind in ('internal', 'pdf')").withColumn("path", resolved_path(F.col("folder"), F.col("path")))
    level = F.when(F.col("kind") == "pdf", "warning").otherwise("error")
    return own.join(targets.select("path").distinct(), "path", "left_anti").withColumn("level", level)


def repeated(urls: DataFrame) -> DataFrame:
    """(url, n) of urls (url) that come more than once: canonical links, or entries of a sitemap."""
    return urls.groupBy("url").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


#: Weights of the parts of a document's severity.
SEVERITY = {"missing": 3, "bodiless": 2, "missing_titles": 2, "duplicates": 1, "empty_pages": 1}


def severities(docs: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """severity() of the five parts of SEVERITY."""
    return severity(docs, {name: (parts[name], w) for name, w in SEVERITY.items()})


def worst(rated: DataFrame, most: int = 20) -> DataFrame:
    """The most severe documents (doc, severity), in document order among equals."""
    return rated.where("severity > 0").orderBy(F.desc("severity"), "doc").limit(most)


def totals(rated: DataFrame, residues: DataFrame) -> DataFrame:
    """One row: documents, those with an anomaly, those without, and all residues (doc, residues)."""
    hit = F.col("severity") > 0
    return rated.agg(F.count(F.lit(1)).alias("documents"), F.count_if(hit).alias("affected"), F.count_if(~hit).alias("sound")).crossJoin(residues.agg(F.coalesce(F.sum("residues"), F.lit(0)).alias("residues")))  # two single rows
