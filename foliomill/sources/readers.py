"""Readers and writers with explicit schemas; missing optional files are empty tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE = "struct<numero:int,mode:string,confiance:double,caracteres:int,texte:string>"
DOCUMENT = f"fichier string, pages int, mode string, confiance_moyenne double, caracteres long, pages_faibles array<int>, relu boolean, detail array<{PAGE}>"
MANIFEST = "id string, titre string, date string, resume string, categorie string, documentUrl string, abroge boolean, tags array<string>"
CONTRIBUTION = "struct<titre:string,type:string,date:string,resume:string,source:string,fichier_origine:string,slug:string,abroge:boolean,tags:array<string>>"
RULE = "struct<page:int,avant:string,apres:string,remplacer_page:string>"
STATUS = "struct<par:string,par_slug:string>"
INDEX = "docs array<array<string>>, termes map<string,array<array<int>>>, longueurMoyenne int"
WORDS = "level int, page int, block int, par int, line int, word int, left int, top int, width int, height int, conf string, text string"


def optional(read: DataFrame | None, spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema) if read is None else read


def found(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame | None:
    """JSON of this schema, or None where there is no such path."""
    try:
        return spark.read.schema(schema).options(**options).json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """(ident, …): one row a JSON file, ident its stem, defaults in place of what is absent."""
    own = spark.read.schema(DOCUMENT).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder)
    ident = F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1)
    empty = F.array().cast(f"array<{PAGE}>")
    return own.select(
        F.url_decode(ident).alias("ident"), F.coalesce("pages", F.lit(0)).alias("pages"), F.coalesce("mode", F.lit("ocr")).alias("mode"), F.coalesce("confiance_moyenne", F.lit(0.0)).alias("confidence"),
        F.coalesce("pages_faibles", F.array().cast("array<int>")).alias("weak"), F.coalesce("relu", F.lit(False)).alias("proofread"), F.coalesce("detail", empty).alias("detail"),
    )


def pages(docs: DataFrame) -> DataFrame:
    """(doc, page, mode, confidence, chars, text) of every page."""
    rows = docs.select(F.col("ident").alias("doc"), F.explode("detail").alias("p"))
    return rows.select("doc", F.col("p.numero").alias("page"), F.col("p.mode").alias("mode"), F.col("p.confiance").alias("confidence"), F.col("p.caracteres").alias("chars"), F.coalesce("p.texte", F.lit("")).alias("text"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The items of a JSON array; of repeated ids the last stays; none without the file."""
    own = found(spark, path, MANIFEST, multiLine="true")
    if own is None:
        return spark.createDataFrame([], MANIFEST)
    from ..operators.metadata import last_of

    return last_of(own.withColumn("place", F.monotonically_increasing_id()), "id", "place")  # one file, one task: its order


def _mapped(spark: SparkSession, path: str, value: str, name: str) -> DataFrame:
    """(key, value) of a JSON object whose values have a type; keys with an underscore first, and other values, go."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], f"{name} string, value {value}")
    raw = text.select(F.explode(F.from_json("value", "map<string,string>")).alias(name, "raw"))
    opens = "[" if value.startswith("array") else "{"
    kept = raw.where(~F.col(name).startswith("_") & F.ltrim("raw").startswith(opens))
    return kept.select(name, F.from_json("raw", value).alias("value"))


def contributions(spark: SparkSession, path: str) -> DataFrame:
    return _mapped(spark, path, CONTRIBUTION, "ident").select("ident", "value.*")


def statuses(spark: SparkSession, path: str) -> DataFrame:
    return _mapped(spark, path, STATUS, "ident").select("ident", F.col("value.par").alias("by"), F.col("value.par_slug").alias("by_slug"))


def corrections(spark: SparkSession, path: str) -> DataFrame:
    """(doc, page, place, old, new, whole) of every rule, in file order."""
    rows = _mapped(spark, path, f"array<{RULE}>", "doc").select("doc", F.posexplode("value").alias("place", "r"))
    return rows.select("doc", F.col("r.page").alias("page"), "place", F.col("r.avant").alias("old"), F.col("r.apres").alias("new"), F.col("r.remplacer_page").alias("whole"))


def recognised_words(spark: SparkSession, path: str) -> DataFrame:
    """(page, block, par, line, word_no, conf, word) of a recogniser's TSV: level 5 with a word and a number for confidence."""
    own = spark.read.schema(WORDS).option("sep", "\t").option("header", True).option("quote", "").csv(path)
    conf = F.col("conf").try_cast("double")
    return own.where((F.col("level") == 5) & (F.trim("text") != "") & conf.isNotNull() & F.col("block").isNotNull()).select("page", "block", "par", "line", F.col("word").alias("word_no"), conf.alias("conf"), F.trim("text").alias("word"))


def site(spark: SparkSession, folder: str) -> DataFrame:
    """(page, html) of every index.html below folder."""
    own = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "index.html").text(folder, wholetext=True)
    return own.select(F.input_file_name().alias("page"), F.col("value").alias("html"))


def sitemap(spark: SparkSession, path: str) -> DataFrame:
    """(url) of every <loc>."""
    return spark.read.text(path, wholetext=True).select(F.explode(F.regexp_extract_all("value", F.lit("(?s)<loc>(.*?)</loc>"), F.lit(1))).alias("url"))


def search_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents, postings and one row of statistics of a search index in JSON, as ``operators.index`` has them; a malformed file is an error.

    Documents are (doc, slug, title, type, year, repealed, number, abstract, length), doc their place in the file.  The
    file is one object and so one row; what is to grow is kept by ``index.save``."""
    own = spark.read.schema(INDEX).option("multiLine", True).option("mode", "FAILFAST").json(path)
    at = lambda i: F.get("d", F.lit(i))
    docs = own.select(F.posexplode("docs").alias("doc", "d")).select(
        "doc", at(0).alias("slug"), at(1).alias("title"), at(2).alias("type"), at(3).alias("year"), (at(4) == "1").alias("repealed"), at(5).alias("number"), at(6).alias("abstract"),
        F.coalesce(at(7).try_cast("long"), F.lit(0)).alias("length"),
    )
    postings = own.select(F.explode("termes").alias("term", "list")).select("term", F.explode("list").alias("p")).select("term", F.get("p", F.lit(0)).alias("doc"), F.get("p", F.lit(1)).alias("tf"))
    stats = own.select(F.size("docs").cast("long").alias("n"), F.col("longueurMoyenne").cast("double").alias("average"))
    return docs, postings, stats


def texts(docs: DataFrame, wanted: DataFrame, key: str = "doc") -> DataFrame:
    """The rows of docs whose key is in wanted, each once however often it is asked for; null keys match none."""
    return docs.join(wanted.select(key), key, "left_semi")


def valid_pdfs(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of files that are not empty and begin as a PDF does."""
    own = spark.read.format("binaryFile").load(folder)
    return own.where((F.col("length") > 0) & (F.substring("content", 1, 4) == F.lit(b"%PDF"))).select("path", "length")


def write_documents(docs: DataFrame, folder: str) -> None:
    """One folder of JSON for each document, in its own partition."""
    docs.write.mode("overwrite").partitionBy("ident").json(folder)


def schema_of(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
