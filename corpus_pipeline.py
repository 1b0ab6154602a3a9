"""The corpus pipeline: quality, near-duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor and
returns a DataFrame, which is written as Parquet and read again.  All but the
last return the columns of documents; the last returns token ids.

Nulls, empty and very long texts, repeated rows and extra columns are handled as
each operator's docstring states; an empty table passes through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliomill.llm import decontam, quality, secrets, simhash, spm
from foliomill.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.3 or more."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def no_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group of near-duplicates."""
    return simhash.keep_one(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark passages."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret in their texts replaced and n_chars to match."""
    return secrets.redact(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip): token ids, and whether they decode to the text."""
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    coded = spm.round_trip(docs.select("doc_id", F.col("text"), F.col("text").alias("copy")), path, text_col="copy")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.equal_null(F.coalesce("text", F.lit("")), "decoded").alias("round_trip"))


STAGES = [("quality", good_quality), ("near_duplicates", no_copies), ("decontamination", no_benchmark), ("secrets", no_secrets), ("sentencepiece", tokens)]

#: SQL can express neither the classifier nor the fingerprints nor the merges; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
