"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space as the contracts define it, and its complement.
SPACE = r"\x20\x09-\x0D"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.  Where it is unset, a temporary one if driver and executors are one process, else an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="foliomill-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and a lost executor costs nothing that came before."""
    path = f"{shared_dir(df.sparkSession)}/foliomill-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.foliomill_path = path
    return back


def discard(df: DataFrame) -> None:
    """Delete a table that ``stored`` wrote and that nothing reads any more."""
    jvm, path = df.sparkSession._jvm, df.foliomill_path
    own = jvm.org.apache.hadoop.fs.Path(path)
    own.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(own, True)


def col(name: str) -> Column:
    """A top-level column, whatever marks its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def aside(docs: DataFrame, added: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """docs with each column that clashes with an added one (names differ in more than case) renamed by underscores at its end; and the new names of its columns."""
    taken = {a.lower() for a in added}
    names: dict[str, str] = {}
    used = {c.lower() for c in docs.columns} | taken
    for c in docs.columns:
        new = c
        if c.lower() in taken:
            while new.lower() in used:
                new += "_"
            used.add(new.lower())
        names[c] = new
    return docs.select(*(col(c).alias(new) for c, new in names.items())), names


def restored(out: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns that ``aside`` took, under their own names."""
    return out.select(*(col(new).alias(c) for c, new in names.items()))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound the Arrow batches of text columns: 512 rows at most, so long texts don't pile up in one buffer."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def grouped(docs: DataFrame, text_col: str, name: str, rows: int, size: int) -> DataFrame:
    """docs with a group (name) of up to ``rows`` rows and ``size`` bytes of text; only a text of more is a group of its own.

    Rows that follow each other and whose texts have as many bytes, up to a factor of two, are a group."""
    row, kind = "__foliomill_row", F.ceil(F.log2(F.octet_length(F.coalesce(col(text_col), F.lit(""))) + 1))
    most = F.least(F.lit(rows), F.greatest(F.lit(1), F.floor(F.lit(float(size)) / F.pow(F.lit(2.0), kind)))).cast("long")
    return docs.withColumn(row, F.monotonically_increasing_id()).withColumn(name, ((F.col(row) - F.col(row) % most) * 64 + kind).cast("long")).drop(row)


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case; a text of ASCII alone takes the short way."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of an Arrow column one by one, null as empty."""
    for x in column:
        yield x.as_py() or ""


def learned(doc_id: Column) -> Column:
    """True for rows that labels may be learned from: crc32 of the id as text, mod 5, is not 0; a null id never is."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 != 0, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % 5 == 0, F.lit(False))


def batches(rows: Iterable[dict[str, list]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for x in rows:
        yield pa.RecordBatch.from_pydict(x, schema=schema)
