"""Incremental ingest as a file stream: what a folder has gained since the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def gained(spark: SparkSession, folder: str, schema: StructType, checkpoint: str, out: str, fmt: str = "parquet") -> DataFrame:
    """Read the files of folder that no earlier run with this checkpoint has seen, append them to out, and return out.

    Exactly once: the file source logs what it has read, the file sink what it has written."""
    stream = spark.readStream.schema(schema).format(fmt).load(folder)
    run = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(schema).parquet(out)
