"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from firmament.session import scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage is cut and its size is known to the planner."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the bytes of a batch that Spark hands to a Python task, unless the session does; its bound on rows alone lets long texts add up."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) in (None, str(2**31 - 1)):
        spark.conf.set(name, str(8 << 20))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def is_held_out(doc_id: Column) -> Column:
    """One fifth of the ids, kept for measuring: crc32 of the id's text is divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def byte_texts(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each Arrow batch with its texts as UTF-8 bytes (None where null)."""
    for batch in batches:
        yield batch, batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()
