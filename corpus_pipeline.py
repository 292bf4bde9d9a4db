"""Documents to training sequences in five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firmament.llm.common import materialised, table
from firmament.llm.decontamination import decontaminate
from firmament.llm.exact_dedup import exact_dedup
from firmament.llm.language_id import with_language
from firmament.llm.packing import pack
from firmament.llm.simhash import simhash_groups


def _free(docs: DataFrame, *names: str) -> list[str]:
    """Names that no column of the documents has, in any letter case."""
    taken = {c.lower() for c in docs.columns}
    return [next(n for n in (name + "_" * i for i in range(len(taken) + 1)) if n.lower() not in taken) for name in names]


def _without(docs: DataFrame, gone: DataFrame, key, name: str) -> DataFrame:
    """Documents whose ``key`` is not in ``gone.key``, which has no nulls.

    The rejects grow with the input, so they are never broadcast: both sides are dealt by key, at every size alike, and only
    the rejects' keys are hashed, which spares sorting the texts.
    """
    gone = materialised(gone.select("key").distinct(), name)
    (at,) = _free(docs, "_key")
    return docs.withColumn(at, key).join(gone.withColumnRenamed("key", at).hint("shuffle_hash"), at, "left_anti").select(*docs.columns)


def _numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The documents with a number of each row, written once so that it stays, and that column: null and repeated ids name no single row."""
    (row,) = _free(docs, "_row")
    return materialised(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what ``language_id`` calls ``und``: no text, no letter, or nothing to learn from."""
    return with_language(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts, exactly one stays: that with the largest id, of several the last; null ids come before all others."""
    numbered, row = _numbered(docs, "exact-rows")
    texts = numbered.select(F.struct(F.col("doc_id"), F.col(row).alias("row")).alias("place"), "text")
    rejected = exact_dedup(texts, id_col="place").where(~F.col("kept"))
    return _without(numbered, rejected.select(F.col("place.row").alias("key")), F.col(row), "exact-copies").drop(row)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with linked fingerprints, exactly one stays: that with the smallest id, of several the first; null ids come last.

    Rows are linked by their numbers, so those without id link and are linked like any other.
    """
    numbered, row = _numbered(docs, "near-rows")
    texts = numbered.select(F.col(row).alias("row"), "doc_id", "text")
    groups = simhash_groups(texts.select("row", "text"), id_col="row").select("row", "component_id").join(texts.select("row", "doc_id"), "row")
    groups = materialised(groups.select("row", "component_id", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("place")), "near-groups")
    stays = groups.groupBy("component_id").agg(F.min("place")["row"].alias("key"))
    rejected = groups.join(stays, F.col("row") == F.col("key"), "left_anti")
    return _without(numbered, rejected.select(F.col("row").alias("key")), F.col(row), "near-copies").drop(row)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the contamination rule marks."""
    rejected = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    return _without(docs, rejected.select(F.col("text_sha256").alias("key")), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256), "contaminated-docs")


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, with their sequence and place there."""
    return pack(docs)


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]
#: Language mixtures, fingerprints and tokens can't be expressed in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
