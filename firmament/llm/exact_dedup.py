"""Exact dedup: frequent digests are found by Misra-Gries and settled on the map side, the rest by a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmament.llm.common import ascii_lower, materialised, table


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: float = 0.001) -> DataFrame:
    """One row per document with the document that stays of its group of equal texts.

    Texts are equal when identical after lower-casing A-Z; a null text is the empty text. The row with the largest id
    stays; null ids come before all others, and rows that repeat an id share its fate. An empty table gives no rows.
    Returns ``id_col, keep_id, group_size, kept, text_sha256``.

    ``support``: a digest with at least this share of all rows is a heavy hitter. Spark's Misra-Gries sketch
    (``freqItems``) names at most ``1 / support`` candidates and misses none; exact counts verify them. So the winners
    table has at most ``1 / support`` rows whatever the input, which bounds its broadcast. Groups below ``support`` are
    settled in one window over their digest.
    """
    text = ascii_lower(F.coalesce(F.col(text_col), F.lit("")))
    digests = materialised(docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest")), "digests")
    candidates = F.explode(F.col("digest_freqItems")).alias("digest")
    named = digests.freqItems(["digest"], support).select(candidates).distinct()
    rows = digests.count()
    winners = materialised(
        digests.join(F.broadcast(named), "digest", "left_semi")
        .groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max("id").alias("keep_id"))
        .where(F.col("group_size") >= support * rows), "winners")

    heavy = digests.join(F.broadcast(winners), "digest").select("id", "digest", "keep_id", "group_size")
    same = Window.partitionBy("digest")
    light = digests.join(F.broadcast(winners), "digest", "left_anti").select(
        "id", "digest", F.max("id").over(same).alias("keep_id"), F.count(F.lit(1)).over(same).alias("group_size"))
    return heavy.unionByName(light).select(
        F.col("id").alias(id_col), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def op6_exact_dedup(spark, folder: str) -> DataFrame:
    return exact_dedup(table(spark, folder, "documents"))


SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                           'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
