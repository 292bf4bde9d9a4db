"""Newest version of a row, under the two rules the panel knows."""

from pyspark.sql import DataFrame, Window, functions as F

from firmament import schemas

BY_DATE = "by_date"  # snapshot date, then snapshot id
BY_ID = "by_id"  # snapshot id alone


def with_snapshot_date(fact: DataFrame, snapshots: DataFrame, how: str = "inner") -> DataFrame:
    # No broadcast hint: the snapshot table is small today, and the planner checks its size.
    return fact.join(snapshots.select("snapshot_id", "snapshot_date"), "snapshot_id", how)


def latest_rows(fact: DataFrame, snapshots: DataFrame | None = None, policy: str = BY_DATE,
                keys: tuple[str, ...] = schemas.FIRM_YEAR) -> DataFrame:
    """One row per firm-year: the newest snapshot's.

    Spark cuts each task's rows to the first per key before the shuffle (window group limit), so a
    firm-year with very many versions does not pile up in one task.
    """
    if policy == BY_DATE:
        fact = with_snapshot_date(fact, snapshots)
        newest_first = [F.col("snapshot_date").desc(), F.col("snapshot_id").desc()]
    else:
        newest_first = [F.col("snapshot_id").desc()]
    w = Window.partitionBy(*keys).orderBy(*newest_first)
    return fact.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def first_rows(df: DataFrame, keys: tuple[str, ...], *order) -> DataFrame:
    """One row per key, the first in ``order``; whole rows, no mixing of cells."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")
