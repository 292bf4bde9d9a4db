"""Insert-if-absent and upsert on plain parquet tables, as joins."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from firmament.functions.text import natural_key
from firmament.operators.versions import first_rows


class Upsert(NamedTuple):
    table: DataFrame  # stored rows after the upsert
    changes: DataFrame  # the batch's rows with ``_action`` insert or update
    marked: DataFrame  # the table with ``_action``, NULL where the batch has no row; write it once to have both


def absent_rows(df: DataFrame, existing: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Rows whose key ``existing`` lacks. Its keys are made distinct first, so repeats cost nothing."""
    return df.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def insert_if_absent(new_rows: DataFrame, existing: DataFrame, key: str, arrival: str) -> DataFrame:
    """First row per natural key that is not stored yet."""
    keyed = new_rows.withColumn("_key", natural_key(F.col(key)))
    stored = existing.select(natural_key(F.col(key)).alias("_key"))
    return absent_rows(first_rows(keyed, ("_key",), F.col(arrival)), stored, ("_key",)).drop("_key")


def upsert(target: DataFrame, batch: DataFrame, keys: tuple[str, ...], arrival: str,
           defaults: dict[str, Column] | None = None, touched: str | None = None) -> Upsert:
    """Insert ``batch`` into ``target`` or overwrite every column the batch has, NULLs too.

    Repeated keys in the batch: the last by ``arrival`` wins. Columns only the target has keep
    their stored value; new rows get ``defaults`` for them. With ``touched`` the table holds only
    partitions (values of that column) the batch has rows for, which is what has to be rewritten.

    One full outer join: target and batch are read once, and the batch stays where its
    deduplication has put it. Keys are unique on both sides, so no key can be hot.
    """
    last = first_rows(batch, keys, F.col(arrival).desc()).drop(arrival).withColumn("_new", F.lit(True))
    if touched:
        # One row per partition value; prunes the scan of the target when it is partitioned by it.
        target = target.join(batch.select(touched).distinct(), touched, "left_semi")
    defaults = defaults or {}
    new, old = last.alias("new"), target.withColumn("_stored", F.lit(True)).alias("old")
    met = old.join(new, list(keys), "full_outer")
    is_new, is_stored = F.col("new._new").isNotNull(), F.col("old._stored").isNotNull()

    def cell(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c in last.columns:
            return F.when(is_new, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
        return F.when(is_stored, F.col(f"old.{c}")).otherwise(defaults.get(c, F.lit(None))).alias(c)

    columns = [*target.columns, *(c for c in last.columns if c not in target.columns and c != "_new")]
    action = F.when(is_stored, "update").otherwise("insert").alias("_action")
    return Upsert(
        met.select(*[cell(c) for c in columns]),
        met.filter(is_new).select(*[cell(c) for c in columns], action),
        met.select(*[cell(c) for c in columns], F.when(is_new, action).alias("_action")),
    )


def action_counts(changes: dict[str, DataFrame]) -> DataFrame:
    """Rows inserted and updated per table."""
    out = None
    for table, rows in changes.items():
        one = rows.agg(
            F.count_if(F.col("_action") == "insert").alias("inserted"),
            F.count_if(F.col("_action") == "update").alias("updated"),
        ).select(F.lit(table).alias("table_name"), "inserted", "updated")
        out = one if out is None else out.unionByName(one)
    return out
