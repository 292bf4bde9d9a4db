"""Creation of snapshot versions."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from firmament import schemas
from firmament.functions.dates import sheet_date
from firmament.functions.text import natural_key
from firmament.operators.identifiers import assign_ids
from firmament.operators.keys import require_columns, require_empty
from firmament.operators.lookups import with_lookup
from firmament.sources.sinks import append
from firmament.sources.tables import ROW, with_row_order

_UNIQUE = ("source_id", "fiscal_year", "snapshot_date", "_tag")


@dataclass
class NewSnapshots:
    unnumbered: DataFrame
    skipped: DataFrame  # configuration rows of an unknown source
    clashes: DataFrame  # unique keys that occur twice; any of them refuses the whole batch
    existing: DataFrame

    @cached_property
    def rows(self) -> DataFrame:
        """The new snapshots; ids are given when they are first asked for."""
        return assign_ids(self.unnumbered, "snapshot_id", ROW, self.existing).select(*schemas.SNAPSHOT.names)


def create_snapshots(versions: DataFrame, sources: DataFrame, existing: DataFrame, snapshot_date: str,
                     created_by: str = "Group_Member") -> NewSnapshots:
    """One snapshot per configuration row, all with the same date.

    Source, year, date and tag are unique together; an absent tag never clashes.
    """
    require_columns(versions, schemas.VERSION_SHEET)
    found = with_lookup(with_row_order(versions), "source_name", sources, "source_name", ["source_id"])
    known = found.filter("source_id IS NOT NULL").select(
        ROW,
        F.lit(snapshot_date).cast("date").alias("snapshot_date"),
        sheet_date(F.col("period_from")).alias("period_from"),
        sheet_date(F.col("period_to")).alias("period_to"),
        F.col("fiscal_year").cast("double").cast("int").alias("fiscal_year"),
        "source_id", "version_tag", F.lit(created_by).alias("created_by"),
    )
    same_day = existing.filter(F.col("snapshot_date") == F.lit(snapshot_date).cast("date"))
    columns = ("source_id", "fiscal_year", "snapshot_date", "version_tag")
    clashes = (
        known.select(*columns, F.lit(1).alias("_new"))
        .unionByName(same_day.select(*columns, F.lit(0).alias("_new")))
        .withColumn("_tag", natural_key(F.col("version_tag")))
        .filter("_tag IS NOT NULL")
        .groupBy(*_UNIQUE)
        .agg(F.count(F.lit(1)).alias("rows"), F.max("_new").alias("_new"), F.min(F.upper("version_tag")).alias("version_tag"))
        .filter("rows > 1 AND _new = 1")
        .select("source_id", "fiscal_year", "snapshot_date", "version_tag", "rows")
    )
    skipped = found.filter("source_id IS NULL").select(*schemas.VERSION_SHEET)
    return NewSnapshots(known, skipped, clashes, existing)


def store_snapshots(new: NewSnapshots, path: str) -> None:
    """Append the batch, or nothing of it when a key clashes."""
    require_empty(new.clashes, "snapshots exist already")
    append(new.rows, path)


def newest_by_year(snapshots: DataFrame, source_id, version_tag: str) -> DataFrame:
    """Snapshot to load into, per fiscal year: the newest of one source and tag."""
    newest = F.max(F.struct("snapshot_date", "snapshot_id"))
    return (
        snapshots.filter((F.col("source_id") == source_id)
                         & (natural_key(F.col("version_tag")) == natural_key(F.lit(version_tag))))
        .groupBy("fiscal_year").agg(newest.alias("n"))
        .select("fiscal_year", F.col("n.snapshot_id").alias("snapshot_id"))
    )
