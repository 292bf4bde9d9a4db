"""Writers. Outputs are complete before anything a reader sees is replaced."""

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from firmament.operators.keys import RejectedBatch, text_cells


def overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Replace a whole table; an empty one keeps its columns."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Replace only the partitions ``df`` has rows for. Adaptive execution
    gives a partition as many tasks as its size asks for."""
    (
        df.hint("rebalance", *[F.col(c) for c in partition_by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def append(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str, order_by: tuple[str, ...], single_file: bool = False) -> None:
    """Headered CSV in key order, NULL keys last.

    The files are in order as well, so a large export needs no single file; ask for one only for
    reports small enough for one task.
    """
    ordered = df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by])
    if single_file:
        ordered = ordered.coalesce(1)
    ordered.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)


def write_sheet_csv(df: DataFrame, path: str) -> None:
    """A delivery table as text, blanks instead of NULLs; blanks at the ends of a cell stay."""
    text_cells(df).write.mode("overwrite").option("header", "true").option("escape", '"').option("emptyValue", "").option(
        "ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # no folder, or a write that never ended
            raise
        return False
    return True


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A stored table; one that was never written is empty. No footer is read for it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class StagedBatch:
    """Load of several tables that is staged whole before any of them changes, and can be taken up again.

    ``stage`` writes each result to the staging folder in the layout of its table, reading live tables but not
    touching them; an error up to here leaves everything as it was. ``publish`` first seals the batch with a manifest
    of its tables, in one write. From then on the batch is complete on disk: any process can ``resume`` a publish that
    was cut off, and running it again ends the same. Readers who must not see some tables new and some old
    resolve them by ``tables``: all old up to the seal, and all new from then on, however far the publish has come.

    A table is published by replacing the partitions its staged rows have, or, where it has a ``key``, by adding the
    rows whose key is not stored.
    """

    MANIFEST = "place int, table_name string, live_path string, partition_by array<string>, key array<string>, columns string"

    def __init__(self, spark: SparkSession, staging: str, partition_by: tuple[str, ...] = ("fiscal_year",)):
        self.spark, self.staging, self.partition_by = spark, staging.rstrip("/"), partition_by
        self._tables: list[tuple] = []
        if _exists(spark, f"{self.staging}/manifest"):
            raise RejectedBatch(f"{self.staging} holds a sealed batch; resume it or stage in another folder")

    def stage(self, table: str, df: DataFrame, live_path: str, key: tuple[str, ...] = ()) -> DataFrame:
        """Write ``df``; returns what was staged. A column ``_action`` is kept there but not published."""
        parts = () if key else self.partition_by
        if parts:
            df = df.hint("rebalance", *[F.col(c) for c in parts])
        overwrite(df, f"{self.staging}/tables/{table}", parts)
        self._tables.append((len(self._tables), table, live_path, list(parts), list(key), df.schema.json()))
        return self.spark.read.schema(df.schema).parquet(f"{self.staging}/tables/{table}")

    def seal(self) -> None:
        """From here on the batch is complete and ``resume`` publishes it."""
        self.spark.createDataFrame(self._tables, self.MANIFEST).coalesce(1).write.mode("overwrite").parquet(
            f"{self.staging}/manifest")

    def publish(self) -> None:
        self.seal()
        self.resume(self.spark, self.staging)

    @staticmethod
    def resume(spark: SparkSession, staging: str) -> None:
        """Publish a sealed batch, whether or not a part of it was published before."""
        staging = staging.rstrip("/")
        if not _exists(spark, f"{staging}/manifest"):
            raise RejectedBatch(f"{staging} holds no sealed batch; stage it again")
        manifest = spark.read.parquet(f"{staging}/manifest")
        for t in sorted(manifest.collect(), key=lambda r: r.place):  # one row per table
            columns = T.StructType.fromJson(json.loads(t.columns))
            staged = spark.read.schema(columns).parquet(f"{staging}/tables/{t.table_name}").drop("_action")
            if t.key:
                stored = read_table(spark, t.live_path, columns).select(*t.key).distinct()
                append(staged.join(stored, t.key, "left_anti"), t.live_path)
            else:
                staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                    *t.partition_by).parquet(t.live_path)
        overwrite(manifest.select("table_name"), f"{staging}/published")

    @staticmethod
    def tables(spark: SparkSession, staging: str, live: dict[str, str], schemas: dict[str, T.StructType]) -> dict[str, DataFrame]:
        """The tables with all of the batch or with nothing of it, whatever its publish has reached.

        The state is looked up once for all of them. Before the seal and after the publish they are the live folders. In
        between, the partitions that are staged stand for those of the live folder, whose others a publish never touches; to a table
        with a key the staged rows are added whose key is not stored, however many of them are there already. Partition values are
        listed, so the scans leave out what is being replaced.
        """
        staging = staging.rstrip("/")
        manifest = {}
        if _exists(spark, f"{staging}/manifest") and not StagedBatch.is_published(spark, staging):
            manifest = {t.table_name: t for t in spark.read.parquet(f"{staging}/manifest").collect()}
        out = {}
        for name, path in live.items():
            stored, t = read_table(spark, path, schemas[name]), manifest.get(name)
            if t is not None:
                staged = spark.read.schema(T.StructType.fromJson(json.loads(t.columns))).parquet(f"{staging}/tables/{name}").drop("_action")
                if t.key:
                    staged = staged.join(stored.select(*t.key).distinct(), t.key, "left_anti")
                else:
                    # One value for each partition of the table, such as its years.
                    values = staged.select(*t.partition_by).distinct().collect()
                    replaced = F.lit(False)
                    for v in values:
                        same = F.lit(True)
                        for c in t.partition_by:
                            same = same & F.col(c).eqNullSafe(F.lit(v[c]))
                        replaced = replaced | same
                    stored = stored.where(~replaced)
                stored = stored.unionByName(staged, allowMissingColumns=True)
            out[name] = stored
        return out

    @staticmethod
    def is_published(spark: SparkSession, staging: str) -> bool:
        return _exists(spark, f"{staging.rstrip('/')}/published")
