"""Load of standardised panel rows into the six yearly fact tables."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from firmament import schemas
from firmament.functions.numbers import stored_as
from firmament.functions.text import natural_key
from firmament.operators.keys import RejectedBatch, require_empty
from firmament.operators.lookups import unknown_keys, with_lookup
from firmament.operators.upsert import Upsert, action_counts, upsert
from firmament.plans.snapshots import newest_by_year
from firmament.sources.sinks import StagedBatch, overwrite, read_table
from firmament.sources.tables import ROW, with_row_order


def source_id_of(sources: DataFrame, source_name: str) -> Column:
    """Id of a data source as a scalar subquery; NULL when there is no such source."""
    named = sources.filter(natural_key(F.col("source_name")) == natural_key(F.lit(source_name)))
    return named.agg(F.max("source_id")).scalar()


def resolve_batch(panel: DataFrame, firms: DataFrame, sources: DataFrame, snapshots: DataFrame,
                  source_name: str, version_tag: str, found: DataFrame | None = None) -> DataFrame:
    """Standardised rows with firm id and the snapshot of their year. ``found`` are the batch's ``ticker_firms``, where they are stored."""
    targets = newest_by_year(snapshots, source_id_of(sources, source_name), version_tag)
    if found is None:
        keyed = with_lookup(panel, "ticker", firms, "ticker", ["firm_id"], how="inner")
    else:
        keyed = panel.join(found.filter("_known").drop("_known"), "ticker")
    # One row per fiscal year, a small integer: at most some ten thousand rows of two numbers.
    return keyed.join(F.broadcast(targets), "fiscal_year")


def ticker_firms(panel: DataFrame, firms: DataFrame) -> DataFrame:
    """Each ticker of the batch as it is written there, with ``_known`` and the id of every firm it means.

    Steps that make the keys of a collation take some three times their CPU time in tasks of one process, so a stored batch
    asks for them once a ticker and not once a row.
    """
    known = firms.select("ticker", "firm_id", F.lit(True).alias("_known"))
    return with_lookup(panel.select("ticker").distinct(), "ticker", known.withColumnRenamed("ticker", "_name"), "_name", ["firm_id", "_known"])


def load_problems(panel: DataFrame, firms: DataFrame, sources: DataFrame, snapshots: DataFrame,
                  source_name: str, version_tag: str, unknown: DataFrame | None = None) -> DataFrame:
    """Everything that forbids loading the batch: unknown tickers, source, or years without snapshot.

    ``unknown`` are the distinct unknown tickers, where they have been found already.
    """
    targets = newest_by_year(snapshots, source_id_of(sources, source_name), version_tag)
    if unknown is None:
        unknown = unknown_keys(panel, "ticker", firms, "ticker")
    tickers = unknown.select(F.lit("unknown ticker").alias("problem"), F.col("ticker").alias("value"))
    years = panel.select("fiscal_year").distinct().join(targets, "fiscal_year", "left_anti").select(
        F.lit("no snapshot for year").alias("problem"), F.col("fiscal_year").cast("string").alias("value"))
    named = sources.filter(natural_key(F.col("source_name")) == natural_key(F.lit(source_name)))
    source = named.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
        F.lit("unknown source").alias("problem"), F.lit(source_name).alias("value"))
    return tickers.unionByName(years).unionByName(source)


#: Columns that a load fills alike in all rows, unless it is told otherwise.
FACT_CONSTANTS = {"currency_code": "VND", "unit_scale": 1, "price_reference": "close_year_end", "evidence_source_id": 6}


def fact_rows(resolved: DataFrame, table: str, **constants: str | int) -> DataFrame:
    """Rows of one fact table in storage types, with its constant columns (``FACT_CONSTANTS`` or ``constants``) and the row order."""
    unknown = set(constants) - set(FACT_CONSTANTS)
    if unknown:
        raise TypeError(f"no such constants: {sorted(unknown)}")
    filled = FACT_CONSTANTS | constants
    if filled["price_reference"] not in schemas.PRICE_REFERENCES:
        raise RejectedBatch(f"price reference {filled['price_reference']!r} is not one of {schemas.PRICE_REFERENCES}")
    constants = {c: F.lit(v) for c, v in filled.items()}
    columns = [
        constants[c].cast(t).alias(c) if c in constants else stored_as(F.col(c), t).alias(c)
        for c, t in schemas.FACT_COLUMNS[table].items() if c not in schemas.KEPT_ON_UPDATE
    ]
    return resolved.select(
        "firm_id", F.col("fiscal_year").cast("int").alias("fiscal_year"), "snapshot_id", *columns, ROW)


def upsert_fact(target: DataFrame, rows: DataFrame, loaded_at: Column | None = None,
                touched_only: bool = False) -> Upsert:
    """Upsert ``fact_rows`` into a fact table; repeated keys in the batch: the last row wins."""
    defaults = {"created_at": loaded_at} if loaded_at is not None else {}
    return upsert(target, rows, schemas.FACT_KEY, ROW, defaults,
                  touched="fiscal_year" if touched_only else None)


def load_facts(spark: SparkSession, panel: DataFrame, tables: dict[str, DataFrame], fact_paths: dict[str, str],
               staging: str, source_name: str, version_tag: str, loaded_at: str, **constants) -> DataFrame:
    """Check, stage and publish one batch into the six fact tables; returns the counts per table.

    ``tables`` holds dim_firm, dim_data_source and fact_data_snapshot. The standardised batch is
    written once, checked there and read by all six loads, each with its own columns; its tickers are looked up
    once each, and the counts are taken from what was staged. Only touched year partitions are rewritten; a table without a folder yet is
    begun. A publish that was cut off is taken up by ``StagedBatch.resume``, and ``stored_facts`` reads all old or all new.
    """
    batch = StagedBatch(spark, staging)
    overwrite(with_row_order(panel), f"{staging}/batch")
    panel = spark.read.parquet(f"{staging}/batch")
    lookups = (tables["dim_firm"], tables["dim_data_source"], tables["fact_data_snapshot"],
               source_name, version_tag)
    overwrite(ticker_firms(panel, tables["dim_firm"]), f"{staging}/tickers")
    found = spark.read.parquet(f"{staging}/tickers")
    overwrite(load_problems(panel, *lookups, unknown=found.filter("_known IS NULL")), f"{staging}/problems")
    require_empty(spark.read.parquet(f"{staging}/problems"), f"batch cannot be loaded, all problems are in {staging}/problems")
    overwrite(resolve_batch(panel, *lookups, found=found), f"{staging}/resolved")
    resolved = spark.read.parquet(f"{staging}/resolved")
    changes = {}
    for table, path in fact_paths.items():
        stored = read_table(spark, path, schemas.fact_schema(table))
        done = upsert_fact(stored, fact_rows(resolved, table, **constants),
                           F.lit(loaded_at).cast("timestamp"), touched_only=True)
        changes[table] = batch.stage(table, done.marked, path).filter("_action IS NOT NULL")
    counts = action_counts(changes)
    overwrite(counts, f"{staging}/counts")
    batch.publish()
    return spark.read.parquet(f"{staging}/counts")


def stored_facts(spark: SparkSession, fact_paths: dict[str, str], staging: str) -> dict[str, DataFrame]:
    """The fact tables as they are before or after the load staged in ``staging``, never some of each."""
    return StagedBatch.tables(spark, staging, fact_paths, {t: schemas.fact_schema(t) for t in fact_paths})
