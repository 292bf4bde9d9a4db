"""Load of the dimension tables: sources, exchanges, industries, firms."""

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession, functions as F

from firmament import schemas
from firmament.functions.text import empty_to_null, natural_key
from firmament.operators.identifiers import assign_ids
from firmament.operators.keys import require_columns
from firmament.operators.lookups import with_lookup
from firmament.operators.upsert import absent_rows, insert_if_absent
from firmament.operators.versions import first_rows
from firmament.sources.sinks import StagedBatch
from firmament.sources.tables import ROW, with_row_order


class NewDimensions(NamedTuple):
    """Rows to append to each table, and the firms left out for want of exchange or industry."""

    dim_data_source: DataFrame
    dim_exchange: DataFrame
    dim_industry_l2: DataFrame
    dim_firm: DataFrame
    rejected_firms: DataFrame


def _year(c: str):
    return F.col(c).try_cast("double").try_cast("int").alias(c)


def load_dimensions(companies: DataFrame, sources: DataFrame,
                    existing: dict[str, DataFrame]) -> NewDimensions:
    """New rows per dimension; the first spelling of a natural key wins and stored rows stay.

    ``existing`` holds the stored tables by name. Numbering writes the new rows of each table once, in order, to the shared folder.
    """
    require_columns(companies, schemas.COMPANY_SHEET)
    require_columns(sources, schemas.SOURCE_SHEET)
    companies, sources = with_row_order(companies), with_row_order(sources)

    source_rows = insert_if_absent(sources, existing["dim_data_source"], "source_name", ROW)
    new_sources = assign_ids(source_rows, "source_id", ROW, existing["dim_data_source"]).select(
        "source_id", *schemas.SOURCE_SHEET)

    coded = companies.filter(empty_to_null(F.col("exchange_code")).isNotNull())
    exchange_rows = insert_if_absent(
        coded.select("exchange_code", "exchange_name", ROW), existing["dim_exchange"], "exchange_code", ROW)
    new_exchanges = assign_ids(exchange_rows, "exchange_id", ROW, existing["dim_exchange"]).select(
        "exchange_id", "exchange_code", "exchange_name")

    named = companies.filter(empty_to_null(F.col("industry_l2_name")).isNotNull())
    industry_rows = insert_if_absent(
        named.select("industry_l2_name", ROW), existing["dim_industry_l2"], "industry_l2_name", ROW)
    new_industries = assign_ids(industry_rows, "industry_l2_id", ROW, existing["dim_industry_l2"]).select(
        "industry_l2_id", "industry_l2_name")

    status = F.col("status") if "status" in companies.columns else F.lit("active")
    unknown = absent_rows(
        companies.withColumn("_ticker", natural_key(F.col("ticker"))),
        existing["dim_firm"].select(natural_key(F.col("ticker")).alias("_ticker")), ("_ticker",))
    placed = with_lookup(
        with_lookup(unknown, "exchange_code", existing["dim_exchange"].select("exchange_id", "exchange_code")
                    .unionByName(new_exchanges.select("exchange_id", "exchange_code")),
                    "exchange_code", ["exchange_id"]),
        "industry_l2_name", existing["dim_industry_l2"].unionByName(new_industries),
        "industry_l2_name", ["industry_l2_id"])
    complete = F.col("exchange_id").isNotNull() & F.col("industry_l2_id").isNotNull()
    # The first complete row of a ticker is the one that gets in.
    firm_rows = first_rows(placed.filter(complete), ("_ticker",), F.col(ROW))
    new_firms = assign_ids(firm_rows, "firm_id", ROW, existing["dim_firm"]).select(
        "firm_id", "ticker", "company_name", "exchange_id", "industry_l2_id",
        _year("founded_year"), _year("listed_year"), status.alias("status"))
    rejected = placed.filter(~complete).select(
        "ticker", "exchange_code", "industry_l2_name",
        F.when(F.col("exchange_id").isNull(), "unknown exchange").otherwise("unknown industry").alias("reason"))
    return NewDimensions(new_sources, new_exchanges, new_industries, new_firms, rejected)


def broken_values(companies: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows a strict warehouse would refuse: unknown source type or status, or a key that is absent."""
    bad_source = sources.filter(
        F.col("source_name").isNull() | ~F.coalesce(F.col("source_type"), F.lit("")).isin(*schemas.SOURCE_TYPES)
    ).select(F.lit("source_info").alias("sheet"), F.col("source_name").alias("key"))
    bad_firm = F.col("ticker").isNull() | F.col("company_name").isNull()
    if "status" in companies.columns:
        bad_firm = bad_firm | ~F.coalesce(F.col("status"), F.lit("active")).isin(*schemas.FIRM_STATUSES)
    return bad_source.unionByName(
        companies.filter(bad_firm).select(F.lit("company_info").alias("sheet"), F.col("ticker").alias("key")))


def store_dimensions(new: NewDimensions, paths: dict[str, str], staging: str) -> None:
    """Stage all four tables, then add their rows. Firms go last, since they refer to the others.

    Nothing is added before all is staged, and ``StagedBatch.resume`` ends a publish that was cut off.
    """
    keys = {"dim_data_source": "source_id", "dim_exchange": "exchange_id", "dim_industry_l2": "industry_l2_id", "dim_firm": "firm_id"}
    batch = StagedBatch(new.dim_firm.sparkSession, staging)
    for table, key in keys.items():
        batch.stage(table, getattr(new, table), paths[table], (key,))
    batch.publish()


#: The dimension tables as they are stored.
TABLES = {"dim_data_source": schemas.DIM_SOURCE, "dim_exchange": schemas.DIM_EXCHANGE, "dim_industry_l2": schemas.DIM_INDUSTRY,
          "dim_firm": schemas.DIM_FIRM}


def stored_dimensions(spark: SparkSession, paths: dict[str, str], staging: str) -> dict[str, DataFrame]:
    """The dimension tables as they are before or after the load staged in ``staging``, never some of each."""
    return StagedBatch.tables(spark, staging, paths, {t: TABLES[t] for t in paths})
