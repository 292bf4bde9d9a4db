"""Landed sheets, listings and dates; loads whose tables are read back through the manifest."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue import warehouse
from catalogue.cleaning import sheet_number_sql
from catalogue.common import by_document, scratch, with_tables
from catalogue.files import _published
from firmament import schemas
from firmament.functions.dates import sheet_date
from firmament.operators.identifiers import assign_ids
from firmament.operators.keys import RejectedBatch, require_columns
from firmament.plans import dimensions
from firmament.plans.facts import FACT_CONSTANTS
from firmament.sources import documents
from firmament.sources.sinks import overwrite, write_sheet_csv
from firmament.sources.tables import read_findings, read_sheet, read_sheets
from firmament.standins import FACTS, TestTables

# Suffixes of the landed files, by customer.
SUFFIXES = ("pdf", "PDF", "txt", "Pdf", "csv")
# Findings as a reviewer saves them: quoted line breaks, absent cells.
FINDINGS = """
SELECT concat('T', CAST(o_custkey AS VARCHAR)) AS ticker, CAST(year(o_orderdate) AS VARCHAR) AS fiscal_year, o_orderpriority AS column_name,
       o_orderstatus AS error_type, concat('line one', chr(10), '"', o_orderpriority, '", line two') AS message,
       CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) END AS new_value, o_orderkey
FROM orders
"""
SHEET = """
SELECT concat(' t', CAST(c_custkey AS VARCHAR)) AS ticker, CAST(2020 + c_custkey % 5 AS VARCHAR) AS fiscal_year,
       CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE concat('a "', c_mktsegment, '", b') END AS note FROM customer
"""
_Y, _M, _D = (f"CAST({f}(o_orderdate) AS VARCHAR)" for f in ("year", "month", "day"))
# A date in each of the accepted forms; with the day first where that cannot be a month.
DATES = f"""
SELECT o_orderkey, CASE o_orderkey % 9
    WHEN 0 THEN concat({_M}, '/', {_D}, '/', {_Y}) WHEN 1 THEN concat({_D}, '/', {_M}, '/', {_Y}) WHEN 2 THEN concat({_M}, '-', {_D}, '-', {_Y})
    WHEN 3 THEN concat({_D}, '-', {_M}, '-', {_Y}) WHEN 4 THEN concat({_Y}, '/', {_M}, '/', {_D})
    WHEN 5 THEN concat({_Y}, lpad({_M}, 2, '0'), lpad({_D}, 2, '0')) WHEN 6 THEN concat(' ', {_Y}, '-', lpad({_M}, 2, '0'), '-', lpad({_D}, 2, '0'), ' 10:30:00')
    WHEN 7 THEN '' ELSE concat(substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * CAST(month(o_orderdate) AS INT) - 2, 3), ' ', {_D}, ', ', {_Y}) END AS text
FROM orders
"""


def list_source_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Files with the suffix in any letter case, with their bytes; others are not listed and none is opened."""
    folder = scratch(spark, "listed")
    rows = TestTables(spark, sf).table("customer").select((F.col("c_custkey") % 5).alias("k"), F.floor(F.col("c_custkey") / 500).alias("doc"), F.lit("12345678").alias("line"))
    for i, suffix in enumerate(SUFFIXES):
        by_document(rows.where(F.col("k") == i).drop("k")).write.mode("append").partitionBy("doc").option("extension", suffix).csv(f"{folder}/k={i}")
    found = documents.list_pdfs(spark, folder)
    return found.select(F.regexp_extract("path", "k=([0-9]+)", 1).alias("k"), F.regexp_extract("path", "doc=([0-9]+)", 1).alias("doc"), (F.col("length") / 9).cast("long").alias("lines"))


def reviewed_findings(spark: SparkSession, sf: str) -> DataFrame:
    """Findings saved with a byte order mark, read back in their order."""
    path, names = scratch(spark, "findings"), schemas.FINDING.names
    given = TestTables(spark, sf).sql(FINDINGS, "orders")
    rows = given.select(*[F.col(c) if c in given.columns else F.lit(None).cast("string").alias(c) for c in names], "o_orderkey")
    rows = rows.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").drop("o_orderkey")
    rows.toDF(f"﻿{names[0]}", *names[1:]).write.option("header", "true").option("escape", '"').csv(path)
    back = assign_ids(read_findings(spark, path), "place", "_row")
    return back.select("ticker", "fiscal_year", "column_name", "error_type", "message", "new_value", "place")


def landed_sheets(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets landed as CSV and as parquet whose column names have edge blanks; all cells are text."""
    t, paths = TestTables(spark, sf), {"csv": scratch(spark, "sheet") + ".csv", "parquet": scratch(spark, "sheet")}
    sheet = t.sql(SHEET, "customer")
    write_sheet_csv(sheet.toDF(" ticker", "fiscal_year ", " note "), paths["csv"])
    overwrite(sheet.withColumn("fiscal_year", F.col("fiscal_year").cast("int")).toDF("ticker ", "fiscal_year", "note"), paths["parquet"])
    found = read_sheets(spark, paths)
    return found["csv"].withColumn("sheet", F.lit("csv")).unionByName(found["parquet"].withColumn("sheet", F.lit("parquet")))


def review_sheet_scan(spark: SparkSession, sf: str) -> DataFrame:
    """A sheet of a header only stays an empty table of its columns, and joins a full one."""
    sheet, paths = TestTables(spark, sf).sql(SHEET, "customer"), [scratch(spark, "review") + ".csv" for _ in range(2)]
    write_sheet_csv(sheet, paths[0])
    write_sheet_csv(sheet.where("false"), paths[1])
    full, none = (read_sheet(spark, p, ("ticker", "fiscal_year")) for p in paths)
    both = full.withColumn("sheet", F.lit("full")).unionByName(none.withColumn("sheet", F.lit("empty")))
    return both.groupBy("sheet", "fiscal_year").agg(F.count(F.lit(1)).alias("rows"), F.lit(",".join(none.columns)).alias("columns"))


def required_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Sheets with and without the key columns: what the check lets through, with its rows."""
    sheet, out = TestTables(spark, sf).sql(SHEET, "customer"), None
    for name, df in {"whole": sheet, "no ticker": sheet.drop("ticker"), "no year": sheet.drop("fiscal_year"), "neither": sheet.select("note")}.items():
        try:
            require_columns(df, schemas.SHEET_KEY)
            one = df.agg(F.count(F.lit(1)).alias("rows"))
        except RejectedBatch:
            one = df.agg(F.lit(None).cast("long").alias("rows"))
        one = one.select(F.lit(name).alias("sheet"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def sheet_dates(spark: SparkSession, sf: str) -> DataFrame:
    return TestTables(spark, sf).sql(DATES, "orders").select("o_orderkey", sheet_date(F.col("text")).alias("day"))


def load_fact_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Every cell of all six tables after the load of one batch; the cells of a row as one text."""
    out = None
    for name, rows in _published(spark, sf, list(FACTS))[1].items():
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in schemas.FACT_COLUMNS[name]]
        one = rows.select(F.lit(name).alias("table_name"), "firm_id", "fiscal_year", "snapshot_id", F.concat_ws("|", *cells).alias("cells"),
                          F.date_format("created_at", "yyyy-MM-dd").alias("created_at"))
        out = one if out is None else out.unionByName(one)
    return out


def load_dims_published(spark: SparkSession, sf: str) -> DataFrame:
    """All rows of the four dimension tables after a load over stored rows, read through the manifest; one table had no folder."""
    t, staging = TestTables(spark, sf), scratch(spark, "staging")
    paths = {name: scratch(spark, name) for name in dimensions.TABLES}
    for name in ("dim_exchange", "dim_industry_l2", "dim_firm"):
        overwrite(t.sql(warehouse.OLD[name], warehouse.OLD_FROM[name]), paths[name])
    existing = dimensions.stored_dimensions(spark, paths, staging)
    new = dimensions.load_dimensions(t.sql(warehouse.COMPANIES, "customer"), t.sql(warehouse.SOURCES, "orders"), existing)
    dimensions.store_dimensions(new, paths, staging)
    out = None
    for name, df in dimensions.stored_dimensions(spark, paths, staging).items():
        key, label = df.columns[0], df.columns[1]
        one = df.select(F.lit(name).alias("table_name"), F.col(key).alias("id"), F.col(label).alias("name"))
        out = one if out is None else out.unionByName(one)
    return out


QUERIES = {
    "list_source_documents": list_source_documents,
    "reviewed_findings": reviewed_findings,
    "landed_sheets": landed_sheets,
    "review_sheet_scan": review_sheet_scan,
    "required_columns": required_columns,
    "sheet_dates": sheet_dates,
    "load_fact_cells": load_fact_cells,
    "load_dims_published": load_dims_published,
}

# Cells that the batch gives, with what the load makes of them; others of its columns become NULL.
_GIVEN = {"net_sales": "b.net_sales", "total_assets": "b.total_assets", "growth_ratio": "b.growth_ratio", "shares_outstanding": f"CAST({sheet_number_sql("'1.000.000'")} AS BIGINT)",
          "share_price": "CAST(10 AS DECIMAL(20,4))", "product_innovation": "1", "evidence_note": "'Product: x'"}


def _cells(table: str) -> str:
    def cell(c: str) -> str:
        if c in schemas.KEPT_ON_UPDATE:
            return f"f.{c}"
        if c in FACT_CONSTANTS:
            value = FACT_CONSTANTS[c]
            return f"CASE WHEN b.rn = 1 THEN {value!r} ELSE f.{c} END"
        return f"CASE WHEN b.rn = 1 THEN {_GIVEN.get(c, 'NULL')} ELSE f.{c} END"
    listed = ", ".join(f"coalesce(CAST({cell(c)} AS VARCHAR), '~')" for c in schemas.FACT_COLUMNS[table])
    return f"""SELECT '{table}' AS table_name, firm_id, fiscal_year, snapshot_id, concat_ws('|', {listed}) AS cells,
        CASE WHEN f.present IS NULL THEN '2026-01-01' ELSE '2020-01-01' END AS created_at
        FROM (SELECT *, 1 AS present FROM {table}) f FULL JOIN (SELECT * FROM last WHERE rn = 1) b USING (firm_id, fiscal_year, snapshot_id)"""


ORACLES = {
    "list_source_documents": """SELECT CAST(c_custkey % 5 AS VARCHAR) AS k, CAST(c_custkey // 500 AS VARCHAR) AS doc, count(*) AS lines
        FROM customer WHERE c_custkey % 5 IN (0, 1, 3) GROUP BY 1, 2""",
    "reviewed_findings": f"SELECT * EXCLUDE (o_orderkey), row_number() OVER (ORDER BY o_orderkey) AS place FROM ({FINDINGS}) f",
    "landed_sheets": f"""SELECT ticker, fiscal_year, coalesce(note, '') AS note, 'csv' AS sheet FROM ({SHEET}) s
        UNION ALL SELECT ticker, fiscal_year, note, 'parquet' FROM ({SHEET}) s""",
    "review_sheet_scan": f"""SELECT 'full' AS sheet, fiscal_year, count(*) AS "rows", 'ticker,fiscal_year,note' AS "columns" FROM ({SHEET}) s GROUP BY fiscal_year""",
    "required_columns": """SELECT sheet, CASE WHEN sheet = 'whole' THEN n END AS "rows" FROM (SELECT count(*) AS n FROM customer) c,
        (VALUES ('whole'), ('no ticker'), ('no year'), ('neither')) v(sheet)""",
    "sheet_dates": """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 7 THEN NULL WHEN o_orderkey % 9 IN (1, 3) AND day(o_orderdate) <= 12
        THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) ELSE CAST(o_orderdate AS DATE) END AS day FROM orders""",
    "load_fact_cells": with_tables(" UNION ALL ".join(_cells(t) for t in FACTS), "snapshot", "dim_firm", *FACTS,
                                   batch=warehouse.BATCH, newest=warehouse.NEWEST, last=warehouse.LAST),
    "load_dims_published": warehouse.dims_sql("""
        SELECT 'dim_data_source' AS table_name, row_number() OVER (ORDER BY _row) AS id, source_name AS name FROM sources
        UNION ALL SELECT 'dim_exchange', exchange_id, exchange_code FROM (SELECT exchange_id, exchange_code FROM old_dim_exchange
            UNION ALL SELECT exchange_id, exchange_code FROM exchanges) e
        UNION ALL SELECT 'dim_industry_l2', industry_l2_id, industry_l2_name FROM (SELECT * FROM old_dim_industry_l2 UNION ALL SELECT * FROM industries) i
        UNION ALL SELECT 'dim_firm', firm_id, ticker FROM old_dim_firm
        UNION ALL SELECT 'dim_firm', (SELECT max(firm_id) FROM old_dim_firm) + row_number() OVER (ORDER BY _row), ticker
        FROM (SELECT *, row_number() OVER (PARTITION BY upper(trim(ticker)) ORDER BY _row) AS first FROM placed
              WHERE exchange_id IS NOT NULL AND industry_l2_id IS NOT NULL) WHERE first = 1"""),
}
