"""Audited corrections."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue.common import scratch, with_tables
from firmament import schemas
from firmament.operators.keys import text_cells
from firmament.plans import corrections
from firmament.standins import TestTables

# Reviewed findings: one per order, over two fact tables and all kinds of broken input.
FINDINGS = """
SELECT CASE WHEN k = 0 THEN 'test ' WHEN k % 37 = 0 THEN 'nobody'
            ELSE concat('T', lpad(CAST(k AS VARCHAR), 9, '0')) END AS ticker,
       CASE i % 19 WHEN 0 THEN concat(CAST(y AS VARCHAR), '-', CAST(y + 2 AS VARCHAR)) WHEN 1 THEN concat(CAST(y AS VARCHAR), '.0')
            ELSE CAST(y AS VARCHAR) END AS fiscal_year,
       CASE WHEN i % 23 = 0 THEN NULL WHEN i % 29 = 0 THEN 'dim_firm' WHEN i % 2 = 0 THEN 'fact_financial_year'
            ELSE 'fact_market_year' END AS table_name,
       CASE WHEN i % 31 = 0 THEN 'total_assets/net_sales' WHEN i % 41 = 0 THEN ' ' WHEN i % 43 = 0 THEN 'firm_age'
            WHEN i % 2 = 0 THEN CASE WHEN i % 4 = 0 THEN 'net_sales' ELSE 'growth_ratio' END
            ELSE CASE WHEN i % 3 = 0 THEN 'shares_outstanding' WHEN i % 5 = 0 THEN 'price_reference' ELSE 'share_price' END END AS column_name,
       'RULE' AS error_type, concat('finding ', CAST(i AS VARCHAR)) AS message, CAST(NULL AS VARCHAR) AS old_value,
       CASE i % 7 WHEN 0 THEN 'x' WHEN 1 THEN ' ' WHEN 2 THEN 'abc' WHEN 3 THEN concat(CAST(i AS VARCHAR), '.75')
            WHEN 4 THEN concat('-', CAST(i % 1000 AS VARCHAR)) WHEN 5 THEN 'None' ELSE CAST(i % 5000 AS VARCHAR) END AS new_value,
       i AS _row
FROM (SELECT o_orderkey AS i, o_custkey AS k, CAST(year(o_orderdate) AS INT) AS y FROM orders) o
"""
FIXED_TABLES = ("fact_financial_year", "fact_market_year")


def _placed(spark: SparkSession, sf: str) -> corrections.Corrections:
    t = TestTables(spark, sf)
    facts = t.facts()
    return corrections.settle_fixes(
        spark, t.sql(FINDINGS, "orders"), {n: facts[n] for n in FIXED_TABLES}, t.firms(), scratch(spark, "fixes"))


def fix_eligible(spark: SparkSession, sf: str) -> DataFrame:
    return corrections.eligible_fixes(TestTables(spark, sf).sql(FINDINGS, "orders"))


def rejected_fixes(spark: SparkSession, sf: str) -> DataFrame:
    return _placed(spark, sf).rejected.select("_row", "reason")


def apply_fixes(spark: SparkSession, sf: str) -> DataFrame:
    fact = TestTables(spark, sf).facts()["fact_market_year"]
    return corrections.corrected_fact(fact, "fact_market_year", _placed(spark, sf).accepted)


def override_log(spark: SparkSession, sf: str) -> DataFrame:
    log = corrections.override_log(_placed(spark, sf).accepted, "2026-01-01 00:00:00")
    return log.withColumn("changed_at", F.date_format("changed_at", "yyyy-MM-dd HH:mm:ss"))


def sync_master(spark: SparkSession, sf: str) -> DataFrame:
    t = TestTables(spark, sf)
    # A master sheet as it stands: every firm-year that has an order.
    firms = t.firms().select("firm_id", "ticker")
    years = t.table("orders").select(F.col("o_custkey").alias("firm_id"), F.year("o_orderdate").alias("y")).distinct()
    master = years.join(firms, "firm_id").select(
        F.when(F.col("firm_id") % 2 == 0, F.lower("ticker")).otherwise(F.col("ticker")).alias("ticker"),
        F.concat(F.col("y"), F.lit(".0")).alias("fiscal_year"), F.lit("kept").alias("net_sales"))
    return text_cells(corrections.sync_master(master, _placed(spark, sf).accepted))


QUERIES = {
    "fix_eligible": fix_eligible,
    "rejected_fixes": rejected_fixes,
    "apply_fixes": apply_fixes,
    "override_log": override_log,
    "sync_master": sync_master,
}

_TYPES = {f"{t}.{c}": d for t in schemas.FACT_COLUMNS for c, d in schemas.FACT_COLUMNS[t].items()}


def _typed() -> str:
    cases = []
    for place, dtype in _TYPES.items():
        name = dtype.simpleString().upper()
        if name == "STRING":
            value = "trim(new_value)"
        elif name in ("INT", "BIGINT"):
            value = f"CAST(TRY_CAST(trunc(TRY_CAST(new_value AS DOUBLE)) AS {name}) AS VARCHAR)"
        else:
            value = f"CAST(TRY_CAST(trim(new_value) AS {name}) AS VARCHAR)"
        cases.append(f"WHEN '{place}' THEN {value}")
    return f"CASE concat(table_name, '.', trim(column_name)) {' '.join(cases)} END"


_PLACES = ", ".join(f"'{p}'" for p in _TYPES)
_TABLES = ", ".join(f"'{t}'" for t in schemas.FACT_COLUMNS)
ELIGIBLE = f"""
SELECT _row, trim(ticker) AS ticker, y AS fiscal_year, table_name, trim(column_name) AS column_name,
       CASE WHEN lower(new_value) NOT IN ('none', 'nan', '', 'null', 'x') THEN typed END AS new_value, message,
       CASE WHEN table_name IS NULL THEN 'no table' WHEN regexp_matches(trim(column_name), '[/,; ]') THEN 'more than one column'
            WHEN trim(column_name) = '' THEN 'no column' WHEN y IS NULL THEN 'not a single year'
            WHEN trim(new_value) = '' THEN 'no new value' WHEN table_name NOT IN ({_TABLES}) THEN 'unknown table'
            WHEN concat(table_name, '.', trim(column_name)) NOT IN ({_PLACES}) THEN 'unknown column'
            WHEN lower(new_value) NOT IN ('none', 'nan', '', 'null', 'x') AND typed IS NULL
                THEN 'value does not fit the column' END AS reason
FROM (SELECT *, CAST(trunc(TRY_CAST(fiscal_year AS DOUBLE)) AS INT) AS y, {_typed()} AS typed FROM findings) t
"""


def _stored(table: str) -> str:
    cells = ", ".join(f"'{c}': CAST({c} AS VARCHAR)" for c in schemas.FACT_COLUMNS[table])
    return (f"SELECT '{table}' AS table_name, firm_id, fiscal_year, snapshot_id, MAP {{{cells}}} AS cells FROM {table} "
            "QUALIFY row_number() OVER (PARTITION BY firm_id, fiscal_year ORDER BY snapshot_id DESC) = 1")


_CTES = {
    "findings": FINDINGS,
    "eligible": ELIGIBLE,
    "stored": " UNION ALL ".join(f"SELECT * FROM ({_stored(t)})" for t in FIXED_TABLES),
    "placed": """SELECT e.*, d.firm_id, s.snapshot_id, s.cells[e.column_name] AS stored_value,
            CASE WHEN d.firm_id IS NULL THEN 'unknown ticker' WHEN s.snapshot_id IS NULL THEN 'no stored row' END AS why
        FROM (SELECT * FROM eligible WHERE reason IS NULL) e LEFT JOIN dim_firm d ON d.ticker = upper(e.ticker)
        LEFT JOIN stored s ON s.table_name = e.table_name AND s.firm_id = d.firm_id AND s.fiscal_year = e.fiscal_year""",
    "accepted": "SELECT * FROM placed WHERE why IS NULL",
    "final": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY table_name, column_name, firm_id, fiscal_year, snapshot_id
        ORDER BY _row DESC) AS rn FROM accepted) WHERE rn = 1""",
}


def _oracle(select: str) -> str:
    return with_tables(select, "dim_firm", *FIXED_TABLES, **_CTES)


def _fixed_cell(column: str, dtype) -> str:
    return (f"CASE WHEN x_{column}._row IS NOT NULL THEN CAST(x_{column}.new_value AS {dtype.simpleString()}) "
            f"ELSE f.{column} END AS {column}")


_MARKET = schemas.FACT_COLUMNS["fact_market_year"]
_FIXED = ("shares_outstanding", "price_reference", "share_price")


ORACLES = {
    "fix_eligible": _oracle("SELECT * FROM eligible"),
    "rejected_fixes": _oracle("""SELECT _row, reason FROM eligible WHERE reason IS NOT NULL
        UNION ALL SELECT _row, why FROM placed WHERE why IS NOT NULL"""),
    "apply_fixes": _oracle(
        "SELECT f.firm_id, f.fiscal_year, f.snapshot_id, "
        + ", ".join(_fixed_cell(c, d) if c in _FIXED else f"f.{c}" for c, d in _MARKET.items())
        + " FROM fact_market_year f "
        + " ".join(f"LEFT JOIN (SELECT * FROM final WHERE table_name = 'fact_market_year' AND column_name = '{c}') x_{c} "
                   f"ON x_{c}.firm_id = f.firm_id AND x_{c}.fiscal_year = f.fiscal_year AND x_{c}.snapshot_id = f.snapshot_id"
                   for c in _FIXED)),
    "override_log": _oracle("""
        SELECT row_number() OVER (ORDER BY _row) AS override_id, firm_id, fiscal_year, table_name, column_name,
               coalesce(CASE WHEN rn = 1 THEN stored_value ELSE before END, 'None') AS old_value,
               coalesce(new_value, 'None') AS new_value, message AS reason, 'Group_Member' AS changed_by,
               '2026-01-01 00:00:00' AS changed_at
        FROM (SELECT *, row_number() OVER w AS rn, lag(new_value) OVER w AS before FROM accepted
              WINDOW w AS (PARTITION BY table_name, column_name, firm_id, fiscal_year, snapshot_id ORDER BY _row))"""),
    "sync_master": _oracle("""
        SELECT CASE WHEN d.firm_id % 2 = 0 THEN lower(d.ticker) ELSE d.ticker END AS ticker, concat(y, '.0') AS fiscal_year,
               coalesce(CASE WHEN n.hit THEN n.new_value ELSE 'kept' END, '') AS net_sales,
               coalesce(g.new_value, '') AS growth_ratio, coalesce(s.new_value, '') AS shares_outstanding,
               coalesce(r.new_value, '') AS price_reference, coalesce(p.new_value, '') AS share_price
        FROM (SELECT DISTINCT o_custkey AS firm_id, year(o_orderdate) AS y FROM orders) t JOIN dim_firm d USING (firm_id) """
        + " ".join(f"""LEFT JOIN (SELECT firm_id, fiscal_year, true AS hit, new_value FROM final WHERE column_name = '{c}') {a}
            ON {a}.firm_id = d.firm_id AND {a}.fiscal_year = y"""
            for c, a in (("net_sales", "n"), ("growth_ratio", "g"), ("shares_outstanding", "s"),
                         ("price_reference", "r"), ("share_price", "p")))),
}
