"""Dimensions, snapshots and fact loads."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue.cleaning import sheet_number_sql
from catalogue.common import with_tables
from firmament.operators.upsert import action_counts, insert_if_absent as absent
from firmament.plans import dimensions, facts, snapshots
from firmament.plans.standardise import standardise_panel
from firmament.standins import TestTables

COMPANIES = """
SELECT CASE WHEN c_custkey % 6 = 0 THEN concat('t', CAST(c_custkey - c_custkey % 4 AS VARCHAR), ' ')
            ELSE concat('T', CAST(c_custkey - c_custkey % 4 AS VARCHAR)) END AS ticker,
       c_name AS company_name,
       CASE c_custkey % 11 WHEN 0 THEN '' WHEN 1 THEN lower(c_mktsegment) WHEN 2 THEN replace(c_mktsegment, 'U', 'Ü') ELSE c_mktsegment END AS exchange_code,
       concat('Exchange ', c_mktsegment, ' ', CAST(c_custkey AS VARCHAR)) AS exchange_name,
       CASE WHEN c_custkey % 7 = 0 THEN NULL WHEN c_custkey % 5 = 2 THEN concat('Nátïon_', CAST(c_nationkey AS VARCHAR))
            ELSE concat('NATION_', CAST(c_nationkey AS VARCHAR)) END AS industry_l2_name,
       concat(CAST(1950 + c_custkey % 60 AS VARCHAR), '.0') AS founded_year,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(2000 + c_custkey % 20 AS VARCHAR) END AS listed_year,
       c_custkey AS _row
FROM customer
"""
SOURCES = """
SELECT DISTINCT concat('source ', o_orderstatus, ' ', substr(o_orderpriority, 1, 1)) AS source_name, 'market' AS source_type,
       o_orderstatus AS provider, CAST(NULL AS VARCHAR) AS note,
       CAST(ascii(o_orderstatus) * 10 + CAST(substr(o_orderpriority, 1, 1) AS INT) AS BIGINT) AS _row
FROM orders
"""
OLD = {
    "dim_exchange": "SELECT CAST(7 AS BIGINT) AS exchange_id, 'Machinery' AS exchange_code, 'old' AS exchange_name FROM region WHERE r_regionkey = 0",
    "dim_industry_l2": "SELECT CAST(n_nationkey + 1 AS BIGINT) AS industry_l2_id, n_name AS industry_l2_name FROM nation WHERE n_nationkey % 2 = 0",
    "dim_data_source": "SELECT CAST(3 AS BIGINT) AS source_id, 'SOURCE F 1' AS source_name, 'manual' AS source_type, '' AS provider, '' AS note FROM region WHERE r_regionkey = 0",
    "dim_firm": """SELECT c_custkey + 1 AS firm_id, concat('T', CAST(c_custkey AS VARCHAR)) AS ticker, c_name AS company_name,
        CAST(7 AS BIGINT) AS exchange_id, CAST(1 AS BIGINT) AS industry_l2_id, 1990 AS founded_year, 2000 AS listed_year,
        'active' AS status FROM customer WHERE c_custkey % 5 = 0""",
}
OLD_FROM = {"dim_exchange": "region", "dim_industry_l2": "nation", "dim_data_source": "region", "dim_firm": "customer"}
# Configuration of one snapshot per source and year; source 5 is unknown, source 4 has no tag.
VERSIONS = """
SELECT concat('s', CAST(pr AS VARCHAR)) AS source_name, concat(CAST(y AS VARCHAR), '.0') AS fiscal_year,
       concat(CAST(y AS VARCHAR), '-01-01') AS period_from,
       CASE WHEN pr = 3 THEN NULL ELSE concat(CAST(y AS VARCHAR), '-12-31 00:00:00') END AS period_to,
       CASE WHEN pr = 4 THEN NULL ELSE concat('v', CAST(pr AS VARCHAR)) END AS version_tag,
       CAST(y * 10 + pr AS BIGINT) AS _row
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y, CAST(substr(o_orderpriority, 1, 1) AS INT) AS pr FROM orders) t
"""
VERSION_SOURCES = """
SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) + 100 AS source_id,
       concat('S', substr(o_orderpriority, 1, 1)) AS source_name
FROM orders WHERE substr(o_orderpriority, 1, 1) <> '5'
"""
# Stored snapshots: other dates everywhere, the batch's date for even years.
OLD_SNAPSHOTS = """
SELECT snapshot_id, CASE WHEN fiscal_year % 2 = 0 THEN make_date(2026, 2, 1) ELSE snapshot_date END AS snapshot_date,
       fiscal_year, source_id + 100 AS source_id, upper(version_tag) AS version_tag
FROM ({}) s
"""
# A yearly batch: one row per order, some firm-years several times; the last row counts.
BATCH = """
SELECT CASE WHEN o_custkey % 200 = 0 THEN 'test' ELSE concat('t', lpad(CAST(o_custkey AS VARCHAR), 9, '0')) END AS ticker,
       CAST(year(o_orderdate) AS VARCHAR) AS fiscal_year,
       CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE concat(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), '.125') END AS net_sales,
       CAST(o_orderkey AS VARCHAR) AS total_assets, concat('0,', CAST(o_orderkey % 10 AS VARCHAR)) AS growth_ratio,
       '1.000.000' AS shares_outstanding, '10' AS share_price, '1 (x)' AS product_innovation,
       o_orderkey AS _row
FROM orders
"""


def _dimensions(spark: SparkSession, sf: str) -> dimensions.NewDimensions:
    t = TestTables(spark, sf)
    old = {name: t.sql(sql, OLD_FROM[name]) for name, sql in OLD.items()}
    return dimensions.load_dimensions(t.sql(COMPANIES, "customer"), t.sql(SOURCES, "orders"), old)


def load_dims(spark: SparkSession, sf: str) -> DataFrame:
    new = _dimensions(spark, sf)
    return (
        new.dim_data_source.select(F.lit("source").alias("dim"), F.col("source_id").alias("id"),
                                   F.col("source_name").alias("name"))
        .unionByName(new.dim_exchange.select(F.lit("exchange").alias("dim"), F.col("exchange_id").alias("id"),
                                             F.concat_ws("/", "exchange_code", "exchange_name").alias("name")))
        .unionByName(new.dim_industry_l2.select(F.lit("industry").alias("dim"), F.col("industry_l2_id").alias("id"),
                                                F.col("industry_l2_name").alias("name")))
    )


def load_firms(spark: SparkSession, sf: str) -> DataFrame:
    return _dimensions(spark, sf).dim_firm


def rejected_firms(spark: SparkSession, sf: str) -> DataFrame:
    return _dimensions(spark, sf).rejected_firms


def insert_if_absent(spark: SparkSession, sf: str) -> DataFrame:
    t = TestTables(spark, sf)
    new = t.sql(COMPANIES, "customer").filter("exchange_code <> ''")
    rows = absent(new, t.sql(OLD["dim_exchange"], "region"), "exchange_code", "_row")
    return rows.select("exchange_code", "exchange_name")


def _snapshots(spark: SparkSession, sf: str, day: str) -> snapshots.NewSnapshots:
    t = TestTables(spark, sf)
    old = t.snapshots().select(
        "snapshot_id",
        F.when(F.col("fiscal_year") % 2 == 0, F.lit("2026-02-01").cast("date")).otherwise(
            F.col("snapshot_date")).alias("snapshot_date"),
        "fiscal_year", (F.col("source_id") + 100).alias("source_id"), F.upper("version_tag").alias("version_tag"))
    return snapshots.create_snapshots(
        t.sql(VERSIONS, "orders"), t.sql(VERSION_SOURCES, "orders"), old, day)


def create_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshots(spark, sf, "2026-03-01").rows


def snapshot_clashes(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshots(spark, sf, "2026-02-01").clashes


def skipped_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    return _snapshots(spark, sf, "2026-03-01").skipped


def _resolved(spark: SparkSession, sf: str) -> DataFrame:
    t = TestTables(spark, sf)
    panel = standardise_panel(t.sql(BATCH, "orders"), keep=("_row",))
    sources = t.snapshots().select("source_id", F.concat(F.lit("s"), "source_id").alias("source_name")).distinct()
    return facts.resolve_batch(panel, t.firms(), sources, t.snapshots(), "S2", "V2")


def _upsert(spark: SparkSession, sf: str, table: str):
    stored = TestTables(spark, sf).facts()[table].withColumn(
        "created_at", F.lit("2020-01-01").cast("timestamp"))
    return facts.upsert_fact(stored, facts.fact_rows(_resolved(spark, sf), table), F.lit("2026-01-01").cast("timestamp"))


def load_facts_upsert(spark: SparkSession, sf: str) -> DataFrame:
    rows = _upsert(spark, sf, "fact_financial_year").table
    return rows.select("firm_id", "fiscal_year", "snapshot_id", "unit_scale", "currency_code", "net_sales", "total_assets",
                       "growth_ratio", "net_income", F.date_format("created_at", "yyyy-MM-dd").alias("created_at"))


def load_counters(spark: SparkSession, sf: str) -> DataFrame:
    return action_counts({t: _upsert(spark, sf, t).changes for t in ("fact_financial_year", "fact_innovation_year")})


def load_problems(spark: SparkSession, sf: str) -> DataFrame:
    t = TestTables(spark, sf)
    panel = standardise_panel(t.sql(BATCH, "orders"), keep=("_row",))
    firms = t.firms().filter("firm_id % 3 <> 0")
    sources = t.snapshots().select("source_id", F.concat(F.lit("s"), "source_id").alias("source_name")).distinct()
    snaps = t.snapshots().filter("fiscal_year % 4 <> 0")
    return facts.load_problems(panel, firms, sources, snaps, "s2", "v2")


QUERIES = {
    "load_dims": load_dims,
    "load_firms": load_firms,
    "rejected_firms": rejected_firms,
    "insert_if_absent": insert_if_absent,
    "create_snapshots": create_snapshots,
    "snapshot_clashes": snapshot_clashes,
    "skipped_snapshots": skipped_snapshots,
    "load_facts_upsert": load_facts_upsert,
    "load_counters": load_counters,
    "load_problems": load_problems,
}


def _key(c: str) -> str:
    """Natural keys agree whatever their case, accents and edge blanks."""
    return f"upper(strip_accents(trim({c})))"


def _absent(rows: str, key: str, old: str) -> str:
    """First row per natural key that the old table lacks."""
    return f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_key(key)} ORDER BY _row) AS first
        FROM {rows} WHERE {_key(key)} NOT IN (SELECT {_key(key)} FROM {old})) WHERE first = 1"""


_DIMS = {
    **{f"old_{n}": sql for n, sql in OLD.items()},
    "companies": COMPANIES,
    "sources": SOURCES,
    "exchanges": "SELECT 7 + row_number() OVER (ORDER BY _row) AS exchange_id, exchange_code, exchange_name FROM ("
    + _absent("(SELECT * FROM companies WHERE exchange_code <> '')", "exchange_code", "old_dim_exchange") + ")",
    "industries": "SELECT (SELECT max(industry_l2_id) FROM old_dim_industry_l2) + row_number() OVER (ORDER BY _row) AS industry_l2_id, "
    "industry_l2_name FROM (" + _absent("(SELECT * FROM companies WHERE industry_l2_name IS NOT NULL)", "industry_l2_name",
                                        "old_dim_industry_l2") + ")",
    "placed": f"""SELECT c.*, e.exchange_id, i.industry_l2_id FROM companies c
        LEFT JOIN (SELECT exchange_id, exchange_code FROM old_dim_exchange UNION ALL
                   SELECT exchange_id, exchange_code FROM exchanges) e ON {_key('e.exchange_code')} = {_key('c.exchange_code')}
        LEFT JOIN (SELECT * FROM old_dim_industry_l2 UNION ALL SELECT * FROM industries) i ON {_key('i.industry_l2_name')} = {_key('c.industry_l2_name')}
        WHERE upper(trim(c.ticker)) NOT IN (SELECT ticker FROM old_dim_firm)""",
}


def dims_sql(select: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in _DIMS.items()) + " " + select


NEWEST = """SELECT fiscal_year AS y, snapshot_id FROM (SELECT *, row_number() OVER (PARTITION BY fiscal_year
    ORDER BY snapshot_date DESC, snapshot_id DESC) AS rn FROM snapshot WHERE source_id = 2 AND upper(version_tag) = 'V2') WHERE rn = 1"""
LAST = f"""SELECT d.firm_id, CAST(b.fiscal_year AS INT) AS fiscal_year, n.snapshot_id,
        CAST({sheet_number_sql('b.net_sales')} AS DECIMAL(20,2)) AS net_sales,
        CAST({sheet_number_sql('b.total_assets')} AS DECIMAL(20,2)) AS total_assets,
        CAST({sheet_number_sql('b.growth_ratio')} AS DECIMAL(10,6)) AS growth_ratio,
        row_number() OVER (PARTITION BY d.firm_id, b.fiscal_year ORDER BY b._row DESC) AS rn
    FROM batch b JOIN dim_firm d ON upper(trim(b.ticker)) = upper(trim(d.ticker))
    JOIN newest n ON n.y = CAST(b.fiscal_year AS INT)"""
_CLASH = f"""SELECT source_id, fiscal_year, snapshot_date, upper(version_tag) AS version_tag, count(*) AS rows FROM (
        SELECT o.source_id, o.fiscal_year, o.snapshot_date, o.version_tag, 0 AS fresh FROM ({OLD_SNAPSHOTS.format('SELECT * FROM snapshot')}) o
            WHERE snapshot_date = DATE '2026-02-01'
        UNION ALL SELECT s.source_id, CAST(CAST(v.fiscal_year AS DOUBLE) AS INT), DATE '2026-02-01', v.version_tag, 1
            FROM ({VERSIONS}) v JOIN ({VERSION_SOURCES}) s ON upper(s.source_name) = upper(v.source_name)) u
    WHERE version_tag IS NOT NULL GROUP BY ALL HAVING count(*) > 1 AND max(fresh) = 1"""
_CLASH = _CLASH.replace("GROUP BY ALL", "GROUP BY source_id, fiscal_year, snapshot_date, upper(version_tag)")


def counters_sql(tables: tuple[str, ...], more: str = "") -> str:
    """Rows a batch inserts into and updates in each table; ``more`` columns may use both counts and ``{t}``."""
    return with_tables(" UNION ALL ".join(f"""
        SELECT '{t}' AS table_name, count(*) FILTER (WHERE f.firm_id IS NULL) AS inserted,
               count(*) FILTER (WHERE f.firm_id IS NOT NULL) AS updated{more.format(t=t)}
        FROM (SELECT * FROM last WHERE rn = 1) b LEFT JOIN {t} f ON f.firm_id = b.firm_id
            AND f.fiscal_year = b.fiscal_year AND f.snapshot_id = b.snapshot_id""" for t in tables),
        "snapshot", "dim_firm", *tables, batch=BATCH, newest=NEWEST, last=LAST)


ORACLES = {
    "load_dims": dims_sql("""
        SELECT 'source' AS dim, 3 + row_number() OVER (ORDER BY _row) AS id, source_name AS name FROM sources
            WHERE upper(source_name) <> 'SOURCE F 1'
        UNION ALL SELECT 'exchange', exchange_id, concat(exchange_code, '/', exchange_name) FROM exchanges
        UNION ALL SELECT 'industry', industry_l2_id, industry_l2_name FROM industries"""),
    "load_firms": dims_sql("""
        SELECT (SELECT max(firm_id) FROM old_dim_firm) + row_number() OVER (ORDER BY _row) AS firm_id, ticker, company_name,
               exchange_id, industry_l2_id, CAST(CAST(founded_year AS DOUBLE) AS INT) AS founded_year,
               CAST(listed_year AS INT) AS listed_year, 'active' AS status
        FROM (SELECT *, row_number() OVER (PARTITION BY upper(trim(ticker)) ORDER BY _row) AS first FROM placed
              WHERE exchange_id IS NOT NULL AND industry_l2_id IS NOT NULL) WHERE first = 1"""),
    "rejected_firms": dims_sql("""
        SELECT ticker, exchange_code, industry_l2_name,
               CASE WHEN exchange_id IS NULL THEN 'unknown exchange' ELSE 'unknown industry' END AS reason
        FROM placed WHERE exchange_id IS NULL OR industry_l2_id IS NULL"""),
    "insert_if_absent": dims_sql("SELECT exchange_code, exchange_name FROM exchanges"),
    "create_snapshots": with_tables(f"""
        SELECT (SELECT max(snapshot_id) FROM snapshot) + row_number() OVER (ORDER BY _row) AS snapshot_id,
               DATE '2026-03-01' AS snapshot_date, CAST(period_from AS DATE) AS period_from,
               CAST(CAST(period_to AS TIMESTAMP) AS DATE) AS period_to, CAST(CAST(fiscal_year AS DOUBLE) AS INT) AS fiscal_year,
               source_id, version_tag, 'Group_Member' AS created_by
        FROM ({VERSIONS}) v JOIN ({VERSION_SOURCES}) s ON upper(s.source_name) = upper(v.source_name)""", "snapshot"),
    "snapshot_clashes": with_tables(_CLASH, "snapshot"),
    "skipped_snapshots": f"""SELECT source_name, fiscal_year, period_from, period_to, version_tag FROM ({VERSIONS}) v
        WHERE source_name = 's5'""",
    "load_facts_upsert": with_tables("""
        SELECT firm_id, fiscal_year, snapshot_id, CAST(1 AS BIGINT) AS unit_scale, 'VND' AS currency_code,
               CASE WHEN b.rn = 1 THEN b.net_sales ELSE f.net_sales END AS net_sales,
               CASE WHEN b.rn = 1 THEN b.total_assets ELSE f.total_assets END AS total_assets,
               CASE WHEN b.rn = 1 THEN b.growth_ratio ELSE f.growth_ratio END AS growth_ratio,
               CASE WHEN b.rn IS NULL THEN f.net_income END AS net_income,
               CASE WHEN f.unit_scale IS NULL THEN '2026-01-01' ELSE '2020-01-01' END AS created_at
        FROM fact_financial_year f FULL JOIN (SELECT * FROM last WHERE rn = 1) b USING (firm_id, fiscal_year, snapshot_id)""",
        "snapshot", "dim_firm", "fact_financial_year", batch=BATCH, newest=NEWEST, last=LAST),
    "load_counters": counters_sql(("fact_financial_year", "fact_innovation_year")),
    "load_problems": with_tables("""
        SELECT DISTINCT 'unknown ticker' AS problem, upper(trim(ticker)) AS value FROM batch WHERE upper(trim(ticker)) NOT IN
            (SELECT ticker FROM dim_firm WHERE firm_id % 3 <> 0)
        UNION ALL SELECT DISTINCT 'no snapshot for year', fiscal_year FROM batch WHERE CAST(fiscal_year AS INT) % 4 = 0""",
        "snapshot", "dim_firm", batch=BATCH),
}
