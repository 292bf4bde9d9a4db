"""Latest rows, the panel, the quality frame and the published panel."""

from pyspark.sql import DataFrame, SparkSession

from catalogue.common import newest, with_tables
from firmament import schemas
from firmament.operators.versions import BY_ID, latest_rows
from firmament.plans import export, panel
from firmament.standins import FACTS, TestTables


def latest_financial(spark: SparkSession, sf: str) -> DataFrame:
    t = TestTables(spark, sf)
    rows = latest_rows(t.facts()["fact_financial_year"], t.snapshots())
    return rows.select("firm_id", "fiscal_year", "snapshot_id", "net_sales", "total_assets", "net_income")


def latest_by_id(spark: SparkSession, sf: str) -> DataFrame:
    rows = latest_rows(TestTables(spark, sf).facts()["fact_market_year"], policy=BY_ID)
    return rows.select("firm_id", "fiscal_year", "snapshot_id", "shares_outstanding", "share_price")


def latest_panel(spark: SparkSession, sf: str) -> DataFrame:
    t = TestTables(spark, sf)
    return panel.latest_panel(t.facts(), t.snapshots(), t.firms())


def qc_frame(spark: SparkSession, sf: str) -> DataFrame:
    t = TestTables(spark, sf)
    return panel.qc_frame(t.facts(), t.snapshots(), t.firms())


def export_panel(spark: SparkSession, sf: str) -> DataFrame:
    return export.published_panel(latest_panel(spark, sf)).orderBy("ticker", "fiscal_year")


QUERIES = {
    "latest_financial": latest_financial,
    "latest_by_id": latest_by_id,
    "latest_panel": latest_panel,
    "qc_frame": qc_frame,
    "export_panel": export_panel,
}

_KEYS = " UNION ".join(f"SELECT firm_id, fiscal_year FROM {t}" for t in FACTS)
_OWNER = {c: t for t, cols in schemas.PANEL_SOURCE.items() for c in cols}
PANEL_SELECT = (
    "SELECT k.firm_id, d.ticker, k.fiscal_year, "
    + ", ".join(f"l_{_OWNER[c]}.{c}" for c in schemas.PANEL_VARIABLES)
    + " {more} FROM k JOIN dim_firm d ON d.firm_id = k.firm_id "
    + " ".join(f"LEFT JOIN l_{t} ON l_{t}.firm_id = k.firm_id AND l_{t}.fiscal_year = k.fiscal_year" for t in FACTS)
    + " {joins}"
)
PANEL_TABLES = ("snapshot", "dim_firm", *FACTS)
PANEL_CTES = {"k": _KEYS, **{f"l_{t}": newest(t, cols) for t, cols in schemas.PANEL_SOURCE.items()}}
QC_CTES = {
    **PANEL_CTES,
    "m_id": newest("fact_market_year", ["share_price"], by_date=False),
    "i_id": newest("fact_innovation_year", ["evidence_note"], by_date=False),
}
QC_SELECT = PANEL_SELECT.format(
    more=", d.founded_year, m_id.share_price, i_id.evidence_note",
    joins="LEFT JOIN m_id ON m_id.firm_id = k.firm_id AND m_id.fiscal_year = k.fiscal_year "
          "LEFT JOIN i_id ON i_id.firm_id = k.firm_id AND i_id.fiscal_year = k.fiscal_year",
)
_PANEL = PANEL_SELECT.format(more="", joins="")

ORACLES = {
    "latest_financial": with_tables(
        newest("fact_financial_year", ["snapshot_id", "net_sales", "total_assets", "net_income"]),
        "snapshot", "fact_financial_year"),
    "latest_by_id": with_tables(
        newest("fact_market_year", ["snapshot_id", "shares_outstanding", "share_price"], by_date=False),
        "fact_market_year"),
    "latest_panel": with_tables(_PANEL, *PANEL_TABLES, **PANEL_CTES),
    "qc_frame": with_tables(QC_SELECT, *PANEL_TABLES, **QC_CTES),
    "export_panel": with_tables(
        "SELECT * FROM p WHERE upper(trim(ticker)) <> 'TEST' ORDER BY ticker, fiscal_year",
        *PANEL_TABLES, **PANEL_CTES, p=_PANEL),
}
