"""Latest-version panel and the frame the quality checks read."""

from pyspark.sql import Column, DataFrame, functions as F

from firmament import schemas
from firmament.operators.side_by_side import stacked
from firmament.operators.versions import with_snapshot_date


def _firm_years(facts: dict[str, DataFrame], snapshots: DataFrame,
                by_id: dict[str, tuple[str, ...]]) -> DataFrame:
    """Each fact's newest row beside the others', per firm-year.

    The facts are stacked first, so that snapshots are joined once. A row's version then goes before its payload: its
    snapshot's date and id, or for ``by_id`` the id alone.
    """
    parts = [(df, {table: F.struct(*dict.fromkeys((*schemas.PANEL_SOURCE[table], *by_id.get(table, ()))))})
             for table, df in ((t, facts[t]) for t in schemas.FACT_COLUMNS)]
    rows = with_snapshot_date(stacked(parts, (*schemas.FIRM_YEAR, "snapshot_id")), snapshots, "left")

    def newest(table: str, *version: str) -> Column:
        # Rows of unknown snapshots have no date and no payload, but still put their firm-year on the list.
        known = F.col(table).isNotNull() & F.col(version[0]).isNotNull()
        return F.max(F.when(known, F.struct(*version, F.col(table).alias("row"))))["row"]

    return rows.groupBy(*schemas.FIRM_YEAR).agg(
        *[newest(table, "snapshot_date", "snapshot_id").alias(table) for table in schemas.FACT_COLUMNS],
        *[newest(table, "snapshot_id").alias(f"{table}_by_id") for table in by_id])


def _variables() -> list[Column]:
    owner = {c: t for t, columns in schemas.PANEL_SOURCE.items() for c in columns}
    return [F.col(f"{owner[c]}.{c}").alias(c) for c in schemas.PANEL_VARIABLES]


def latest_panel(facts: dict[str, DataFrame], snapshots: DataFrame, firms: DataFrame) -> DataFrame:
    """One row per firm and fiscal year found in any fact, each fact by its newest snapshot.

    Newest is by snapshot date, then id, per fact. Firms must be known. A filter on firm or year
    put on the result reaches the scans.
    """
    rows = _firm_years(facts, snapshots, {})
    return rows.join(firms.select("firm_id", "ticker"), "firm_id").select(
        "firm_id", "ticker", "fiscal_year", *_variables()
    )


def qc_frame(facts: dict[str, DataFrame], snapshots: DataFrame, firms: DataFrame) -> DataFrame:
    """The panel with founding year, price and note; the last two by newest snapshot id.

    The id-ordered rows come out of the same pass as the panel.
    """
    extra = {"fact_market_year": ("share_price",), "fact_innovation_year": ("evidence_note",)}
    rows = _firm_years(facts, snapshots, extra)
    return rows.join(firms.select("firm_id", "ticker", "founded_year"), "firm_id").select(
        "firm_id", "ticker", "fiscal_year", *_variables(), "founded_year",
        F.col("fact_market_year_by_id.share_price").alias("share_price"),
        F.col("fact_innovation_year_by_id.evidence_note").alias("evidence_note"),
    )
