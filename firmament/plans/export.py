"""Delivery of the panel."""

from pyspark.sql import DataFrame, functions as F

from firmament import schemas
from firmament.functions.text import natural_key
from firmament.sources.sinks import export_csv


def published_panel(panel: DataFrame) -> DataFrame:
    """The panel without the firm reserved for tests."""
    return panel.filter(natural_key(F.col("ticker")) != schemas.RESERVED_TICKER)


def export_panel(panel: DataFrame, path: str) -> None:
    export_csv(published_panel(panel), path, schemas.SHEET_KEY)
