"""Typed panel rows from the all-text master sheet."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

from firmament import schemas
from firmament.functions.notes import combined_note, with_innovation
from firmament.functions.numbers import price_or_implied, sheet_numbers, whole_number
from firmament.functions.text import normal_ticker
from firmament.operators.keys import evaluated, require_columns

SHEET_VARIABLES = [
    *schemas.OWNERSHIP, *schemas.MARKET, *schemas.CASHFLOW, *schemas.FINANCIAL, *schemas.META,
]


def standardise_panel(sheet: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Numbers as doubles or whole numbers, innovation cells as flag and note, one projection.

    Accepts the sheet's column aliases; variables it lacks become NULL. Rows without ticker or
    year drop out. ``keep`` names further columns to pass through, such as the row order.
    """
    sheet = sheet.toDF(*[c.strip() for c in sheet.columns])
    require_columns(sheet, schemas.SHEET_KEY)
    sheet = sheet.withColumnsRenamed({a: c for a, c in schemas.SHEET_ALIASES.items() if a in sheet.columns})
    # Rows without a key drop out in the end; those whose cells are NULL need not be parsed for it.
    sheet = sheet.where("ticker IS NOT NULL AND fiscal_year IS NOT NULL")
    types = {f.name: f.dataType for f in sheet.schema}
    numbers = [c for c in ("fiscal_year", *SHEET_VARIABLES) if c in types]
    # Cells of columns that are numbers already are taken as they are.
    as_text = [c for c in numbers if not isinstance(types[c], T.NumericType)]

    def text(c: str) -> Column:
        return F.col(c).cast("string") if c in types else F.lit(None).cast("string")

    parsed = sheet.select(
        *keep,
        normal_ticker(F.col("ticker")).alias("ticker"),
        *[F.nullif(F.col(c).cast("double"), F.lit(float("nan"))).alias(c) for c in numbers if c not in as_text],
        sheet_numbers([text(c) for c in as_text]).alias("_numbers"),
        text("product_innovation").alias("product"),
        text("process_innovation").alias("process"),
    )
    # The rows without a key are dropped behind this, with the numbers parsed once.
    parsed = with_innovation(evaluated(parsed), {"product": F.col("product"), "process": F.col("process")})

    def number(c: str) -> Column:
        if c in as_text:
            return F.get("_numbers", F.lit(as_text.index(c)))
        return F.col(c) if c in numbers else F.lit(None).cast("double")

    rows = parsed.select(
        *keep,
        "ticker",
        whole_number(number("fiscal_year")).alias("fiscal_year"),
        *[(whole_number(number(c)) if c in schemas.WHOLE_NUMBER_VARIABLES else number(c)).alias(c)
          for c in SHEET_VARIABLES],
        F.col("product_flag").alias("product_innovation"),
        F.col("process_flag").alias("process_innovation"),
        combined_note(F.col("product_note"), F.col("process_note")).alias("evidence_note"),
    )
    implied = price_or_implied(F.col("share_price"), F.col("market_value_equity"), F.col("shares_outstanding"))
    return rows.na.drop(subset=list(schemas.SHEET_KEY)).withColumn("share_price", implied)
