"""Rendering of values in messages and logs."""

from pyspark.sql import Column, functions as F


def decimal_text(c: Column) -> Column:
    """Decimal as a float prints: no padding zeros, but always one digit after the point."""
    t = F.regexp_replace(c.cast("string"), r"(\.\d*?)0+$", "$1")
    return (
        F.when(t.endswith("."), F.concat(t, F.lit("0")))
        .when(t.contains("."), t)
        .otherwise(F.concat(t, F.lit(".0")))
    )


def percent(ratio: Column) -> Column:
    return F.format_string("%.2f%%", ratio * 100)


def grouped(x: Column) -> Column:
    """Whole number with thousands separators, half-even."""
    return F.format_number(x, 0)


def sheet_text(c: Column) -> Column:
    """Double as sheet text: its shortest digits, never with an exponent; whole numbers without fraction."""
    whole, text = c.try_cast("decimal(38,0)"), c.cast("string")
    large, small = text.try_cast("decimal(38,18)"), text.try_cast("decimal(38,37)")
    plain = F.regexp_replace(F.when(F.abs(c) >= 1, large.cast("string")).otherwise(small.cast("string")), r"(\.\d*?)0+$", "$1")
    return (
        F.when(whole.cast("double") == c, whole.cast("string"))
        .when(text.contains("E") & plain.isNotNull(), plain)
        .otherwise(text)
    )
