"""Number parsing. Two parsers exist on purpose: sheets and statements write numbers differently."""

from pyspark.sql import Column, functions as F, types as T

from firmament.functions.text import strip

_MIXED_UP = r"^(?=.*,).*\..*\.[^.,]*$|^(?=.*\.).*,.*,[^.,]*$"
_FLOAT_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def stripped_to_double(s: Column) -> Column:
    """Plain or scientific number text without blanks around it to double, anything else NULL.

    The pattern keeps out what a JVM cast would also take ("1d", "NaN").
    """
    return F.when(s.rlike(_FLOAT_TEXT), s.try_cast("double"))


def text_to_double(c: Column) -> Column:
    """``stripped_to_double`` of a cell as it comes."""
    return stripped_to_double(strip(c.cast("string")))


def number_characters(c: Column) -> Column:
    """What is left of a cell that can belong to a number; words for "no value" leave none."""
    return F.regexp_replace(c, r"[^\d\-+.,]", "")


def number_of_characters(s: Column) -> Column:
    """Number from ``number_characters``: the last separator is the decimal point, the others group.

    With both kinds present, the kind of the last one must not occur before; else there is no number.
    """
    one_dot = F.length(s) - F.length(F.replace(s, F.lit("."), F.lit(""))) <= 1
    point = F.replace(F.regexp_replace(s, r"[.,](?=.*[.,])", ""), F.lit(","), F.lit("."))
    # Most cells are plain numbers or empty, and need no pattern.
    return (
        F.when(s.isin("", "-"), F.lit(None).cast("double"))
        .when(one_dot & ~s.contains(","), s.try_cast("double"))
        .when(~s.rlike(_MIXED_UP), point.try_cast("double"))
    )


def sheet_number(c: Column) -> Column:
    """Number from a hand-filled cell, guessing which separator is the decimal one."""
    return number_of_characters(number_characters(c))


def sheet_numbers(cells: list[Column]) -> Column:
    """``sheet_number`` of many cells as an array; small code however many there are."""
    return F.transform(F.transform(F.array(*cells), number_characters), number_of_characters)


def whole_number(x: Column) -> Column:
    """Half-even rounding of a double to bigint; out of range is NULL."""
    return F.bround(x).try_cast("bigint")


def statement_number(c: Column) -> Column:
    """Number as financial statements print it: dots group digits, parentheses negate."""
    signed = F.when(c.contains("(") & c.contains(")"), F.replace(c, F.lit("("), F.lit("-"))).otherwise(c)
    return F.when(~c.isin("", "-"), F.regexp_replace(signed, r"[^\d\-]", "").try_cast("double"))


def year_truncated(c: Column) -> Column:
    """Year of an extraction row: numeric text cut to a whole number, else NULL."""
    return text_to_double(c).try_cast("int")


def year_strict(c: Column) -> Column:
    """Year of a sheet row: non-numeric text is NULL, a fraction stops the job."""
    y = text_to_double(c)
    return F.when(
        y != F.floor(y),
        F.raise_error(F.concat(F.lit("fiscal_year is not a whole number: "), c.cast("string"))),
    ).otherwise(y.try_cast("int"))


def stored_as(c: Column, dtype: T.DataType) -> Column:
    """Cast for storage; a value that does not fit stops the job, as a strict database would.

    Doubles go to decimals by half-up rounding. The cast stands once, as a decimal is costly to make.
    """
    out_of_range = F.raise_error(F.concat(F.lit(f"value out of range for {dtype.simpleString()}: "), c.cast("string")))
    return F.coalesce(c.try_cast(dtype), F.when(c.isNotNull(), out_of_range))


def relative_gap(a: Column, b: Column) -> Column:
    """``|a - b| / b`` on doubles, 0 where the base is 0; a negative base gives a negative ratio."""
    return F.when(b != 0, F.abs(a - b) / b).otherwise(F.lit(0.0))


def price_or_implied(price: Column, market_value: Column, shares: Column) -> Column:
    """Given price, else market value per share."""
    return F.coalesce(price, F.when(shares != 0, market_value / shares))
