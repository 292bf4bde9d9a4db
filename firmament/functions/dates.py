"""Dates from sheets."""

from pyspark.sql import Column, functions as F

from firmament.functions.text import empty_to_null, strip


#: Accepted forms besides ISO, in order of preference.
_FORMS = ("M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "d-M-yyyy", "yyyy/M/d", "MMM d, yyyy", "d MMM yyyy", "yyyyMMdd", "M/d/yy", "d/M/yy")


def sheet_date(c: Column) -> Column:
    """Date of a sheet cell; NULL when absent, and a text that is no date stops the job.

    Dates with slashes or dashes are month first unless that is impossible. Years of two digits are of this century.
    """
    text = empty_to_null(strip(c.cast("string")))
    day = F.coalesce(
        text.try_cast("date"),
        text.try_cast("timestamp").cast("date"),
        *[F.try_to_date(text, form) for form in _FORMS],
    )
    return F.when(
        text.isNotNull() & day.isNull(), F.raise_error(F.concat(F.lit("not a date: "), text))
    ).otherwise(day)


def iso_day(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
