"""Text normalisation and blank tests."""

from pyspark.sql import Column, functions as F

# Cell texts (lower case) that stand for "no value".
NULL_WORDS = ("", "-", "na", "n/a", "null", "none", "thiếu", "thieu", "nan")
TASK_BLANK_WORDS = ("", "nan", "none", "null")

# Characters cut off at the ends of a text; SQL trim alone only knows the space.
_BLANKS = "".join(chr(c) for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                   0x2028, 0x2029, 0x202F, 0x205F, 0x3000))


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(_BLANKS))


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def null_words_to_null(c: Column) -> Column:
    """Stripped text, or NULL where it is one of the words for a missing value."""
    s = strip(c)
    return F.when(~F.lower(s).isin(*NULL_WORDS), s)


def normal_ticker(c: Column) -> Column:
    """Stripped upper-case ticker; an empty one is NULL."""
    return empty_to_null(F.upper(strip(c.cast("string"))))


#: Natural keys are equal whatever their case and accents; letters with strokes are like plain ones in this collation.
KEY_COLLATION = "UNICODE_CI_AI"


def natural_key(c: Column) -> Column:
    """Form in which natural keys are compared: case, accents and edge blanks do not count.

    A collated text: joins, groups and comparisons follow the collation, by keys that are worked out once a row.
    """
    return F.collate(strip(c.cast("string")), KEY_COLLATION)


def is_blank(c: Column) -> Column:
    """Blank for the cell merge: NULL or nothing but blanks."""
    return c.isNull() | (strip(c.cast("string")) == "")


def is_missing(c: Column) -> Column:
    """Blank for the task list: also the words nan, none and null."""
    return c.isNull() | F.lower(strip(c.cast("string"))).isin(*TASK_BLANK_WORDS)


def filled(c: Column) -> Column:
    """The value when it is not blank, else NULL, for use in ``coalesce``."""
    return F.when(~is_blank(c), c)
