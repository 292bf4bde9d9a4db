"""Key columns, column order and checks on table shapes."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F, types as T

from firmament.functions.numbers import year_strict
from firmament.functions.rendering import sheet_text
from firmament.functions.text import normal_ticker


class KeyColumns(NamedTuple):
    ticker: str
    year: str


class RejectedBatch(ValueError):
    """A check failed, so nothing of the batch may be stored."""


#: What each part of the key may be called, best first. The first is also the name if there is none of them.
_KEY_NAMES = KeyColumns(("company", "ticker"), ("year", "fiscal_year"))
_NO_COLUMNS = KeyColumns("ticker", "fiscal_year")


def key_columns(df: DataFrame, empty: bool = False) -> KeyColumns:
    """Names of the key columns of a review sheet, as they are written there (edge blanks aside).

    A sheet without rows has the default names whatever its columns. Looking for a row would run the plan behind ``df``, so
    the caller tells; the jobs here pass over sheets without rows before they ask.
    """
    written = {c.strip(): c for c in df.columns}
    if empty or not written:
        return _NO_COLUMNS

    def best(names: tuple[str, ...]) -> str:
        present = sorted(set(names) & set(written), key=names.index)
        return written[present[0]] if present else names[0]

    return KeyColumns(*map(best, _KEY_NAMES))


def require_columns(df: DataFrame, columns: tuple[str, ...]) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise RejectedBatch(f"columns {missing} are required")


def require_empty(df: DataFrame, message: str, shown: int = 20) -> None:
    """Run the check ``df`` describes; the batch is rejected if it finds any row."""
    offending = df.limit(shown).collect()
    if offending:
        raise RejectedBatch(f"{message}: {[tuple(r) for r in offending]}")


def sheet_keys(df: DataFrame, key: KeyColumns | None = None) -> DataFrame:
    """Normalise the key of a review sheet and drop rows without one."""
    key = key or key_columns(df)
    return (
        df.withColumn(key.ticker, normal_ticker(F.col(key.ticker)))
        .withColumn(key.year, year_strict(F.col(key.year)))
        .na.drop(subset=[key.ticker, key.year])
    )


def without_helpers(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop working columns, whose names start with an underscore."""
    return df.drop(*[c for c in df.columns if c.startswith("_") and c not in keep])


def keys_first(df: DataFrame, keys: tuple[str, ...], sort_rest: bool = True) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    names = [c for c in keys if c in df.columns] + (sorted(rest) if sort_rest else rest)
    return df.select(*[F.col(f"`{c}`") for c in names])


def ordered(df: DataFrame, *columns: str) -> DataFrame:
    """Delivery order: ascending, missing keys last."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in columns])


def text_cells(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """All cells as text with blanks for NULL, as sheets hold them."""

    def cell(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if f.name in keep:
            return c
        text = sheet_text(c) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c.cast("string")
        return F.coalesce(text, F.lit("")).alias(f.name)

    return df.select(*[cell(f) for f in df.schema])


def with_columns_of(df: DataFrame, fields: dict[str, T.DataType]) -> DataFrame:
    """Add the columns of ``fields`` that ``df`` lacks, as NULL."""
    absent = {c: F.lit(None).cast(t) for c, t in fields.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def union_by_name(frames: list[DataFrame], fill: str | None = None) -> DataFrame:
    """Stack tables; columns keep the order in which they first appear.

    A column a table lacks is filled with ``fill`` (NULL by default); cells it has are kept.
    """
    columns = list(dict.fromkeys(c for f in frames for c in f.columns))
    types = {fld.name: fld.dataType for f in reversed(frames) for fld in f.schema}

    def aligned(f: DataFrame) -> DataFrame:
        have = {fld.name: fld.dataType for fld in f.schema}
        return f.select(*[
            (F.col(f"`{c}`") if c in have else F.lit(fill)).cast(types[c]).alias(c) for c in columns
        ])

    out = aligned(frames[0])
    for f in frames[1:]:
        out = out.unionByName(aligned(f))
    return out


def evaluated(df: DataFrame) -> DataFrame:
    """Same rows, with the columns worked out here.

    A later filter on a costly expression would otherwise be moved below the projection and the
    expression repeated there. Columns that come out of a generator stay behind it.
    """
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
