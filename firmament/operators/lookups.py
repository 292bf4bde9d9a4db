"""Lookups of surrogate ids by natural key, with the rows that found none."""

from pyspark.sql import DataFrame, functions as F

from firmament.functions.text import natural_key


def _keyed(lookup: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return lookup.select(natural_key(F.col(key)).alias("_key"), *columns)


def with_lookup(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str,
                columns: list[str], how: str = "left") -> DataFrame:
    """Add ``columns`` of ``lookup`` where the natural keys agree.

    Rows without a key match nothing, and neither do blank ones unless the lookup has a blank key, which one small
    aggregate tells. An inner join leaves both out. A left join keeps them, so each gets a stand-in by the hash of
    its cells, behind a sign no key has after stripping, and they are dealt over all tasks instead of one.
    """
    named = _keyed(lookup, lookup_key, columns)
    has_blank = named.agg(F.coalesce(F.bool_or(F.col("_key") == ""), F.lit(False))).scalar()
    natural = natural_key(F.col(key))
    natural = F.when((natural != "") | has_blank, natural)
    if how == "left":
        natural = F.coalesce(natural, F.concat(F.lit("\t"), F.xxhash64(*df.columns).cast("string")))
    return (
        df.withColumn("_key", natural)
        .join(named, "_key", how)
        .drop("_key")
    )


def unknown_keys(df: DataFrame, key: str, lookup: DataFrame, lookup_key: str) -> DataFrame:
    """Distinct values of ``key`` that ``lookup`` does not know."""
    return (
        df.select(key).distinct()
        .withColumn("_key", natural_key(F.col(key)))
        .join(_keyed(lookup, lookup_key, []), "_key", "left_anti")
        .select(key)
    )
