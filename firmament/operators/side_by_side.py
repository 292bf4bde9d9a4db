"""Bring rows of several tables together on a shared key with one shuffle.

Each table contributes a payload struct in a column of its own, the tables are stacked, and one
grouped ``max`` per payload puts them next to each other. That replaces a key union, a top-1 step
per table and a chain of outer joins. ``max`` combines before the shuffle, so a hot key shrinks to
one row per task, and the greatest payload is the newest version when it starts with its version.
"""

from pyspark.sql import Column, DataFrame, functions as F


def stacked(parts: list[tuple[DataFrame, dict[str, Column]]], keys: tuple[str, ...]) -> DataFrame:
    """Rows of all tables below each other: ``keys`` and a struct column per payload name, NULL where a row is of another table."""
    out = None
    for df, payloads in parts:
        part = df.select(*keys, *[c.alias(name) for name, c in payloads.items()])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def side_by_side(parts: list[tuple[DataFrame, dict[str, Column]]], keys: tuple[str, ...],
                 counts: tuple[str, ...] = ()) -> DataFrame:
    """``keys``, one struct column per payload name, and ``_n_<name>`` for payloads in ``counts``.

    A key that only one table has is kept, with NULL for the other payloads.
    """
    names = [name for _, payloads in parts for name in payloads]
    return stacked(parts, keys).groupBy(*keys).agg(
        *[F.max(name).alias(name) for name in names],
        *[F.count(name).alias(f"_n_{name}") for name in counts],
    )
