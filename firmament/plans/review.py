"""Manual review: hand rows out to groups, take edits back, merge sources, list what is missing."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from firmament.functions.text import filled, is_missing, normal_ticker
from firmament.operators.keys import (
    key_columns, keys_first, require_columns, sheet_keys, text_cells, union_by_name,
    without_helpers,
)
from firmament.operators.side_by_side import side_by_side
from firmament.operators.upsert import absent_rows
from firmament.operators.versions import first_rows
from firmament.sources.sinks import append, overwrite
from firmament.sources.tables import ROW, with_row_order


class Split(NamedTuple):
    rows: DataFrame  # tables of all groups, told apart by ``group``
    appended: DataFrame  # the rows that are new in them
    empty_groups: DataFrame  # groups without any row: their table is just a header


def split_for_review(consolidated: DataFrame, groups: DataFrame, existing: DataFrame | None = None) -> Split:
    """Give each group the rows of its tickers. Rows a group already has are never touched.

    ``groups`` has group and ticker; a ticker may be in several. ``existing`` is the present state
    with a ``group`` column.
    """
    key = key_columns(consolidated)
    members = groups.select("group", normal_ticker(F.col("ticker")).alias(key.ticker)).distinct()
    mine = text_cells(sheet_keys(consolidated, key), keep=key).join(members, key.ticker)
    mine = keys_first(mine, ("group",), sort_rest=False)
    if existing is None:
        appended = rows = mine
    else:
        old = key_columns(existing.drop("group"))
        known = sheet_keys(existing.select("group", old.ticker, old.year), old).toDF("group", *key)
        appended = absent_rows(mine, known, ("group", *key))
        rows = union_by_name([existing, appended], fill="")
        if old == key:
            rows = rows.withColumn(key.year, F.col(key.year).cast(appended.schema[key.year].dataType))
    named = rows.select("group").distinct()
    return Split(rows, appended, groups.select("group").distinct().join(named, "group", "left_anti"))


def write_split(split: Split, path: str) -> None:
    """Add the new rows to their group's partition; what reviewers have is not touched.

    New rows may have more or fewer columns than stored ones, so read the table with ``mergeSchema``.
    """
    append(split.appended, path, ("group",))
    overwrite(split.empty_groups, f"{path.rstrip('/')}_empty")


def collect_reviews(sources: dict[str, tuple[str, DataFrame]] | list[tuple[str, DataFrame]],
                    prefer_order: list[str] | None = None, skip_empty: bool = True) -> DataFrame:
    """Stack reviewed tables and keep the best source's row per key, as a whole row.

    ``sources`` maps a name to (id, table), then ``prefer_order`` holds names; or it is a list of
    (id, table), then it holds ids. Without it the listing order counts. ``skip_empty`` looks
    whether a source has rows, so that the header of an empty one adds no columns.
    """
    if isinstance(sources, dict):
        listed = [(name, sid, df) for name, (sid, df) in sources.items()]
        preferred = [sources[name][0] for name in prefer_order or () if name in sources]
        order = preferred + [sid for _, sid, _ in listed if sid not in preferred]
    else:
        listed = [(f"source_{i + 1}", sid, df) for i, (sid, df) in enumerate(sources)]
        order = list(prefer_order or [sid for _, sid, _ in listed])
    rank = {sid: i for i, sid in enumerate(order)}
    frames = [
        with_row_order(df).withColumns({
            "_manual_source": F.lit(name), "_manual_source_id": F.lit(sid),
            "_source_rank": F.lit(rank.get(sid, 9999)), "_listed": F.lit(i),
        })
        for i, (name, sid, df) in enumerate(listed) if not (skip_empty and df.isEmpty())
    ]
    if not frames:
        raise ValueError("no reviewed table has rows")
    stacked = union_by_name(frames, fill="")
    key = key_columns(stacked)
    best = first_rows(sheet_keys(stacked, key), key, "_source_rank", "_listed", ROW)
    return keys_first(best.drop("_source_rank", "_listed", ROW), key, sort_rest=False)


def merge_master(manual: DataFrame | None, extra: DataFrame | None, extracted: DataFrame | None = None,
                 fill_from_extracted: bool = True) -> DataFrame:
    """One row per key of any source; each cell from the first source that has it filled.

    Order: manual, extra, extracted. Key columns are named as in the first source and shared by
    all. A source without rows counts as absent, with its columns; if all are, so is the result, with the
    columns of the first. A key that a source has twice stops the job. All sources meet in one shuffle.
    """
    given = {n: df for n, df in (("manual", manual), ("extra", extra), ("extracted", extracted))
             if df is not None}
    if not given:
        raise ValueError("nothing to merge")
    sources = {n: df for n, df in given.items() if not df.isEmpty()} or dict(list(given.items())[:1])
    key = key_columns(next(iter(sources.values())))
    parts, columns = [], {}
    for name, df in sources.items():
        require_columns(df, key)
        rows = without_helpers(sheet_keys(df, key), keep=key)
        gives_cells = name != "extracted" or fill_from_extracted
        columns[name] = [c for c in rows.columns if c not in key] if gives_cells else []
        cells = [F.col(f"`{c}`").cast("string").alias(c) for c in columns[name]]
        parts.append((rows, {name: F.struct(F.lit(True).alias("_there"), *cells)}))
    met = side_by_side(parts, key, counts=tuple(sources))

    def cell(column: str) -> Column:
        raw = [F.col(f"{name}.`{column}`") for name in sources if column in columns[name]]
        # Where all are blank, the last source's blank stays, as text.
        return F.coalesce(*map(filled, raw), raw[-1], F.lit("")).alias(column)

    twice = F.greatest(*[F.col(f"_n_{name}") for name in sources]) > 1 if len(sources) > 1 else \
        F.col(f"_n_{next(iter(sources))}") > 1
    year = F.when(twice, F.raise_error(F.concat(
        F.lit("a source has this key twice: "), F.col(key.ticker), F.lit(" "), F.col(key.year).cast("string"))
    )).otherwise(F.col(key.year))
    every = sorted({c for names in columns.values() for c in names})
    return met.select(key.ticker, year.alias(key.year), *map(cell, every))


def missing_tasks(master: DataFrame, required: list[str] | None = None,
                  owners: DataFrame | None = None) -> DataFrame:
    """One task per blank cell of the required columns (all but the keys by default).

    ``owners`` has ticker and assigned_to, one row per ticker.
    """
    key = key_columns(master)
    rows = sheet_keys(master, key)
    wanted = [c for c in (required or [c for c in rows.columns if c not in key]) if c in rows.columns]
    names = F.array_compact(F.array(*[F.when(is_missing(F.col(f"`{c}`")), F.lit(c)) for c in wanted]))
    tasks = rows.select(
        F.col(key.ticker).alias("ticker"), F.col(key.year).alias("fiscal_year"),
        F.explode(names).alias("missing_var"),
    )
    assigned = F.lit("")
    if owners is not None:
        tasks = tasks.join(owners.select("ticker", "assigned_to"), "ticker", "left")
        assigned = F.coalesce("assigned_to", F.lit(""))
    return tasks.select("ticker", "fiscal_year", "missing_var", assigned.alias("assigned_to"),
                        F.lit("todo").alias("status"), F.lit("").alias("note"))


def owners_of_groups(groups: DataFrame, position: str = ROW) -> DataFrame:
    """Group table turned round: one owner per ticker, the last listed one."""
    return with_row_order(groups, position).groupBy("ticker").agg(
        F.max_by("group", position).alias("assigned_to"))
