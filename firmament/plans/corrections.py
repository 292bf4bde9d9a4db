"""Audited corrections: reviewed findings become cell updates with a log."""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from firmament import schemas
from firmament.functions.numbers import stripped_to_double, text_to_double
from firmament.functions.text import is_blank, normal_ticker, strip
from firmament.operators.identifiers import assign_ids
from firmament.operators.keys import evaluated
from firmament.operators.lookups import with_lookup
from firmament.sources.sinks import overwrite
from firmament.sources.tables import ROW, with_row_order

# Texts of a new value that mean "clear the cell".
CLEAR_WORDS = ("none", "nan", "", "null", "x")


def _is_absent(stripped: Column) -> Column:
    return stripped.isNull() | F.lower(stripped).isin("", "nan")


def _typed_text(text: Column, number: Column, dtype: T.DataType) -> Column:
    """Value in the target type as text; NULL when it does not fit."""
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.IntegralType):
        return number.try_cast("bigint").try_cast(dtype).cast("string")
    return F.when(number.isNotNull(), text.try_cast(dtype).cast("string"))


def eligible_fixes(findings: DataFrame, types: dict[str, T.DataType] | None = None) -> DataFrame:
    """Every finding with the year as number, the typed value, and the ``reason`` it is no fix, if any.

    Tables and columns must be those of the fact schemas. ``types`` overrides the type a value is
    read as, by column.
    """
    places: dict[T.DataType, list[str]] = {}
    for table, columns in schemas.FACT_COLUMNS.items():
        for column, dtype in columns.items():
            places.setdefault((types or {}).get(column, dtype), []).append(f"{table}.{column}")
    rows = with_row_order(findings).select(
        ROW, "message", "new_value",
        strip(F.col("ticker")).alias("ticker"),
        strip(F.col("table_name")).alias("table_name"),
        strip(F.col("column_name")).alias("column_name"),
        strip(F.col("new_value")).alias("_text"),
        text_to_double(F.col("fiscal_year")).alias("_year"),
    ).withColumn("_number", stripped_to_double(F.col("_text")))
    table, column = F.col("table_name"), F.col("column_name")
    place = F.concat_ws(".", table, column)
    typed = F.coalesce(*[
        F.when(place.isin(*names), _typed_text(F.col("_text"), F.col("_number"), dtype))
        for dtype, names in places.items()
    ])
    clears = F.lower("new_value").isin(*CLEAR_WORDS)
    year = F.col("_year").try_cast("int")
    reason = (
        F.when(_is_absent(table), "no table")
        .when(column.rlike("[/,; ]"), "more than one column")
        .when(_is_absent(column), "no column")
        .when(year.isNull(), "not a single year")
        .when(is_blank(F.col("new_value")), "no new value")
        .when(~table.isin(*schemas.FACT_COLUMNS), "unknown table")
        .when(~place.isin(*[n for names in places.values() for n in names]), "unknown column")
        .when(~clears & F.col("_typed").isNull(), "value does not fit the column")
    )
    return evaluated(rows.withColumn("_typed", typed).select(
        ROW, "ticker", year.alias("fiscal_year"), "table_name", "column_name",
        F.when(~clears, F.col("_typed")).alias("new_value"), "message", reason.alias("reason"),
    ))


class Corrections(NamedTuple):
    accepted: DataFrame  # with firm_id, snapshot_id and the stored value as text
    rejected: DataFrame  # with the reason


def place_fixes(fixes: DataFrame, facts: dict[str, DataFrame], cells: dict[str, list[str]] | None = None) -> DataFrame:
    """Each fix with the row it changes, the newest snapshot id of its firm-year and table, and the stored value.

    ``fixes`` have their ``firm_id``; those that change nothing get a ``reason``. ``cells`` names the columns that
    are fixed, by table, so that no others are read; without it all are. Fact rows are cut down to the firm-years
    that have a fix before anything is grouped.
    """
    wanted = fixes.filter("reason IS NULL AND firm_id IS NOT NULL")
    targets = fixes.sparkSession.range(0).selectExpr(
        "'' AS table_name", "id AS firm_id", "0 AS fiscal_year", "id AS snapshot_id", "map('', '') AS _cells")
    for table, fact in facts.items():
        columns = [c for c in schemas.FACT_COLUMNS[table] if cells is None or c in cells.get(table, ())]
        if not columns:
            continue
        here = wanted.filter(F.col("table_name") == table).select(*schemas.FIRM_YEAR).distinct()
        newest = F.max(F.struct("snapshot_id", *[F.col(c).cast("string").alias(c) for c in columns]))
        one = (
            fact.join(here, list(schemas.FIRM_YEAR), "left_semi")
            .groupBy(*schemas.FIRM_YEAR).agg(newest.alias("_row_now"))
            .select(F.lit(table).alias("table_name"), *schemas.FIRM_YEAR, F.col("_row_now.snapshot_id").alias("snapshot_id"),
                    F.map_from_arrays(F.array(*map(F.lit, columns)), F.array(*[f"_row_now.{c}" for c in columns])).alias("_cells"))
        )
        targets = targets.unionByName(one)
    reason = (
        F.when(F.col("reason").isNotNull(), F.col("reason"))
        .when(F.col("firm_id").isNull(), "unknown ticker")
        .when(F.col("snapshot_id").isNull(), "no stored row")
    )
    return (
        fixes.join(targets, ["table_name", *schemas.FIRM_YEAR], "left")
        .withColumns({"reason": reason, "stored_value": F.try_element_at("_cells", F.col("column_name"))})
        .drop("_cells")
    )


def settle_fixes(spark: SparkSession, findings: DataFrame, facts: dict[str, DataFrame], firms: DataFrame,
                 staging: str, types: dict[str, T.DataType] | None = None) -> Corrections:
    """``eligible_fixes`` and ``place_fixes``, each written once to ``staging``.

    Every table and the log read the fixes, so they are worked out once and kept where all nodes
    can read them again. The fixed columns are looked up; the fact schemas bound their number.
    """
    overwrite(with_lookup(eligible_fixes(findings, types), "ticker", firms, "ticker", ["firm_id"]), f"{staging}/eligible")
    fixes = spark.read.parquet(f"{staging}/eligible")
    cells: dict[str, list[str]] = {}
    for r in fixes.filter("reason IS NULL").select("table_name", "column_name").distinct().collect():
        cells.setdefault(r.table_name, []).append(r.column_name)
    overwrite(place_fixes(fixes, facts, cells), f"{staging}/placed")
    placed = spark.read.parquet(f"{staging}/placed")
    return Corrections(
        placed.filter("reason IS NULL").drop("reason"),
        placed.filter("reason IS NOT NULL").drop("firm_id", "snapshot_id", "stored_value"))


def corrected_fact(fact: DataFrame, table: str, accepted: DataFrame) -> DataFrame:
    """The fact table with the fixed cells; the last fix of a cell wins and may clear it."""
    columns = [c for c in schemas.FACT_COLUMNS[table] if c in fact.columns]
    last = (
        accepted.filter(F.col("table_name") == table)
        .groupBy(*schemas.FACT_KEY)
        .agg(*[
            F.max(F.when(F.col("column_name") == c, F.struct(ROW, "new_value"))).alias(f"_fix_{c}")
            for c in columns
        ])
    )

    def cell(f: T.StructField) -> Column:
        if f.name not in columns:
            return F.col(f.name)
        fix = F.col(f"_fix_{f.name}")
        return F.when(fix.isNotNull(), fix["new_value"].cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name)

    return fact.join(last, list(schemas.FACT_KEY), "left").select(*[cell(f) for f in fact.schema])


def override_log(accepted: DataFrame, changed_at: str, changed_by: str = "Group_Member",
                 existing: DataFrame | None = None, null_text: str = "None") -> DataFrame:
    """One log row per fix. Of several fixes of a cell, each logs the value the one before left."""
    w = Window.partitionBy("table_name", "column_name", *schemas.FACT_KEY).orderBy(ROW)
    old = F.when(F.row_number().over(w) == 1, F.col("stored_value")).otherwise(F.lag("new_value").over(w))
    rows = accepted.withColumns({
        "old_value": F.coalesce(old, F.lit(null_text)),
        "_new": F.coalesce("new_value", F.lit(null_text)),
    })
    return assign_ids(rows, "override_id", ROW, existing).select(
        "override_id", "firm_id", "fiscal_year", "table_name", "column_name", "old_value",
        F.col("_new").alias("new_value"), F.col("message").alias("reason"),
        F.lit(changed_by).alias("changed_by"), F.lit(changed_at).cast("timestamp").alias("changed_at"),
    )


def sync_master(master: DataFrame, accepted: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Put fixed cells into the master sheet too, adding a column it lacks.

    Without ``columns`` the fixed columns are looked up; the fact schemas bound their number.
    """
    if columns is None:
        columns = sorted(r[0] for r in accepted.select("column_name").distinct().collect())
    last = (
        accepted.groupBy(normal_ticker(F.col("ticker")).alias("_ticker"), F.col("fiscal_year").alias("_year"))
        .agg(*[F.max(F.when(F.col("column_name") == c, F.struct(ROW, "new_value"))).alias(f"_fix_{c}")
               for c in columns])
    )
    keyed = master.withColumns({
        "_ticker": normal_ticker(F.col("ticker")),
        "_year": text_to_double(F.col("fiscal_year")).try_cast("int"),
    })
    joined = keyed.join(last, ["_ticker", "_year"], "left")

    def cell(c: str) -> Column:
        stored = F.col(f"`{c}`") if c in master.columns else F.lit(None).cast("string")
        if c not in columns:
            return stored
        fix = F.col(f"_fix_{c}")
        return F.when(fix.isNotNull(), fix["new_value"]).otherwise(stored).alias(c)

    added = [c for c in columns if c not in master.columns]
    return joined.select(*[cell(c) for c in [*master.columns, *added]])
