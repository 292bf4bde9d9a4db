"""Review sheets: split, collect, merge, missing cells."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from catalogue.common import scratch
from firmament.operators.keys import ordered
from firmament.plans import review
from firmament.plans.daily import run_reviews
from firmament.sources.tables import ROW
from firmament.standins import TestTables


def sheet(number: int, every: int) -> str:
    """Text sheet ``number`` over users and years; leaves out every ``every``-th user, blanks by rule."""
    cell = ("CASE (user_id + y + {n}) % {m} WHEN 0 THEN '' WHEN 1 THEN '  ' WHEN 2 THEN 'nan' "
            "ELSE concat('{c}', CAST(last + {n} AS VARCHAR)) END")
    columns = [("total_assets", 4), ("net_sales", 5), ("note", 7)] + ([("extra", 6)] if number else [])
    return f"""
SELECT CASE WHEN (user_id + {number}) % 4 = 0 THEN concat(' t', CAST(user_id AS VARCHAR))
            ELSE concat('T', CAST(user_id AS VARCHAR)) END AS ticker,
       CASE WHEN y = 2023 THEN concat(CAST(y AS VARCHAR), '.0') WHEN y = 2024 AND user_id % 50 = 0 THEN 'unknown'
            ELSE CAST(y AS VARCHAR) END AS fiscal_year,
       {', '.join(cell.format(n=number, m=m, c=c[0]) + ' AS ' + c for c, m in columns)},
       user_id * 10 + y AS _row
FROM (SELECT user_id, 2020 + event_id % 5 AS y, max(event_id) AS last FROM events
      WHERE (user_id + {number}) % {every} <> 0 GROUP BY 1, 2) t
"""


GROUPS = """
SELECT concat('G', CAST(n_regionkey AS VARCHAR)) AS "group", concat(' t', CAST(u AS VARCHAR)) AS ticker
FROM (SELECT DISTINCT user_id AS u FROM events) e JOIN nation ON n_nationkey = u % 25 OR n_nationkey = u % 7
UNION ALL SELECT 'nobody', 'T-1'
"""
# What one group was given before, with an edit.
GIVEN = """
SELECT concat('G', CAST(user_id % 5 AS VARCHAR)) AS "group", concat('T', CAST(user_id AS VARCHAR)) AS ticker,
       CAST(2021 AS INT) AS fiscal_year, 'edited' AS total_assets
FROM (SELECT DISTINCT user_id FROM events) e WHERE user_id % 3 = 0
"""


def _sheet(spark: SparkSession, sf: str, number: int, every: int) -> DataFrame:
    return TestTables(spark, sf).sql(sheet(number, every), "events")


def _groups(spark: SparkSession, sf: str) -> DataFrame:
    t = TestTables(spark, sf)
    # The second engine gets this as one SQL text; here it is a join on whichever of two numbers fits.
    users = t.table("events").select(F.col("user_id").alias("u")).distinct()
    numbers = users.withColumn("n_nationkey", F.explode(F.array_distinct(F.array(F.col("u") % 25, F.col("u") % 7))))
    named = numbers.join(t.table("nation").select("n_nationkey", "n_regionkey"), "n_nationkey").select(
        F.concat(F.lit("G"), "n_regionkey").alias("group"), F.concat(F.lit(" t"), "u").alias("ticker"))
    return named.unionByName(spark.sql("SELECT 'nobody' AS group, 'T-1' AS ticker"))


def _split(spark: SparkSession, sf: str) -> review.Split:
    given = TestTables(spark, sf).sql(GIVEN.replace('"group"', "group"), "events")
    return review.split_for_review(_sheet(spark, sf, 0, 7).drop(ROW), _groups(spark, sf), given)


def split_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).rows


def split_empty_groups(spark: SparkSession, sf: str) -> DataFrame:
    return _split(spark, sf).empty_groups


def collect_manual(spark: SparkSession, sf: str) -> DataFrame:
    sources = {f"team{i}": (f"id{i}", _sheet(spark, sf, i, 3)) for i in range(3)}
    return review.collect_reviews(sources, prefer_order=["team2", "team0"], skip_empty=False)


def _master(spark: SparkSession, sf: str) -> DataFrame:
    return review.merge_master(*[_sheet(spark, sf, i, 3) for i in range(3)])


def merge_master(spark: SparkSession, sf: str) -> DataFrame:
    return ordered(_master(spark, sf), "ticker", "fiscal_year")


def missing_tasks(spark: SparkSession, sf: str) -> DataFrame:
    tasks = review.missing_tasks(_master(spark, sf), owners=review.owners_of_groups(_team_groups(spark, sf)))
    return ordered(tasks, "assigned_to", "ticker", "fiscal_year", "missing_var")


def daily_run(spark: SparkSession, sf: str) -> DataFrame:
    """The whole run over tables on disk; the tasks of its master, beside the cells they stand for."""
    paths = {name: scratch(spark, name) for name in ("manual", "master", "missing")}
    reviewed = {"team0": ("id0", _sheet(spark, sf, 0, 3)), "team3": ("id3", _sheet(spark, sf, 3, 4))}
    run_reviews(spark, reviewed, paths, _sheet(spark, sf, 1, 3), _sheet(spark, sf, 2, 3), _team_groups(spark, sf), prefer_order=["team3"])
    master = spark.read.parquet(paths["master"])
    names = ["extra", "net_sales", "note", "total_assets"]
    cells = master.select("ticker", "fiscal_year", F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("cell")) for c in names])))
    tasks = spark.read.parquet(paths["missing"]).withColumnRenamed("missing_var", "variable")
    return cells.join(tasks, ["ticker", "fiscal_year", "variable"], "left").select("ticker", "fiscal_year", "variable", "cell", "assigned_to", "status")


def _team_groups(spark: SparkSession, sf: str) -> DataFrame:
    return TestTables(spark, sf).table("events").select(
        F.concat(F.lit("G"), F.col("user_id") % 4).alias("group"), F.concat(F.lit("T"), "user_id").alias("ticker"),
        F.col("event_id").alias(ROW)).filter("ticker LIKE '%1%'")


QUERIES = {
    "daily_run": daily_run,
    "split_groups": split_groups,
    "split_empty_groups": split_empty_groups,
    "collect_manual": collect_manual,
    "merge_master": merge_master,
    "missing_tasks": missing_tasks,
}


def _keyed(sql: str, extra: str = "") -> str:
    return (f"SELECT * REPLACE (upper(trim(ticker)) AS ticker, CAST(TRY_CAST(fiscal_year AS DOUBLE) AS INT) AS fiscal_year)"
            f"{extra} FROM ({sql}) s WHERE TRY_CAST(fiscal_year AS DOUBLE) IS NOT NULL")


_SPLIT = f"""WITH mine AS (SELECT DISTINCT g."group", k.* EXCLUDE (_row) FROM ({_keyed(sheet(0, 7))}) k
        JOIN ({GROUPS}) g ON upper(trim(g.ticker)) = k.ticker), given AS ({GIVEN}),
    result AS (SELECT "group", ticker, fiscal_year, total_assets, '' AS net_sales, '' AS note FROM given
        UNION ALL SELECT "group", ticker, fiscal_year, total_assets, net_sales, note FROM mine m WHERE NOT EXISTS (
            SELECT 1 FROM given g WHERE g."group" = m."group" AND g.ticker = m.ticker AND g.fiscal_year = m.fiscal_year))"""
_FILLED = "CASE WHEN trim({c}) <> '' THEN {c} END"


def _cell(column: str, sources: tuple[str, ...]) -> str:
    raw = [f"{s}.{column}" for s in sources]
    return f"coalesce({', '.join(_FILLED.format(c=c) for c in raw)}, {raw[-1]}, '') AS {column}"



def _merged(manual: str, has_extra: bool = False) -> str:
    manual_extra = ("m", "e", "x") if has_extra else ("e", "x")
    return f"""
WITH m AS ({manual}), e AS ({_keyed(sheet(1, 3))}), x AS ({_keyed(sheet(2, 3))}),
     k AS (SELECT ticker, fiscal_year FROM m UNION SELECT ticker, fiscal_year FROM e
           UNION SELECT ticker, fiscal_year FROM x)
SELECT k.ticker, k.fiscal_year, {_cell('extra', manual_extra)}, {_cell('net_sales', ('m', 'e', 'x'))},
       {_cell('note', ('m', 'e', 'x'))}, {_cell('total_assets', ('m', 'e', 'x'))}
FROM k LEFT JOIN m ON m.ticker = k.ticker AND m.fiscal_year = k.fiscal_year
       LEFT JOIN e ON e.ticker = k.ticker AND e.fiscal_year = k.fiscal_year
       LEFT JOIN x ON x.ticker = k.ticker AND x.fiscal_year = k.fiscal_year
"""


_MASTER = _merged(_keyed(sheet(0, 3)))
_COLLECTED = f"""SELECT * EXCLUDE (rn, rank) FROM (SELECT *, row_number() OVER (PARTITION BY ticker, fiscal_year ORDER BY rank, _row) AS rn FROM (
    {_keyed(sheet(0, 3), ", '' AS extra, 1 AS rank")} UNION ALL BY NAME {_keyed(sheet(3, 4), ", 0 AS rank")}) c) WHERE rn = 1"""

ORACLES = {
    "daily_run": f"""
        SELECT ticker, fiscal_year, variable, cell, CASE WHEN blank THEN coalesce(assigned_to, '') END AS assigned_to,
               CASE WHEN blank THEN 'todo' END AS status
        FROM (SELECT *, lower(trim(cell)) IN ('', 'nan', 'none', 'null') AS blank FROM (
            SELECT ticker, fiscal_year, unnest(['extra', 'net_sales', 'note', 'total_assets']) AS variable,
                   unnest([extra, net_sales, note, total_assets]) AS cell FROM ({_merged(_COLLECTED, True)}) m)) u
        LEFT JOIN (SELECT DISTINCT concat('T', user_id) AS ticker, concat('G', user_id % 4) AS assigned_to FROM events
                   WHERE concat('T', user_id) LIKE '%1%') o USING (ticker)""",
    "split_groups": f"{_SPLIT} SELECT * FROM result",
    "split_empty_groups": f"""{_SPLIT} SELECT DISTINCT g."group" FROM ({GROUPS}) g
        WHERE g."group" NOT IN (SELECT "group" FROM result)""",
    "collect_manual": f"""SELECT ticker, fiscal_year, total_assets, net_sales, note, extra, _manual_source, _manual_source_id
        FROM (SELECT *, row_number() OVER (PARTITION BY ticker, fiscal_year ORDER BY rank, _row) AS rn FROM (
            {' UNION ALL BY NAME '.join(_keyed(sheet(i, 3), ("" if i else ", '' AS extra")
              + f", 'team{i}' AS _manual_source, 'id{i}' AS _manual_source_id, {r} AS rank")
              for i, r in ((0, 1), (1, 2), (2, 0)))}) c) WHERE rn = 1""",
    "merge_master": f"{_MASTER} ORDER BY k.ticker, k.fiscal_year",
    "missing_tasks": f"""
        SELECT ticker, fiscal_year, missing_var, coalesce(assigned_to, '') AS assigned_to, 'todo' AS status, '' AS note
        FROM (SELECT ticker, fiscal_year, unnest(['extra', 'net_sales', 'note', 'total_assets']) AS missing_var,
                     unnest([extra, net_sales, note, total_assets]) AS cell FROM ({_MASTER}) m) u
        LEFT JOIN (SELECT DISTINCT concat('T', user_id) AS ticker, concat('G', user_id % 4) AS assigned_to FROM events
                   WHERE concat('T', user_id) LIKE '%1%') o USING (ticker)
        WHERE lower(trim(cell)) IN ('', 'nan', 'none', 'null')
        ORDER BY assigned_to, ticker, fiscal_year, missing_var""",
}
