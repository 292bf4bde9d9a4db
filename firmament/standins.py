"""Firm-panel tables derived from the star-schema test tables.

Every derivation is SQL text that Spark and the checking database both run, so the checks compare
jobs and not derivations. Values follow from keys by modulo rules, which gives NULLs, ties between
snapshots and broken values in known places.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from firmament import schemas

# Firm k, fiscal year y, version pr, amount a.
VERSIONED = """
SELECT o_custkey AS k, CAST(year(o_orderdate) AS INT) AS y,
       CAST(substr(o_orderpriority, 1, 1) AS INT) AS pr,
       CAST(sum(CAST(o_totalprice AS DECIMAL(20,2))) AS DECIMAL(20,2)) AS a
FROM orders {where} GROUP BY 1, 2, 3
"""

SNAPSHOT = """
SELECT CAST(y * 10 + pr AS BIGINT) AS snapshot_id, make_date(y + 1, 1 + pr % 3, 1) AS snapshot_date,
       y AS fiscal_year, CAST(pr AS BIGINT) AS source_id, concat('v', CAST(pr AS VARCHAR)) AS version_tag
FROM (SELECT DISTINCT CAST(year(o_orderdate) AS INT) AS y,
             CAST(substr(o_orderpriority, 1, 1) AS INT) AS pr FROM orders) v
"""

FIRM = """
SELECT c_custkey AS firm_id,
       CASE WHEN c_custkey = 0 THEN 'TEST'
            ELSE concat('T', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) END AS ticker,
       c_name AS company_name, CAST(1950 + c_custkey % 60 AS INT) AS founded_year
FROM customer
"""

_MONEY = "CAST({} AS DECIMAL(20,2))"
_RATIO = "CAST({} AS DECIMAL(10,6))"

# Versions each fact has, and its columns. Columns not named are NULL.
FACTS: dict[str, tuple[str, dict[str, str]]] = {
    "fact_financial_year": ("1, 2, 3, 4, 5", {
        "unit_scale": "CAST(1 AS BIGINT)",
        "currency_code": "'VND'",
        "net_sales": "a",
        "total_assets": _MONEY.format("2 * a"),
        "selling_expenses": _MONEY.format("CASE WHEN k % 8 = 0 THEN a ELSE -a END"),
        "general_admin_expenses": _MONEY.format("-a"),
        "intangible_assets_net": _MONEY.format("a * (k % 4)"),
        "net_operating_income": _MONEY.format("a * (k % 3 - 1)"),
        "wip_goods_purchase": _MONEY.format("a * (k % 12 - 1)"),
        "rnd_expenses": _MONEY.format("CASE WHEN k % 10 = 0 THEN a END"),
        "net_income": _MONEY.format("CASE WHEN k % 7 = 0 THEN NULL ELSE a * (k % 5 - 2) END"),
        "total_equity": _MONEY.format("a * (k % 3) + CASE WHEN k % 9 = 0 THEN a ELSE 0 END"),
        "total_liabilities": _MONEY.format("2 * a - a * (k % 3)"),
        "cash_and_equivalents": _MONEY.format("a * (k % 2)"),
        "long_term_debt": _MONEY.format("a * (k % 4 - 1)"),
        "current_assets": _MONEY.format("a * (k % 6)"),
        "current_liabilities": _MONEY.format("a"),
        "growth_ratio": _RATIO.format("(k % 29 - 4) * 0.25"),
        "inventory": _MONEY.format("CASE WHEN k % 13 = 0 THEN NULL ELSE a END"),
        "net_ppe": _MONEY.format("a"),
    }),
    "fact_ownership_year": ("1, 2, 3", {
        "managerial_inside_own": _RATIO.format("(k % 11) * 0.1"),
        "state_own": _RATIO.format("(k % 23) * 0.05 - 0.05"),
        "institutional_own": _RATIO.format("CASE WHEN k % 6 = 0 THEN NULL ELSE (k % 9) * 0.15 END"),
        "foreign_own": _RATIO.format("pr * 0.01"),
        "note": "CASE WHEN k % 3 = 0 THEN 'checked' END",
    }),
    "fact_cashflow_year": ("2, 4", {
        "unit_scale": "CAST(1 AS BIGINT)",
        "currency_code": "'VND'",
        "net_cfo": "a",
        "capex": _MONEY.format("CASE WHEN k % 4 = 0 THEN a ELSE -a END"),
    }),
    "fact_market_year": ("1, 5", {
        "shares_outstanding": "CAST(k % 50 AS BIGINT)",
        "price_reference": "'close_year_end'",
        "share_price": "CAST(a * 0.001 AS DECIMAL(20,4))",
        "market_value_equity": _MONEY.format(
            "CAST(a * 0.001 AS DECIMAL(20,4)) * (k % 50) * CASE WHEN k % 3 = 0 THEN 1.2 ELSE 1.0 END"),
        "dividend_cash_paid": _MONEY.format("CASE WHEN k % 17 = 0 THEN a ELSE -a END"),
        "eps_basic": "CAST(a * 0.0001 AS DECIMAL(20,6))",
        "currency_code": "'VND'",
    }),
    "fact_innovation_year": ("3, 4, 5", {
        "product_innovation": "CAST(CASE k % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN 1 ELSE 2 END AS INT)",
        "process_innovation": "CAST(k % 2 AS INT)",
        "evidence_source_id": "6",
        "evidence_note": "CASE k % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Product: nan' WHEN 2 THEN 'Product: u | Process: none'"
                         " WHEN 3 THEN 'Process: web page' WHEN 4 THEN ' ' ELSE 'Product: a | Product: b | Process: nan' END",
    }),
    "fact_firm_year_meta": ("1, 2, 4", {
        "employees_count": "CAST(CASE WHEN k % 19 = 0 THEN -1 ELSE k % 1000 END AS INT)",
        "firm_age": "CAST(CASE WHEN k % 21 = 0 THEN NULL ELSE y - (1950 + k % 60)"
                    " + CASE WHEN k % 11 = 0 AND y % 2 = 0 THEN 1 ELSE 0 END END AS INT)",
    }),
}


def _all_columns(table: str) -> dict[str, str]:
    given = FACTS[table][1]
    return {c: given.get(c, f"CAST(NULL AS {t.simpleString()})")
            for c, t in schemas.FACT_COLUMNS[table].items()}


def _versions(table: str) -> str:
    # The version filter is on a grouping key, so it can be put before the grouping.
    return f"WHERE CAST(substr(o_orderpriority, 1, 1) AS INT) IN ({FACTS[table][0]})"


def _fact_of(table: str, source: str) -> str:
    columns = ", ".join(f"{sql} AS {name}" for name, sql in _all_columns(table).items())
    return f"SELECT k AS firm_id, y AS fiscal_year, CAST(y * 10 + pr AS BIGINT) AS snapshot_id, {columns} FROM {source} b"


def fact_sql(table: str) -> str:
    return _fact_of(table, f"({VERSIONED.format(where=_versions(table))})")


def sql_tables() -> dict[str, str]:
    """All derived tables as SQL text, for use as common table expressions."""
    return {"snapshot": SNAPSHOT, "dim_firm": FIRM, **{t: fact_sql(t) for t in FACTS}}


class TestTables:
    """The given tables of one scale factor and the firm-panel tables derived from them."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._read[name]

    def sql(self, text: str, *names: str) -> DataFrame:
        """Run SQL over given tables without registering session-wide views."""
        return self.spark.sql(self._bound(text, names), **{n: self.table(n) for n in names})

    @staticmethod
    def _bound(text: str, names: tuple[str, ...]) -> str:
        for n in names:
            text = text.replace(f"FROM {n}", "FROM {" + n + "}")
        return text.replace("VARCHAR", "STRING")

    def facts(self) -> dict[str, DataFrame]:
        return {t: self._fact(t) for t in FACTS}

    def _fact(self, table: str) -> DataFrame:
        """A row of a fact is many times wider than what it is made of, so the narrow rows are dealt to a named number of tasks: adaptive
        execution goes by their few bytes and would leave tasks with gigabytes of fact rows. The hash keeps them from counting as dealt."""
        cells = self.sql(VERSIONED.format(where=_versions(table)), "orders")
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = cells.repartition(tasks, F.xxhash64(*cells.columns[:3]))
        return self.spark.sql(_fact_of(table, "{b}").replace("VARCHAR", "STRING"), b=dealt)

    def snapshots(self) -> DataFrame:
        return self.sql(SNAPSHOT, "orders")

    def firms(self) -> DataFrame:
        return self.sql(FIRM, "customer")
