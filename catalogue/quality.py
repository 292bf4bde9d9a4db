"""Findings of the quality rules."""

from pyspark.sql import DataFrame, SparkSession

from catalogue.common import with_tables
from catalogue.panel import PANEL_TABLES, QC_CTES, QC_SELECT, qc_frame
from firmament import schemas
from firmament.plans import quality as q

# Fixed values, written out here so that a wrong list in the engine shows.
RATIOS = ["managerial_inside_own", "state_own", "institutional_own", "foreign_own"]
NOT_NEGATIVE = [
    "net_sales", "total_assets", "intangible_assets_net", "total_liabilities", "cash_and_equivalents", "long_term_debt",
    "current_assets", "current_liabilities", "inventory", "net_ppe", "wip_goods_purchase", "merchandise_purchase_year",
    "firm_age", "employees_count",
]
NOT_POSITIVE = [
    "selling_expenses", "general_admin_expenses", "manufacturing_overhead", "raw_material_consumption",
    "outside_manufacturing_expenses", "production_cost", "rnd_expenses", "capex", "dividend_cash_paid",
]
FLAGS = ["product_innovation", "process_innovation"]
WHOLE = ["shares_outstanding", "employees_count", "firm_age", *FLAGS]


def qc_age_progression_gap(spark: SparkSession, sf: str) -> DataFrame:
    return q.findings(q.with_previous_year(qc_frame(spark, sf)), q.year_rules())


def qc_ranges_signs(spark: SparkSession, sf: str) -> DataFrame:
    return q.findings(qc_frame(spark, sf), q.range_rules())


def qc_consistency(spark: SparkSession, sf: str) -> DataFrame:
    return q.findings(qc_frame(spark, sf), q.consistency_rules())


def qc_notes(spark: SparkSession, sf: str) -> DataFrame:
    return q.findings(qc_frame(spark, sf), q.note_rules())


def qc_report(spark: SparkSession, sf: str) -> DataFrame:
    return q.quality_report(qc_frame(spark, sf))


QUERIES = {
    "qc_age_progression_gap": qc_age_progression_gap,
    "qc_ranges_signs": qc_ranges_signs,
    "qc_consistency": qc_consistency,
    "qc_notes": qc_notes,
    "qc_report": qc_report,
}


def _text(column: str) -> str:
    """A decimal as a float prints."""
    return (f"CASE WHEN {column} = trunc({column}) THEN concat(CAST(CAST({column} AS HUGEINT) AS VARCHAR), '.0') "
            f"ELSE rtrim(CAST({column} AS VARCHAR), '0') END")


def _one(column: str) -> str:
    return f"CAST({column} AS VARCHAR)" if column in WHOLE else _text(column)


def _say(template: str, *args: str) -> str:
    pieces = template.split("%s")
    out = ["'" + pieces[0] + "'"]
    for arg, piece in zip(args, pieces[1:]):
        out += [f"coalesce(CAST({arg} AS VARCHAR), 'None')", "'" + piece + "'"]
    return "concat(" + ", ".join(out) + ")"


def _rule(condition: str, columns: list[str], error: str, message: str, old: str = "NULL",
          year: str = "CAST(fiscal_year AS VARCHAR)", table: str | None = None) -> str:
    table = table or "'" + schemas.tables_of(columns) + "'"
    return (f"SELECT ticker, {year} AS fiscal_year, {table} AS table_name, '{'/'.join(columns)}' AS column_name, "
            f"'{error}' AS error_type, {message} AS message, CAST({old} AS VARCHAR) AS old_value, "
            f"CAST(NULL AS VARCHAR) AS new_value FROM frame WHERE {condition}")


def _percent(x: str) -> str:
    return f"printf('%.2f%%', ({x}) * 100)"


def _year_rules() -> list[str]:
    expected = "CASE WHEN fiscal_year >= founded_year THEN fiscal_year - founded_year END"
    return [
        _rule(f"firm_age IS NOT NULL AND founded_year IS NOT NULL AND firm_age IS DISTINCT FROM ({expected})",
              ["firm_age"], "AGE_LOGIC_ERROR", _say(q.MSG_AGE, "firm_age", expected), "firm_age"),
        _rule("fiscal_year = prev_year + 1 AND firm_age <> prev_age + 1", ["firm_age"], "PROGRESSION_ERROR",
              _say(q.MSG_PROGRESSION, "prev_age", "firm_age"), "firm_age"),
        _rule("fiscal_year > prev_year + 1", ["fiscal_year"], "TIME_GAP", f"'{q.MSG_GAP}'",
              year="concat(prev_year, '-', fiscal_year)", table="CAST(NULL AS VARCHAR)"),
    ]


def _range_rules() -> list[str]:
    out = [_rule(f"{c} < 0 OR {c} > 1", [c], "RANGE_ERROR", _say(q.MSG_RANGE, _one(c)), _one(c))
           for c in RATIOS]
    out.append(_rule("shares_outstanding <= 0", ["shares_outstanding"], "INVALID_VALUE",
                     f"'{q.MSG_SHARES}'", "shares_outstanding"))
    out += [_rule(f"{c} < 0", [c], "NEGATIVE_VALUE", _say(q.MSG_NEGATIVE, f"'{c}'"), _one(c))
            for c in NOT_NEGATIVE]
    out += [_rule(f"{c} > 0", [c], "POSITIVE_VALUE", _say(q.MSG_POSITIVE, f"'{c}'"), _one(c))
            for c in NOT_POSITIVE]
    out.append(_rule("growth_ratio < -0.95 OR growth_ratio > 5.0", ["growth_ratio"], "OUTLIER",
                     _say(q.MSG_OUTLIER, _one("growth_ratio")), _one("growth_ratio")))
    for c in FLAGS:
        out.append(_rule(f"{c} IS NULL", [c], "MISSING_VALUE", _say(q.MSG_NULL_DUMMY, f"'{c}'")))
        out.append(_rule(f"{c} NOT IN (0, 1)", [c], "INVALID_DUMMY", _say(q.MSG_BAD_DUMMY, f"'{c}'", c), c))
    return out


def _consistency_rules() -> list[str]:
    def x(c: str) -> str:
        return f"CAST({c} AS DOUBLE)"

    def shown(columns: list[str]) -> str:
        return "concat('(', " + ", ', ', ".join(
            _text(f"CAST({c} AS DECIMAL(38,6))") for c in columns) + ", ')')"

    cap = ["market_value_equity", "shares_outstanding", "share_price"]
    cap_gap = (f"CASE WHEN {x(cap[0])} <> 0 THEN abs({x(cap[1])} * {x(cap[2])} - {x(cap[0])}) / {x(cap[0])} "
               "ELSE 0 END")
    balance = ["total_assets", "total_liabilities", "total_equity"]
    off = f"abs({x(balance[0])} - ({x(balance[1])} + {x(balance[2])}))"
    off_ratio = f"CASE WHEN {x(balance[0])} <> 0 THEN {off} / {x(balance[0])} ELSE 0 END"
    grouped = f"format('{{:,}}', CAST(round_even({off}, 0) AS BIGINT))"
    known = " AND ".join
    out = [
        _rule(known([f"{c} IS NOT NULL" for c in cap] + [f"({cap_gap}) > 0.05"]), cap, "INCONSISTENT",
              _say(q.MSG_CAP, _percent(cap_gap)), shown(cap)),
        _rule(known([f"{c} IS NOT NULL" for c in balance] + [f"({off_ratio}) > 0.05"]), balance,
              "ACCOUNTING_IMBALANCE", _say(q.MSG_BALANCE, grouped, _percent(off_ratio)), shown(balance)),
    ]
    for parts, whole, text in (
        (["current_assets"], "total_assets", q.MSG_CURRENT),
        (["cash_and_equivalents", "inventory"], "current_assets", q.MSG_LIQUID),
        (["net_ppe", "intangible_assets_net"], "total_assets", q.MSG_FIXED),
        (["long_term_debt", "current_liabilities"], "total_liabilities", q.MSG_DEBT),
        (["net_income"], "net_sales", q.MSG_INCOME),
    ):
        out.append(_rule(f"{' + '.join(map(x, parts))} > {x(whole)}", [*parts, whole], "COMPONENT_ERROR",
                         f"'{text}'", shown([*parts, whole])))
    return out


def _part(label: str) -> str:
    """Last labelled part of the note, cleaned."""
    text = ("list_filter(string_split(lower(coalesce(trim(evidence_note), '')), '|'), "
            f"lambda p: contains(p, '{label}'))[-1]")
    for word in (label, "nan", "none"):
        text = f"replace({text}, '{word}', '')"
    return f"coalesce(trim({text}), '')"


def _note_rules() -> list[str]:
    note = "coalesce(trim(evidence_note), '')"
    out = []
    for flag, label, absent, present in (
        ("product_innovation", "product:", ("MISSING_PRODUCT_NOTE", q.MSG_NO_PRODUCT),
         ("UNEXPECTED_PRODUCT_NOTE", q.MSG_PRODUCT)),
        ("process_innovation", "process:", ("MISSING_PROCESS_NOTE", q.MSG_NO_PROCESS),
         ("UNEXPECTED_PROCESS_NOTE", q.MSG_PROCESS)),
    ):
        out.append(_rule(f"{flag} = 1 AND {_part(label)} = ''", ["evidence_note"], absent[0],
                         _say(absent[1], note), note))
        out.append(_rule(f"{flag} = 0 AND {_part(label)} <> ''", ["evidence_note"], present[0],
                         _say(present[1], note), note))
    return out


def _oracle(rules: list[str]) -> str:
    frame = ("SELECT *, lag(fiscal_year) OVER (PARTITION BY ticker ORDER BY fiscal_year) AS prev_year, "
             f"lag(firm_age) OVER (PARTITION BY ticker ORDER BY fiscal_year) AS prev_age FROM ({QC_SELECT})")
    return with_tables(" UNION ALL ".join(rules), *PANEL_TABLES, **QC_CTES, frame=frame)


ORACLES = {
    "qc_age_progression_gap": _oracle(_year_rules()),
    "qc_ranges_signs": _oracle(_range_rules()),
    "qc_consistency": _oracle(_consistency_rules()),
    "qc_notes": _oracle(_note_rules()),
    "qc_report": _oracle(_year_rules() + _range_rules() + _consistency_rules() + _note_rules()),
}
