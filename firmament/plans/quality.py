"""Quality rules over the panel, as one pass that yields a findings table.

The rules are a table: columns, error type, SQL test, message and its arguments. All tests of a row
go into one bit mask, and messages are only made for hits. The panel
is read once, and only the year-to-year rules need a window.
"""

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from firmament import schemas
from firmament.functions.notes import note_part
from firmament.functions.numbers import relative_gap
from firmament.functions.rendering import decimal_text, grouped, percent
from firmament.functions.text import strip

# --------------------------------------------------------------------------
# Limits, the columns each rule looks at, error types and message texts.
# --------------------------------------------------------------------------
GROWTH_LIMITS = (-0.95, 5.0)
TOLERANCE = 0.05

RATIO_COLUMNS = ("managerial_inside_own", "state_own", "institutional_own", "foreign_own")
NON_NEGATIVE = (
    "net_sales", "total_assets", "intangible_assets_net", "total_liabilities",
    "cash_and_equivalents", "long_term_debt", "current_assets", "current_liabilities",
    "inventory", "net_ppe", "wip_goods_purchase", "merchandise_purchase_year", "firm_age",
    "employees_count",
)
NON_POSITIVE = (
    "selling_expenses", "general_admin_expenses", "manufacturing_overhead",
    "raw_material_consumption", "outside_manufacturing_expenses", "production_cost",
    "rnd_expenses", "capex", "dividend_cash_paid",
)
DUMMIES = ("product_innovation", "process_innovation")

MSG_AGE = "Không khớp năm thành lập. Có: %s, Tính toán: %s"
MSG_PROGRESSION = "Tuổi không tăng tiến đều (Năm trước: %s, Năm nay: %s)"
MSG_GAP = "Dữ liệu bị đứt quãng thời gian"
MSG_RANGE = "Giá trị %s nằm ngoài khoảng [0,1]"
MSG_SHARES = "Số lượng cổ phiếu phải lớn hơn 0"
MSG_NEGATIVE = "Giá trị %s không được âm"
MSG_POSITIVE = "Giá trị %s không được dương"
MSG_OUTLIER = "Tỷ lệ tăng trưởng %s bất thường"
MSG_CAP = "Sai lệch vốn hóa (%s) so với tính toán"
MSG_BALANCE = "Bảng cân đối không khớp. Chênh lệch: %s (%s)"
MSG_CURRENT = "Tài sản ngắn hạn vượt quá tổng tài sản"
MSG_LIQUID = "Tổng tiền mặt và hàng tồn kho vượt quá tài sản ngắn hạn"
MSG_FIXED = "Tổng PPE và tài sản vô hình vượt quá tổng tài sản"
MSG_DEBT = "Nợ dài hạn và nợ ngắn hạn vượt quá tổng nợ"
MSG_INCOME = "Lợi nhuận ròng vượt quá doanh thu"
MSG_NULL_DUMMY = "Biến %s đang bị để trống (NULL). Chỉ chấp nhận 0 hoặc 1."
MSG_BAD_DUMMY = "Giá trị %s không hợp lệ (hiện tại là %s). Chỉ chấp nhận 0 hoặc 1."
MSG_NO_PRODUCT = 'Đổi mới SP (1) nhưng ghi chú "product:" trống hoặc nan. (Gốc: "%s")'
MSG_PRODUCT = 'Không đổi mới SP (0) nhưng "product:" lại có thuyết minh. (Gốc: "%s")'
MSG_NO_PROCESS = 'Đổi mới QT (1) nhưng ghi chú "process:" trống hoặc nan. (Gốc: "%s")'
MSG_PROCESS = 'Không đổi mới QT (0) nhưng "process:" lại có thuyết minh. (Gốc: "%s")'


class Rule(NamedTuple):
    columns: tuple[str, ...]  # what the finding is about, and the values it shows
    error: str
    test: str  # SQL; NULL means no finding
    message: str
    arguments: tuple[str, ...] = ()  # names from ``_arguments``, one per %s


def year_rules(flag_missing_age: bool = False) -> list[Rule]:
    """Rules on firm age and on the sequence of years.

    A missing age gives no finding; ``flag_missing_age`` reports it instead, as a tool does that
    reads missing numbers as not-a-number.
    """
    age_known = "TRUE" if flag_missing_age else "firm_age IS NOT NULL"
    ages_known = "TRUE" if flag_missing_age else "firm_age IS NOT NULL AND _prev_age IS NOT NULL"
    return [
        Rule(("firm_age",), "AGE_LOGIC_ERROR",
             f"founded_year IS NOT NULL AND {age_known} AND NOT coalesce("
             "fiscal_year >= founded_year AND firm_age = fiscal_year - founded_year, FALSE)",
             MSG_AGE, ("age", "expected_age")),
        Rule(("firm_age",), "PROGRESSION_ERROR",
             f"fiscal_year = _prev_year + 1 AND {ages_known} AND NOT coalesce(firm_age = _prev_age + 1, FALSE)",
             MSG_PROGRESSION, ("previous_age", "age")),
        Rule(("fiscal_year",), "TIME_GAP", "fiscal_year > _prev_year + 1", MSG_GAP),
    ]


def range_rules() -> list[Rule]:
    """Rules on the value of one column: ratios, signs, growth and 0/1 flags."""
    low, high = GROWTH_LIMITS
    return [
        *(Rule((c,), "RANGE_ERROR", f"{c} NOT BETWEEN 0 AND 1", MSG_RANGE, ("value",)) for c in RATIO_COLUMNS),
        Rule(("shares_outstanding",), "INVALID_VALUE", "shares_outstanding <= 0", MSG_SHARES),
        *(Rule((c,), "NEGATIVE_VALUE", f"{c} < 0", MSG_NEGATIVE, ("column",)) for c in NON_NEGATIVE),
        *(Rule((c,), "POSITIVE_VALUE", f"{c} > 0", MSG_POSITIVE, ("column",)) for c in NON_POSITIVE),
        Rule(("growth_ratio",), "OUTLIER",
             f"CAST(growth_ratio AS DOUBLE) NOT BETWEEN {low}D AND {high}D", MSG_OUTLIER, ("value",)),
        *(Rule((c,), "MISSING_VALUE", f"{c} IS NULL", MSG_NULL_DUMMY, ("column",)) for c in DUMMIES),
        *(Rule((c,), "INVALID_DUMMY", f"{c} NOT IN (0, 1)", MSG_BAD_DUMMY, ("column", "value"))
          for c in DUMMIES),
    ]


def consistency_rules() -> list[Rule]:
    """Rules across columns, on doubles; a missing operand gives no finding."""

    def exceeds(parts: tuple[str, ...], whole: str, message: str) -> Rule:
        total = " + ".join(f"CAST({c} AS DOUBLE)" for c in parts)
        return Rule((*parts, whole), "COMPONENT_ERROR", f"{total} > CAST({whole} AS DOUBLE)", message)

    return [
        Rule(("market_value_equity", "shares_outstanding", "share_price"), "INCONSISTENT",
             f"_cap_gap > {TOLERANCE}D", MSG_CAP, ("cap_gap",)),
        Rule(("total_assets", "total_liabilities", "total_equity"), "ACCOUNTING_IMBALANCE",
             f"_balance_gap > {TOLERANCE}D", MSG_BALANCE, ("balance_amount", "balance_gap")),
        exceeds(("current_assets",), "total_assets", MSG_CURRENT),
        exceeds(("cash_and_equivalents", "inventory"), "current_assets", MSG_LIQUID),
        exceeds(("net_ppe", "intangible_assets_net"), "total_assets", MSG_FIXED),
        exceeds(("long_term_debt", "current_liabilities"), "total_liabilities", MSG_DEBT),
        exceeds(("net_income",), "net_sales", MSG_INCOME),
    ]


def note_rules() -> list[Rule]:
    """Rules between the innovation flags and the evidence note."""
    note = ("evidence_note",)
    return [
        Rule(note, "MISSING_PRODUCT_NOTE", "product_innovation = 1 AND _product_note IS NULL",
             MSG_NO_PRODUCT, ("note",)),
        Rule(note, "UNEXPECTED_PRODUCT_NOTE", "product_innovation = 0 AND _product_note IS NOT NULL",
             MSG_PRODUCT, ("note",)),
        Rule(note, "MISSING_PROCESS_NOTE", "process_innovation = 1 AND _process_note IS NULL",
             MSG_NO_PROCESS, ("note",)),
        Rule(note, "UNEXPECTED_PROCESS_NOTE", "process_innovation = 0 AND _process_note IS NOT NULL",
             MSG_PROCESS, ("note",)),
    ]


def all_rules(flag_missing_age: bool = False) -> list[Rule]:
    return year_rules(flag_missing_age) + range_rules() + consistency_rules() + note_rules()


# Columns the tests need beyond the frame's, by the name they are used under.
def _derived() -> dict[str, Column]:
    def x(c: str) -> Column:
        return F.col(c).cast("double")

    note = F.coalesce(strip(F.col("evidence_note")), F.lit(""))
    return {
        # NULL as soon as one operand is missing.
        "_cap_gap": relative_gap(x("shares_outstanding") * x("share_price"), x("market_value_equity"))
        + F.when(F.col("shares_outstanding").isNotNull() & F.col("share_price").isNotNull(), 0.0),
        "_balance_gap": relative_gap(x("total_liabilities") + x("total_equity"), x("total_assets"))
        + F.when(F.col("total_liabilities").isNotNull() & F.col("total_equity").isNotNull(), 0.0),
        "_note": note,
        "_product_note": note_part(note, "product:"),
        "_process_note": note_part(note, "process:"),
    }


def _arguments() -> dict[str, Column]:
    """Message arguments by name. ``_value`` is the rule's first column, ``_whole`` says it is an integer."""
    year, founded = F.col("fiscal_year"), F.col("founded_year")
    funds = F.expr("CAST(total_liabilities AS DOUBLE) + CAST(total_equity AS DOUBLE)")
    return {
        "value": F.col("_value_text"),
        "column": F.col("column_name"),
        "age": F.col("firm_age").cast("string"),
        "previous_age": F.col("_prev_age").cast("string"),
        "expected_age": F.when(year >= founded, year - founded).cast("string"),
        "cap_gap": percent(F.col("_cap_gap")),
        "balance_gap": percent(F.col("_balance_gap")),
        "balance_amount": grouped(F.abs(F.col("total_assets").cast("double") - funds)),
        "note": F.col("_note"),
    }


def _needs(frame: DataFrame, rules: list[Rule]) -> dict[str, Column]:
    text = " ".join(r.test for r in rules) + (" _note" if any("note" in r.arguments for r in rules) else "")
    return {name: c for name, c in _derived().items() if name in text}


def _per_rule(values: list) -> Column:
    """Constant looked up by rule number."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("_rule") + 1)


def findings(frame: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule a frame row breaks; ``new_value`` is left for the reviewer.

    Year rules need the columns of ``with_previous_year``.
    """
    mask = " | ".join(f"if({r.test}, {1 << i}L, 0L)" for i, r in enumerate(rules))
    hits = (
        frame.withColumns(_needs(frame, rules))
        .withColumn("_mask", F.expr(mask))
        .withColumn("_rule", F.explode(F.filter(
            F.array(*[F.lit(i) for i in range(len(rules))]),
            lambda i: F.expr("_mask").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)) != 0)))
    )

    def by_rule(choose) -> Column:
        """CASE over the rules on what ``choose`` gives for a rule (SQL text or nothing)."""
        chosen: dict[str, list[str]] = {}
        for i, r in enumerate(rules):
            sql = choose(r)
            if sql:
                chosen.setdefault(sql, []).append(str(i))
        if not chosen:
            return F.expr("CAST(NULL AS DECIMAL(38,6))")
        cases = " ".join(f"WHEN _rule IN ({', '.join(ids)}) THEN CAST({sql} AS DECIMAL(38,6))"
                         for sql, ids in chosen.items())
        return F.expr(f"CASE {cases} END")

    def operand(position: int) -> Column:
        return by_rule(lambda r: r.columns[position] if len(r.columns) > position
                       and r.columns[0] not in ("fiscal_year", "evidence_note") else None)

    whole = schemas.WHOLE_NUMBER_VARIABLES + DUMMIES
    operands = F.array_compact(F.array(operand(0), operand(1), operand(2)))
    is_whole = _per_rule([r.columns[0] in whole and len(r.columns) == 1 for r in rules])
    shaped = hits.withColumns({
        "_texts": F.transform(operands, decimal_text),
        "column_name": _per_rule(["/".join(r.columns) for r in rules]),
    }).withColumn("_value_text", F.when(
        is_whole, F.replace(F.get("_texts", F.lit(0)), F.lit(".0"), F.lit(""))
    ).otherwise(F.get("_texts", F.lit(0))))

    arguments, pieces = _arguments(), [r.message.split("%s") for r in rules]
    message = [_per_rule([p[0] for p in pieces])]
    for position in range(max(len(r.arguments) for r in rules)):
        names = {}
        for i, r in enumerate(rules):
            if len(r.arguments) > position:
                names.setdefault(r.arguments[position], []).append(i)
        argument = None
        for name, ids in names.items():
            text = F.coalesce(arguments[name], F.lit("None"))
            case = F.col("_rule").isin(*ids)
            argument = F.when(case, text) if argument is None else argument.when(case, text)
        message.append(F.coalesce(argument, F.lit("")))
        message.append(_per_rule([p[position + 1] if len(p) > position + 1 else "" for p in pieces]))

    several = _per_rule([len(r.columns) > 1 for r in rules])
    shown = F.concat(F.lit("("), F.array_join("_texts", ", "), F.lit(")"))
    old_value = F.when(several, shown).otherwise(F.col("_value_text"))
    if any(r.columns == ("evidence_note",) for r in rules):
        is_note = _per_rule([r.columns == ("evidence_note",) for r in rules])
        old_value = F.when(is_note, F.col("_note")).otherwise(old_value)
    year = F.col("fiscal_year").cast("string")
    if any(r.error == "TIME_GAP" for r in rules):
        is_gap = _per_rule([r.error == "TIME_GAP" for r in rules])
        year = F.when(is_gap, F.concat_ws("-", "_prev_year", "fiscal_year")).otherwise(year)
    tables = [None if r.error == "TIME_GAP" else schemas.tables_of(list(r.columns)) for r in rules]
    return shaped.select(
        "ticker",
        year.alias("fiscal_year"),
        _per_rule(tables).cast("string").alias("table_name"),
        "column_name",
        _per_rule([r.error for r in rules]).alias("error_type"),
        F.concat(*message).alias("message"),
        old_value.alias("old_value"),
        F.lit(None).cast("string").alias("new_value"),
    )


def with_previous_year(frame: DataFrame) -> DataFrame:
    """Add year and age of the firm's previous row.

    A firm has one row per fiscal year, so a window holds a few dozen rows however large the panel.
    """
    w = Window.partitionBy("ticker").orderBy("fiscal_year")
    return frame.withColumns({
        "_prev_year": F.lag("fiscal_year").over(w),
        "_prev_age": F.lag("firm_age").over(w),
    })


def quality_report(frame: DataFrame, flag_missing_age: bool = False) -> DataFrame:
    """Findings of all rules over a frame from ``qc_frame``."""
    return findings(with_previous_year(frame), all_rules(flag_missing_age))


def write_report(report: DataFrame, path: str) -> bool:
    """Write the report if there is anything in it; tells whether there was.

    The checks run once: findings are written to the shared folder, and the report is put in order from there.
    """
    from firmament.session import scratch
    from firmament.sources.sinks import export_csv, overwrite

    found = scratch(report.sparkSession, "findings")
    overwrite(report, found)
    report = report.sparkSession.read.schema(report.schema).parquet(found)
    if report.isEmpty():
        return False
    export_csv(report, path, ("ticker", "fiscal_year", "column_name", "error_type"))
    return True
