"""Table shapes, field lists and fixed values of the firm-year panel."""

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Column names, their warehouse types and the spellings accepted
# in input sheets. They name the data, so they are the same wherever it is read.
# --------------------------------------------------------------------------

MONEY = T.DecimalType(20, 2)
RATIO = T.DecimalType(10, 6)
PRICE = T.DecimalType(20, 4)
PER_SHARE = T.DecimalType(20, 6)

OWNERSHIP = {
    "managerial_inside_own": RATIO,
    "state_own": RATIO,
    "institutional_own": RATIO,
    "foreign_own": RATIO,
}
MARKET = {
    "shares_outstanding": T.LongType(),
    "share_price": PRICE,
    "market_value_equity": MONEY,
    "dividend_cash_paid": MONEY,
    "eps_basic": PER_SHARE,
}
CASHFLOW = {"net_cfo": MONEY, "capex": MONEY, "net_cfi": MONEY}
FINANCIAL = {
    "net_sales": MONEY,
    "total_assets": MONEY,
    "selling_expenses": MONEY,
    "general_admin_expenses": MONEY,
    "intangible_assets_net": MONEY,
    "manufacturing_overhead": MONEY,
    "net_operating_income": MONEY,
    "raw_material_consumption": MONEY,
    "merchandise_purchase_year": MONEY,
    "wip_goods_purchase": MONEY,
    "outside_manufacturing_expenses": MONEY,
    "production_cost": MONEY,
    "rnd_expenses": MONEY,
    "net_income": MONEY,
    "total_equity": MONEY,
    "total_liabilities": MONEY,
    "cash_and_equivalents": MONEY,
    "long_term_debt": MONEY,
    "current_assets": MONEY,
    "current_liabilities": MONEY,
    "growth_ratio": RATIO,
    "inventory": MONEY,
    "net_ppe": MONEY,
}
INNOVATION = {"product_innovation": T.IntegerType(), "process_innovation": T.IntegerType()}
META = {"employees_count": T.IntegerType(), "firm_age": T.IntegerType()}

# Columns that ride along with the variables of a fact table.
UNIT_COLUMNS = {"unit_scale": T.LongType(), "currency_code": T.StringType()}
FACT_COLUMNS = {
    "fact_ownership_year": {**OWNERSHIP, "note": T.StringType()},
    "fact_financial_year": {**UNIT_COLUMNS, **FINANCIAL},
    "fact_cashflow_year": {**UNIT_COLUMNS, **CASHFLOW},
    "fact_market_year": {
        "shares_outstanding": MARKET["shares_outstanding"],
        "price_reference": T.StringType(),
        "share_price": PRICE,
        "market_value_equity": MONEY,
        "dividend_cash_paid": MONEY,
        "eps_basic": PER_SHARE,
        "currency_code": T.StringType(),
    },
    "fact_innovation_year": {
        **INNOVATION,
        "evidence_source_id": T.IntegerType(),
        "evidence_note": T.StringType(),
    },
    "fact_firm_year_meta": dict(META),
}
# Columns the yearly load never writes, so an upsert keeps what is stored.
KEPT_ON_UPDATE = ("note", "created_at")

FACT_KEY = ("firm_id", "fiscal_year", "snapshot_id")
FIRM_YEAR = ("firm_id", "fiscal_year")
SHEET_KEY = ("ticker", "fiscal_year")

# Variables of the panel view, in the published order (38; the price is left out).
PANEL_VARIABLES = (
    "managerial_inside_own", "state_own", "institutional_own", "foreign_own",
    "shares_outstanding",
    "net_sales", "total_assets", "selling_expenses", "general_admin_expenses",
    "intangible_assets_net", "manufacturing_overhead", "net_operating_income",
    "raw_material_consumption", "merchandise_purchase_year", "wip_goods_purchase",
    "outside_manufacturing_expenses", "production_cost", "rnd_expenses",
    "product_innovation", "process_innovation",
    "net_income", "total_equity", "market_value_equity", "total_liabilities",
    "net_cfo", "capex", "net_cfi",
    "cash_and_equivalents", "long_term_debt", "current_assets", "current_liabilities",
    "growth_ratio", "inventory",
    "dividend_cash_paid", "eps_basic",
    "employees_count", "net_ppe", "firm_age",
)
# Which variables the view takes from which fact.
PANEL_SOURCE = {
    table: [c for c in columns if c in PANEL_VARIABLES] for table, columns in FACT_COLUMNS.items()
}

# Sheet column name -> warehouse column name.
SHEET_ALIASES = {
    "dividend_payment": "dividend_cash_paid",
    "eps": "eps_basic",
    "total_inventory": "inventory",
    "net_cash_from_operating": "net_cfo",
    "cash_flows_from_investing": "net_cfi",
    "capital_expenditure": "capex",
    "employees": "employees_count",
}
WHOLE_NUMBER_VARIABLES = ("shares_outstanding", "employees_count", "firm_age")

# Keys an extraction may carry for a firm-year.
EXTRACTION_KEYS = (
    "shares_outstanding", "total_sales_revenue", "net_sales", "total_assets",
    "selling_expenses", "general_admin_expenses", "intangible_assets_net",
    "manufacturing_overhead", "net_operating_income", "raw_material_consumption",
    "merchandise_purchase_year", "wip_goods_purchase", "outside_manufacturing_expenses",
    "production_cost", "rnd_expenses", "net_income", "total_equity", "total_liabilities",
    "net_cfo", "capex", "net_cfi", "cash_and_equivalents", "long_term_debt",
    "current_assets", "current_liabilities", "growth_ratio", "inventory",
    "dividend_cash_paid", "eps_basic", "net_ppe",
)

SOURCE_TYPES = ("market", "financial_statement", "ownership", "text_report", "manual")
FIRM_STATUSES = ("active", "delisted", "inactive")
PRICE_REFERENCES = ("close_year_end", "avg_year", "close_fiscal_year_end", "manual")
RESERVED_TICKER = "TEST"

# --------------------------------------------------------------------------
# Table schemas
# --------------------------------------------------------------------------


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()

EXTRACTION_CSV = _struct(
    ticker=_S, fiscal_year=_S, key=_S, label=_S, value=_S, unit=_S, currency=_S,
    source_snippet=_S, confidence=_S,
)
EXTRACTION_DOCUMENT = _struct(
    ticker=_S,
    records=T.ArrayType(_struct(
        fiscal_year=_L,
        items=T.ArrayType(_struct(
            key=_S, label=_S, value=_S, unit=_S, currency=_S, source_snippet=_S,
            confidence=T.DoubleType(),
        )),
    )),
)
DIM_EXCHANGE = _struct(exchange_id=_L, exchange_code=_S, exchange_name=_S)
DIM_INDUSTRY = _struct(industry_l2_id=_L, industry_l2_name=_S)
DIM_SOURCE = _struct(source_id=_L, source_name=_S, source_type=_S, provider=_S, note=_S)
DIM_FIRM = _struct(
    firm_id=_L, ticker=_S, company_name=_S, exchange_id=_L, industry_l2_id=_L,
    founded_year=_I, listed_year=_I, status=_S,
)
SNAPSHOT = _struct(
    snapshot_id=_L, snapshot_date=_D, period_from=_D, period_to=_D, fiscal_year=_I,
    source_id=_L, version_tag=_S, created_by=_S,
)
FINDING = _struct(
    ticker=_S, fiscal_year=_S, table_name=_S, column_name=_S, error_type=_S, message=_S,
    old_value=_S, new_value=_S,
)
OVERRIDE_LOG = _struct(
    override_id=_L, firm_id=_L, fiscal_year=_I, table_name=_S, column_name=_S, old_value=_S,
    new_value=_S, reason=_S, changed_by=_S, changed_at=T.TimestampType(),
)
DAILY_PRICE = _struct(ticker=_S, time=T.TimestampType(), close=T.DoubleType())
GROUPS = _struct(group=_S, ticker=_S)
COMPANY_SHEET = (
    "ticker", "company_name", "exchange_code", "exchange_name", "industry_l2_name",
    "founded_year", "listed_year",
)
SOURCE_SHEET = ("source_name", "source_type", "provider", "note")
VERSION_SHEET = ("source_name", "fiscal_year", "period_from", "period_to", "version_tag")


def fact_schema(table: str) -> T.StructType:
    """Schema of one yearly fact table, key first."""
    return _struct(firm_id=_L, fiscal_year=_I, snapshot_id=_L, **FACT_COLUMNS[table],
                   created_at=T.TimestampType())


def loaded_columns(table: str) -> list[str]:
    """Non-key columns the yearly load writes into ``table``."""
    return [c for c in FACT_COLUMNS[table] if c not in KEPT_ON_UPDATE]


def table_of(column: str) -> str | None:
    """Fact table that owns ``column`` (the first one when several do)."""
    return next((t for t in sorted(FACT_COLUMNS) if column in FACT_COLUMNS[t]), None)


def tables_of(columns: list[str]) -> str:
    """Sorted, comma-joined set of the fact tables that own ``columns``."""
    found = sorted({t for t in map(table_of, columns) if t})
    return ", ".join(found) if found else "Unknown"
