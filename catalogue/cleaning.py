"""Cell parsing and the standardised panel."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from firmament import schemas
from firmament.functions.notes import combined_note, note_part, with_innovation
from firmament.functions.numbers import sheet_number, statement_number, whole_number
from firmament.plans.standardise import SHEET_VARIABLES, standardise_panel
from firmament.standins import TestTables

# A price in cents, written in the ways a hand-filled sheet has them.
NUMBER_TEXTS = """
SELECT l_orderkey, l_linenumber, CASE l_orderkey % 12
    WHEN 0 THEN concat(n, ',', r, '.5') WHEN 1 THEN concat(n, '.', r, ',25')
    WHEN 2 THEN concat(n, '.', r, '.', r) WHEN 3 THEN concat(n, ',', r, ',', r)
    WHEN 4 THEN concat(n, ',', r) WHEN 5 THEN concat(' ', n, '.', r, ' ')
    WHEN 6 THEN concat('(', n, ',', r, ')') WHEN 7 THEN concat('-', n, ' VND')
    WHEN 8 THEN CASE l_linenumber % 4 WHEN 0 THEN 'N/A' WHEN 1 THEN '-' WHEN 2 THEN 'Thiếu' ELSE ' ' END
    WHEN 9 THEN concat(n, '-', r) WHEN 10 THEN concat(n, 'e5') ELSE concat('+', n, '.5') END AS cell
FROM (SELECT l_orderkey, l_linenumber, CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR) AS n,
             lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS r
      FROM lineitem) t
"""
# The same for numbers of printed statements.
STATEMENT_TEXTS = """
SELECT event_id, CASE event_id % 7
    WHEN 0 THEN concat(n, '.', r, '.', r) WHEN 1 THEN concat('(', n, '.', r, ')')
    WHEN 2 THEN concat(n, '.', r, ',56') WHEN 3 THEN '' WHEN 4 THEN '-'
    WHEN 5 THEN concat(' ', n, ' đ') ELSE concat(n, '-', r) END AS cell
FROM (SELECT event_id, CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) AS n,
             lpad(CAST(CAST(round(value * 100) AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS r FROM events) t
"""
INNOVATION_TEXTS = """
SELECT o_orderkey, CASE o_orderkey % 12
    WHEN 0 THEN '1 (new product)' WHEN 1 THEN '0' WHEN 2 THEN ' 1.0 ' WHEN 3 THEN '2' WHEN 4 THEN 'Yes'
    WHEN 5 THEN 'Không' WHEN 6 THEN concat('see page ', CAST(o_custkey AS VARCHAR)) WHEN 7 THEN 'n/a'
    WHEN 8 THEN '0 ( )' WHEN 9 THEN concat('1(', o_orderpriority, ')') WHEN 10 THEN 'có' ELSE '0.7' END AS product,
    CASE o_custkey % 5 WHEN 0 THEN '1 (a (b) c)' WHEN 1 THEN NULL WHEN 2 THEN 'FALSE'
    WHEN 3 THEN concat('0 (', o_orderstatus, ')') ELSE '1 x' END AS process
FROM orders
"""
SHEET = """
SELECT o_orderkey, CASE o_custkey % 20 WHEN 0 THEN ' ' WHEN 1 THEN concat(' t', CAST(o_custkey AS VARCHAR))
           ELSE concat('T', CAST(o_custkey AS VARCHAR)) END AS ticker,
       CASE o_orderkey % 9 WHEN 0 THEN 'nan' WHEN 1 THEN concat(y, '.0') ELSE y END AS fiscal_year,
       concat(n, ',5') AS net_sales, concat('-', n, '.25') AS dividend_payment,
       CASE o_orderkey % 4 WHEN 0 THEN '-' ELSE concat(n, '.00') END AS market_value_equity,
       CASE o_orderkey % 3 WHEN 0 THEN '' ELSE '12.5' END AS share_price,
       CASE o_orderkey % 5 WHEN 0 THEN '0' WHEN 1 THEN 'none' ELSE '8' END AS shares_outstanding,
       CAST(o_custkey AS VARCHAR) AS employees, '2.5' AS firm_age, '0,25' AS state_own,
       concat('1 (', o_orderpriority, ')') AS product_innovation, 'No' AS process_innovation
FROM (SELECT o_orderkey, o_custkey, o_orderpriority, CAST(year(o_orderdate) AS VARCHAR) AS y,
             CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS n FROM orders) t
"""
NOTE_TEXTS = """
SELECT event_id, CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN concat('Product: ', event_type)
    WHEN 2 THEN concat('Product: nan | Process: ', event_type) WHEN 3 THEN 'Process: None|other'
    WHEN 4 THEN concat('PRODUCT: a | product: ', CAST(user_id AS VARCHAR)) ELSE 'x' END AS note
FROM events
"""


def parse_numbers(spark: SparkSession, sf: str) -> DataFrame:
    number = sheet_number(F.col("cell"))
    return TestTables(spark, sf).sql(NUMBER_TEXTS, "lineitem").select(
        "l_orderkey", "l_linenumber", "cell", number.alias("number"), whole_number(number).alias("whole"))


def parse_statement_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return TestTables(spark, sf).sql(STATEMENT_TEXTS, "events").select(
        "event_id", "cell", statement_number(F.col("cell")).alias("number"))


def parse_innovation(spark: SparkSession, sf: str) -> DataFrame:
    cells = TestTables(spark, sf).sql(INNOVATION_TEXTS, "orders")
    return with_innovation(cells, {"product": F.col("product"), "process": F.col("process")}).drop("product", "process")


def merge_notes(spark: SparkSession, sf: str) -> DataFrame:
    return parse_innovation(spark, sf).select(
        "o_orderkey", combined_note(F.col("product_note"), F.col("process_note")).alias("note"))


def split_notes(spark: SparkSession, sf: str) -> DataFrame:
    note = F.col("note")
    return TestTables(spark, sf).sql(NOTE_TEXTS, "events").select(
        "event_id", note_part(note, "product:").alias("product"), note_part(note, "process:").alias("process"))


def standardise(spark: SparkSession, sf: str) -> DataFrame:
    return standardise_panel(TestTables(spark, sf).sql(SHEET, "orders"), keep=("o_orderkey",))


QUERIES = {
    "parse_numbers": parse_numbers,
    "parse_statement_numbers": parse_statement_numbers,
    "parse_innovation": parse_innovation,
    "merge_notes": merge_notes,
    "split_notes": split_notes,
    "standardise_panel": standardise,
}

_WORDS = "('', '-', 'na', 'n/a', 'null', 'none', 'thiếu', 'thieu', 'nan')"


def sheet_number_sql(cell: str) -> str:
    s = (f"CASE WHEN lower(trim({cell})) IN {_WORDS} THEN NULL "
         f"ELSE regexp_replace({cell}, '[^0-9+.,-]', '', 'g') END")
    plain = """list_transform([{s}], lambda s: CASE
        WHEN contains(s, ',') AND contains(s, '.') THEN
            CASE WHEN position('.' IN reverse(s)) < position(',' IN reverse(s)) THEN replace(s, ',', '')
                 ELSE replace(replace(s, '.', ''), ',', '.') END
        WHEN length(s) - length(replace(s, '.', '')) > 1 THEN concat(
            replace(s[1:length(s) - position('.' IN reverse(s))], '.', ''), '.', split_part(s, '.', -1))
        WHEN contains(s, ',') THEN concat(
            replace(s[1:length(s) - position(',' IN reverse(s))], ',', ''), '.', split_part(s, ',', -1))
        ELSE s END)[1]""".format(s=s)
    return (f"CASE WHEN regexp_full_match({plain}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') "
            f"THEN CAST({plain} AS DOUBLE) END")


def _innovation_sql(cell: str) -> tuple[str, str]:
    s = f"CASE WHEN lower(trim({cell})) IN {_WORDS} THEN NULL ELSE trim({cell}) END"
    pattern = "(?s)^([01])\\s*(?:\\((.*)\\))?$"
    flag = f"""list_transform([{s}], lambda s: CASE
        WHEN TRY_CAST(s AS DOUBLE) IS NOT NULL THEN
            CASE WHEN trunc(CAST(s AS DOUBLE)) IN (0, 1) THEN CAST(trunc(CAST(s AS DOUBLE)) AS INT) END
        WHEN regexp_matches(s, '{pattern}') THEN CAST(regexp_extract(s, '{pattern}', 1) AS INT)
        WHEN lower(s) IN ('yes', 'true', 'có', 'co') THEN 1
        WHEN lower(s) IN ('no', 'false', 'không', 'khong') THEN 0 END)[1]"""
    note = f"""list_transform([{s}], lambda s: CASE
        WHEN TRY_CAST(s AS DOUBLE) IS NOT NULL THEN NULL
        WHEN regexp_matches(s, '{pattern}') THEN nullif(trim(regexp_extract(s, '{pattern}', 2)), '')
        WHEN lower(s) IN ('yes', 'true', 'có', 'co', 'no', 'false', 'không', 'khong') THEN NULL ELSE s END)[1]"""
    return flag, note


def _note_sql(label: str) -> str:
    text = f"list_filter(string_split(lower(note), '|'), lambda p: contains(p, '{label}'))[-1]"
    for word in (label, "nan", "none"):
        text = f"replace({text}, '{word}', '')"
    return f"nullif(trim({text}), '')"


_PRODUCT, _PROCESS = _innovation_sql("product"), _innovation_sql("process")


def _standard_sql() -> str:
    given = {"net_sales": "net_sales", "dividend_cash_paid": "dividend_payment",
             "market_value_equity": "market_value_equity", "state_own": "state_own",
             "shares_outstanding": "shares_outstanding", "employees_count": "employees", "firm_age": "firm_age"}
    columns = []
    for c in SHEET_VARIABLES:
        if c == "share_price":
            continue
        whole = c in schemas.WHOLE_NUMBER_VARIABLES
        value = sheet_number_sql(given[c]) if c in given else "CAST(NULL AS DOUBLE)"
        columns.append(f"CAST(round_even({value}, 0) AS BIGINT) AS {c}" if whole else f"{value} AS {c}")
    flags, notes = _innovation_sql("product_innovation"), _innovation_sql("process_innovation")
    return f"""SELECT * EXCLUDE (given_price), coalesce(given_price, CASE WHEN shares_outstanding <> 0
            THEN market_value_equity / shares_outstanding END) AS share_price
        FROM (SELECT o_orderkey, nullif(upper(trim(ticker)), '') AS ticker,
            CAST(round_even({sheet_number_sql('fiscal_year')}, 0) AS BIGINT) AS fiscal_year,
            {', '.join(columns)}, {sheet_number_sql('share_price')} AS given_price,
            {flags[0]} AS product_innovation, {notes[0]} AS process_innovation,
            concat('Product: ', {flags[1]}) AS evidence_note FROM ({SHEET}) s) t
        WHERE ticker IS NOT NULL AND fiscal_year IS NOT NULL"""


ORACLES = {
    "parse_numbers": f"""SELECT l_orderkey, l_linenumber, cell, number, CAST(round_even(number, 0) AS BIGINT) AS whole
        FROM (SELECT *, {sheet_number_sql('cell')} AS number FROM ({NUMBER_TEXTS}) c) p""",
    "parse_statement_numbers": f"""SELECT event_id, cell,
        CASE WHEN regexp_full_match(d, '-?[0-9]+') THEN CAST(d AS DOUBLE) END AS number FROM (
            SELECT event_id, cell, regexp_replace(CASE WHEN contains(cell, '(') AND contains(cell, ')')
                THEN replace(cell, '(', '-') ELSE cell END, '[^0-9-]', '', 'g') AS d FROM ({STATEMENT_TEXTS}) s) p""",
    "parse_innovation": f"""SELECT o_orderkey, {_PRODUCT[0]} AS product_flag, {_PRODUCT[1]} AS product_note,
        {_PROCESS[0]} AS process_flag, {_PROCESS[1]} AS process_note FROM ({INNOVATION_TEXTS}) t""",
    "merge_notes": f"""SELECT o_orderkey, nullif(concat_ws(' | ', 'Product: ' || {_PRODUCT[1]},
        'Process: ' || {_PROCESS[1]}), '') AS note FROM ({INNOVATION_TEXTS}) t""",
    "split_notes": f"""SELECT event_id, {_note_sql('product:')} AS product, {_note_sql('process:')} AS process
        FROM ({NOTE_TEXTS}) t""",
    "standardise_panel": _standard_sql(),
}
