"""Every cell expression on the values that tell its rules apart."""

import datetime

import pytest
from pyspark.sql import functions as F

from firmament.functions import dates, notes, numbers, rendering, text


def values(table, inputs, expression, dtype="string"):
    df = table([(i, v) for i, v in enumerate(inputs)], f"i int, v {dtype}")
    return [r.out for r in df.select("i", expression(F.col("v")).alias("out")).orderBy("i").collect()]


SHEET_NUMBERS = [
    ("1,234.56", 1234.56), ("1.234,56", 1234.56), ("1.234.567", 1234.567), ("1,234,567", 1234.567),
    ("1,234", 1.234), ("1.5", 1.5), ("5-3", None), ("abc", None), ("1e5", 15.0), ("(1,234)", 1.234),
    ("\xa0 12 　", 12.0), ("-", None), ("Thiếu", None), ("N/A", None), ("", None), (None, None),
    ("+5", 5.0), ("5.", 5.0), (".5", 0.5), ("-7 VND", -7.0), ("1.234,56,7", None), ("1,234.5.6", None),
    ("1 234 567", 1234567.0), (".", None), ("1,234,567.8", 1234567.8), ("1.234.567,8", 1234567.8),
]
STATEMENT_NUMBERS = [
    ("1.234.567", 1234567.0), ("(1.234.567)", -1234567.0), ("1.234,56", 123456.0), ("-", None), ("", None),
    ("5-3", None), ("--5", None), ("12 đ", 12.0), (None, None), ("(5", 5.0), ("1,5", 15.0),
]


@pytest.mark.parametrize("expression, cases", [
    (numbers.sheet_number, SHEET_NUMBERS), (numbers.statement_number, STATEMENT_NUMBERS)])
def test_number_parsers(table, expression, cases):
    assert values(table, [c for c, _ in cases], expression) == [n for _, n in cases]


def test_many_cells_parse_like_one(table):
    df = table([tuple(c for c, _ in SHEET_NUMBERS)], ", ".join(f"c{i} string" for i in range(len(SHEET_NUMBERS))))
    got = df.select(numbers.sheet_numbers([F.col(c) for c in df.columns]).alias("n")).first().n
    assert got == [n for _, n in SHEET_NUMBERS]


def test_whole_numbers_round_half_to_even(table):
    assert values(table, [2.5, 3.5, -2.5, 2.4, 1e30, None], numbers.whole_number, "double") == [2, 4, -2, 2, None, None]


def test_text_to_double_takes_no_jvm_spellings(table):
    assert values(table, ["1d", "NaN", "Infinity", " 2020 ", "1e3", "2020.5"], numbers.text_to_double) == [
        None, None, None, 2020.0, 1000.0, 2020.5]


def test_years(table):
    assert values(table, ["2020", "2020.0", "fiscal_year", "2020.9", None], numbers.year_truncated) == [
        2020, 2020, None, 2020, None]
    assert values(table, ["2020", "2021.0", "x", ""], numbers.year_strict) == [2020, 2021, None, None]
    with pytest.raises(Exception, match="not a whole number"):
        values(table, ["2020.5"], numbers.year_strict)


def test_storage_casts_round_half_up_and_refuse_overflow(table):
    from firmament.schemas import MONEY, RATIO

    assert [str(v) for v in values(table, [1.005, 2.345], lambda c: numbers.stored_as(c, MONEY), "double")] == ["1.01", "2.35"]
    with pytest.raises(Exception, match="out of range"):
        values(table, [123456.0], lambda c: numbers.stored_as(c, RATIO), "double")


def test_relative_gap(table):
    df = table([(110.0, 100.0), (1.0, 0.0), (90.0, -100.0), (None, 1.0)], "a double, b double")
    got = [r[0] for r in df.select(numbers.relative_gap(F.col("a"), F.col("b"))).collect()]
    assert got == [0.1, 0.0, -1.9, None]


def test_implied_price(table):
    df = table([(None, 100.0, 8), (3.0, 100.0, 8), (None, 100.0, 0), (None, None, 8)], "p double, m double, s bigint")
    got = [r[0] for r in df.select(numbers.price_or_implied(F.col("p"), F.col("m"), F.col("s"))).collect()]
    assert got == [12.5, 3.0, None, None]


INNOVATION = [
    ("1 (note)", 1, "note"), ("1", 1, None), ("0", 0, None), ("1.0", 1, None), ("2", None, None), ("0.5", 0, None),
    ("-0.5", 0, None), ("yes", 1, None), ("Không", 0, None), ("CÓ", 1, None), ("some text", None, "some text"),
    ("1 (a (b))", 1, "a (b)"), ("0( )", 0, None), ("1 x", None, "1 x"), (None, None, None), ("-", None, None),
    (" 1\n(two\nlines) ", 1, "two\nlines"), ("1()", 1, None),
]


def test_innovation_cells(table):
    df = table([(i, c) for i, (c, _, _) in enumerate(INNOVATION)], "i int, c string")
    got = notes.with_innovation(df, {"x": F.col("c")}).orderBy("i").collect()
    assert [(r.c, r.x_flag, r.x_note) for r in got] == INNOVATION


def test_combined_note(table):
    df = table([(1, "a", "b"), (2, None, "b"), (3, "a", None), (4, None, None)], "i int, p string, q string").orderBy("i")
    got = [r[0] for r in df.select(notes.combined_note(F.col("p"), F.col("q"))).collect()]
    assert got == ["Product: a | Process: b", "Process: b", "Product: a", None]


def test_note_parts(table):
    cases = ["Product: u | Process: nan", "product: a|PRODUCT: b", "Product: none", "x", None, "Process: Nano none"]
    assert values(table, cases, lambda c: notes.note_part(c, "product:")) == ["u", "b", None, None, None, None]
    assert values(table, cases, lambda c: notes.note_part(c, "process:")) == [None, None, None, None, None, "o"]


def test_text_rules(table):
    cells = [" a ", " ", "", None, "NaN", " none "]
    assert values(table, cells, text.is_blank) == [False, True, True, True, False, False]
    assert values(table, cells, text.is_missing) == [False, True, True, True, True, True]
    assert values(table, [" vsc\t", " ", None], text.normal_ticker) == ["VSC", None, None]
    assert values(table, [" Thieu ", "-", "a-"], text.null_words_to_null) == [None, None, "a-"]


def test_rendering(table, spark):
    df = spark.sql("SELECT cast(-0.02 AS decimal(10,6)) a, cast(2458144481968 AS decimal(20,2)) b, cast(0 AS decimal(10,6)) c,"
                   " cast(10 AS bigint) d, cast(null AS decimal(4,2)) e")
    got = df.select(*[rendering.decimal_text(F.col(c)) for c in df.columns]).first()
    assert list(got) == ["-0.02", "2458144481968.0", "0.0", "10.0", None]
    assert values(table, [0.2654, 34.378], rendering.percent, "double") == ["26.54%", "3437.80%"]
    assert values(table, [712553730766.0, 2.5], rendering.grouped, "double") == ["712,553,730,766", "2"]
    assert values(table, [12000000.0, 1.5, None], rendering.sheet_text, "double") == ["12000000", "1.5", None]


def test_dates(table):
    day = datetime.date(2020, 1, 31)
    assert values(table, ["2020-01-31", "2020-01-31 10:00:00", "1/31/2020", "31/1/2020", "", None], dates.sheet_date) == [
        day, day, day, day, None, None]
    with pytest.raises(Exception, match="not a date"):
        values(table, ["soon"], dates.sheet_date)


def test_sheet_text_keeps_numbers_of_all_magnitudes(table):
    numbers_in = [m * 10.0 ** e for e in range(-9, 18) for m in (1.0, 1.23456785, -7.1, 9.87654321012)]
    texts = values(table, numbers_in, rendering.sheet_text, "double")
    assert all("E" not in t for t in texts) and [float(t) for t in texts] == numbers_in
    assert values(table, [12345678.5, 0.0001], rendering.sheet_text, "double") == ["12345678.5", "0.0001"]


def test_forms_of_dates(table):
    forms = ["31-12-2020", "12-31-2020", "2020/12/31", "Dec 31, 2020", "20201231", "12/31/20", "31/12/2020", "2020-12-31"]
    assert {str(d) for d in values(table, forms, dates.sheet_date, "string")} == {"2020-12-31"}


def test_part_is_a_name_outside_csv_folders(table):
    from firmament.sources.documents import document_name
    paths = ["s3://b/PNJ/part-1_2021.csv", "s3://b/x_2021.csv/part-0000-a.csv"]
    assert values(table, paths, document_name, "string") == ["part-1_2021.csv", "x_2021.csv"]
