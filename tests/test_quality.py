"""Quality rules on the known findings of the firm kept for tests, and on their edges."""

import decimal

from firmament import schemas
from firmament.plans import quality as q

D = decimal.Decimal
FRAME = {"ticker": "string", "fiscal_year": "int", "founded_year": "int", "share_price": "decimal(20,4)",
         "evidence_note": "string"}
TYPES = {c: t.simpleString() for cols in schemas.FACT_COLUMNS.values() for c, t in cols.items()}
FRAME.update({c: TYPES[c] for c in schemas.PANEL_VARIABLES})


def frame(spark, *rows):
    """Rows with the given columns, flags set and noted so that nothing else is found."""
    base = {"ticker": "TEST", "product_innovation": 1, "process_innovation": 1, "evidence_note": "Product: u | Process: v"}
    out = []
    for r in rows:
        r = {**base, **r}
        out.append(tuple(D(str(r[c])) if r.get(c) is not None and t.startswith("decimal") else r.get(c)
                         for c, t in FRAME.items()))
    return spark.createDataFrame(out, ", ".join(f"{c} {t}" for c, t in FRAME.items()))


def report(spark, *rows, **options):
    got = q.quality_report(frame(spark, *rows), **options).collect()
    return [r.asDict() for r in got]


def one(spark, **row):
    found = report(spark, {"fiscal_year": 2022, **row})
    assert len(found) == 1, found
    return found[0]


def test_gap_in_years(spark):
    found = report(spark, {"fiscal_year": 2022}, {"fiscal_year": 2020})
    assert found == [{"ticker": "TEST", "fiscal_year": "2020-2022", "table_name": None, "column_name": "fiscal_year",
                      "error_type": "TIME_GAP", "message": "Dữ liệu bị đứt quãng thời gian", "old_value": None,
                      "new_value": None}]


def test_balance(spark):
    f = one(spark, total_assets=2458144481968, total_liabilities=1000000000000, total_equity=2170698212734)
    assert f["error_type"] == "ACCOUNTING_IMBALANCE" and f["table_name"] == "fact_financial_year"
    assert f["column_name"] == "total_assets/total_liabilities/total_equity"
    assert f["message"] == "Bảng cân đối không khớp. Chênh lệch: 712,553,730,766 (28.99%)"
    assert f["old_value"] == "(2458144481968.0, 1000000000000.0, 2170698212734.0)"
    f = one(spark, total_assets=123433000000, total_liabilities=1165609976787, total_equity=3201200347306)
    assert f["message"].endswith("4,243,377,324,093 (3437.80%)")
    assert report(spark, {"fiscal_year": 2020, "total_assets": 0, "total_liabilities": 1, "total_equity": 1}) == []


def test_market_value(spark):
    f = one(spark, market_value_equity=1635870000000, shares_outstanding=121269397, share_price=17070)
    assert (f["error_type"], f["message"]) == ("INCONSISTENT", "Sai lệch vốn hóa (26.54%) so với tính toán")
    assert f["old_value"] == "(1635870000000.0, 121269397.0, 17070.0)"
    found = report(spark, {"fiscal_year": 2023, "market_value_equity": 1890730000000, "shares_outstanding": 0,
                           "share_price": 14160})
    by_type = {f["error_type"]: f for f in found}
    assert set(by_type) == {"INCONSISTENT", "INVALID_VALUE"}
    assert "(100.00%)" in by_type["INCONSISTENT"]["message"]
    assert by_type["INVALID_VALUE"]["old_value"] == "0"
    assert by_type["INVALID_VALUE"]["message"] == "Số lượng cổ phiếu phải lớn hơn 0"
    assert report(spark, {"fiscal_year": 2023, "market_value_equity": -5, "shares_outstanding": 1, "share_price": 9}) == []


def test_components(spark):
    f = one(spark, net_ppe=2007397494749, intangible_assets_net=5880029246, total_assets=123433000000)
    assert f["column_name"] == "net_ppe/intangible_assets_net/total_assets" and f["error_type"] == "COMPONENT_ERROR"
    assert f["old_value"] == "(2007397494749.0, 5880029246.0, 123433000000.0)"
    f = one(spark, cash_and_equivalents=1111546631380000, inventory=47470252892, current_assets=1811557308602)
    assert f["message"] == "Tổng tiền mặt và hàng tồn kho vượt quá tài sản ngắn hạn"
    assert one(spark, current_assets=2, total_assets=1)["old_value"] == "(2.0, 1.0)"
    assert one(spark, long_term_debt=2, current_liabilities=2, total_liabilities=3)["table_name"] == "fact_financial_year"
    assert one(spark, net_income=2, net_sales=1)["message"] == "Lợi nhuận ròng vượt quá doanh thu"


def test_notes(spark):
    f = one(spark, process_innovation=0, evidence_note="Product: u | Process: u")
    assert f["error_type"] == "UNEXPECTED_PROCESS_NOTE" and f["old_value"] == "Product: u | Process: u"
    assert f["message"] == ('Không đổi mới QT (0) nhưng "process:" lại có thuyết minh. '
                            '(Gốc: "Product: u | Process: u")')
    f = one(spark, evidence_note="Product: u | Process: nan")
    assert f["error_type"] == "MISSING_PROCESS_NOTE" and f["table_name"] == "fact_innovation_year"
    assert one(spark, evidence_note="Process: v")["error_type"] == "MISSING_PRODUCT_NOTE"
    assert one(spark, product_innovation=0)["error_type"] == "UNEXPECTED_PRODUCT_NOTE"


def test_ranges(spark):
    f = one(spark, foreign_own=-0.02)
    assert (f["error_type"], f["message"], f["old_value"]) == ("RANGE_ERROR", "Giá trị -0.02 nằm ngoài khoảng [0,1]", "-0.02")
    assert report(spark, {"fiscal_year": 2020, "foreign_own": 0, "state_own": 1}) == []
    assert one(spark, growth_ratio=5.5)["message"] == "Tỷ lệ tăng trưởng 5.5 bất thường"
    assert report(spark, {"fiscal_year": 2020, "growth_ratio": 5.0}, {"fiscal_year": 2021, "growth_ratio": -0.95}) == []
    assert one(spark, net_sales=-1)["message"] == "Giá trị net_sales không được âm"
    assert one(spark, capex=1)["table_name"] == "fact_cashflow_year"
    assert one(spark, employees_count=-3)["old_value"] == "-3"


def test_flags(spark):
    f = one(spark, product_innovation=None)
    assert f["message"] == "Biến product_innovation đang bị để trống (NULL). Chỉ chấp nhận 0 hoặc 1."
    f = one(spark, process_innovation=2)
    assert f["message"] == "Giá trị process_innovation không hợp lệ (hiện tại là 2). Chỉ chấp nhận 0 hoặc 1."


def test_ages(spark):
    f = one(spark, founded_year=2000, firm_age=20)
    assert (f["error_type"], f["message"]) == ("AGE_LOGIC_ERROR", "Không khớp năm thành lập. Có: 20, Tính toán: 22")
    assert one(spark, founded_year=2030, firm_age=1)["message"].endswith("Tính toán: None")
    found = report(spark, {"fiscal_year": 2020, "firm_age": 5}, {"fiscal_year": 2021, "firm_age": 5})
    assert [f["message"] for f in found] == ["Tuổi không tăng tiến đều (Năm trước: 5, Năm nay: 5)"]


def test_missing_ages_are_reported_only_on_request(spark):
    rows = [{"fiscal_year": 2020, "founded_year": 2000}, {"fiscal_year": 2021, "firm_age": 5}]
    assert report(spark, *rows) == []
    assert sorted(f["error_type"] for f in report(spark, *rows, flag_missing_age=True)) == [
        "AGE_LOGIC_ERROR", "PROGRESSION_ERROR"]


def test_report_is_written_only_with_findings(spark, tmp_path):
    clean = q.quality_report(frame(spark, {"fiscal_year": 2020}))
    assert not q.write_report(clean, str(tmp_path / "none")) and not (tmp_path / "none").exists()
    broken = q.quality_report(frame(spark, {"fiscal_year": 2020, "net_sales": -1}))
    assert q.write_report(broken, str(tmp_path / "some"))
    from firmament.sources.tables import read_findings

    assert read_findings(spark, str(tmp_path / "some")).first().old_value == "-1.0"


def test_owning_tables():
    assert schemas.table_of("net_sales") == "fact_financial_year"
    assert schemas.tables_of(["share_price", "net_sales"]) == "fact_financial_year, fact_market_year"
    assert schemas.tables_of(["nothing"]) == "Unknown"
