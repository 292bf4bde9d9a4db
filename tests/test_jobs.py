"""Jobs on small tables: repeats change nothing, order does not matter, checks refuse, hot keys hold."""

import datetime
import os
import random

import pytest
from pyspark.sql import functions as F, types as T

from firmament import schemas
from firmament.operators import identifiers, keys
from firmament.operators.lookups import with_lookup
from firmament.operators.upsert import absent_rows, action_counts, insert_if_absent, upsert
from firmament.operators.versions import BY_DATE, BY_ID, latest_rows
from firmament.plans import consolidation, corrections, dimensions, export, facts, panel, per_file, prices, review, snapshots
from firmament.plans.daily import run_reviews
from firmament.plans.standardise import standardise_panel
from firmament.sources import documents, extractions, quotes, sinks, tables
from firmament.streaming.incremental import ingest_new_extractions


def rows(df, *order):
    return sorted((tuple(r) for r in df.collect()), key=str)


# -- versions and panel ----------------------------------------------------------------------------

@pytest.fixture
def warehouse(table):
    """Two firms; the newest date and the greatest id disagree; one row of an unknown snapshot."""
    snaps = table([(1, datetime.date(2024, 5, 1)), (2, datetime.date(2024, 1, 1)), (3, datetime.date(2024, 1, 1))],
                  "snapshot_id bigint, snapshot_date date")
    firms = table([(1, "AAA", 2000), (2, "TEST", 2010)], "firm_id bigint, ticker string, founded_year int")

    def fact(name, data, **columns):
        df = table(data, "firm_id bigint, fiscal_year int, snapshot_id bigint, v double")
        df = df.withColumns({c: F.col("v").cast(schemas.FACT_COLUMNS[name][c]) for c in columns.values()})
        return keys.with_columns_of(df.drop("v"), schemas.FACT_COLUMNS[name])

    data = {
        "fact_financial_year": ([(1, 2020, 1, 10.0), (1, 2020, 2, 20.0), (1, 2020, 3, 30.0)], "net_sales"),
        "fact_market_year": ([(1, 2020, 1, 1.0), (1, 2020, 3, 3.0), (2, 2021, 2, 5.0)], "share_price"),
        "fact_ownership_year": ([(1, 2019, 99, 0.5)], "state_own"),
        "fact_cashflow_year": ([(7, 2020, 1, 1.0)], "capex"),
        "fact_innovation_year": ([(2, 2021, 2, 1.0), (2, 2021, 3, 0.0)], "product_innovation"),
        "fact_firm_year_meta": ([(2, 2021, 3, 11.0)], "firm_age"),
    }
    return {n: fact(n, d, c=c) for n, (d, c) in data.items()}, snaps, firms


def test_panel_takes_newest_by_date_and_all_keys(warehouse):
    got = {(r.ticker, r.fiscal_year): r for r in panel.latest_panel(*warehouse).collect()}
    assert set(got) == {("AAA", 2019), ("AAA", 2020), ("TEST", 2021)}  # the unknown firm 7 is left out
    assert got["AAA", 2020].net_sales == 10
    assert got["AAA", 2019].state_own is None  # its snapshot is unknown, its key stays
    assert got["TEST", 2021].product_innovation == 0 and got["TEST", 2021].firm_age == 11
    assert tuple(panel.latest_panel(*warehouse).columns[3:]) == schemas.PANEL_VARIABLES


def test_quality_frame_takes_price_by_id(warehouse):
    got = {(r.ticker, r.fiscal_year): r for r in panel.qc_frame(*warehouse).collect()}
    assert got["AAA", 2020].share_price == 3 and got["AAA", 2020].founded_year == 2000
    assert got["TEST", 2021].share_price == 5


def test_two_policies_differ(warehouse):
    fact, snaps, _ = warehouse
    by_date = latest_rows(fact["fact_financial_year"], snaps, BY_DATE).first()
    by_id = latest_rows(fact["fact_financial_year"], policy=BY_ID).first()
    assert (by_date.snapshot_id, by_id.snapshot_id) == (1, 3)


def test_export_leaves_out_the_test_firm_in_key_order(warehouse, spark, tmp_path):
    export.export_panel(panel.latest_panel(*warehouse), str(tmp_path / "out"))
    back = spark.read.option("header", "true").csv(str(tmp_path / "out"))
    assert [(r.ticker, r.fiscal_year) for r in back.collect()] == [("AAA", "2019"), ("AAA", "2020")]


def test_hot_firm_year_shrinks_before_the_shuffle(spark):
    """A third of all rows in one firm-year: both forms reduce it within the map tasks."""
    fact = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("firm_id"), F.lit(2020).alias("fiscal_year"),
        F.col("id").alias("snapshot_id"), F.col("id").cast("double").alias("v"))
    plan = latest_rows(fact, policy=BY_ID)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    hot = latest_rows(fact, policy=BY_ID).filter("firm_id = 1").first()
    assert hot.snapshot_id == 29_997


# -- ids, upsert, insert ----------------------------------------------------------------------------

@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_ids_follow_arrival_after_the_greatest(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    new = spark.range(0, 100).select((F.col("id") * 37 % 101).alias("seq"))
    old = spark.sql("SELECT 41L AS id")
    try:
        got = identifiers.assign_ids(new, "id", "seq", old).orderBy("seq").collect()
        none = identifiers.assign_ids(new.limit(0), "id", "seq", old)
        assert none.isEmpty() and none.columns == ["seq", "id"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r.id for r in got] == list(range(42, 142))


def test_upsert(table):
    target = table([(1, 2020, "a", "kept"), (2, 2020, "b", None), (3, 2019, "c", "other")],
                   "k int, y int, v string, note string")
    batch = table([(1, 2020, "x", 1), (1, 2020, None, 2), (4, 2020, "new", 3)], "k int, y int, v string, seq int")
    once = upsert(target, batch, ("k", "y"), "seq", {"note": F.lit("fresh")})
    assert rows(once.table) == [(1, 2020, None, "kept"), (2, 2020, "b", None), (3, 2019, "c", "other"),
                                (4, 2020, "new", "fresh")]
    assert rows(action_counts({"t": once.changes})) == [("t", 1, 1)]
    twice = upsert(once.table, batch, ("k", "y"), "seq", {"note": F.lit("later")})
    assert rows(twice.table) == rows(once.table)
    touched = upsert(target, batch, ("k", "y"), "seq", touched="y")
    assert (3, 2019, "c", "other") not in rows(touched.table) and len(rows(touched.table)) == 3


def test_insert_if_absent_twice(table):
    new = table([("hose ", 1), ("HOSE", 2), ("HNX", 3), ("hnx", 4)], "code string, seq int")
    old = table([("Hose",)], "code string")
    first = insert_if_absent(new, old, "code", "seq")
    assert rows(first) == [("HNX", 3)]
    assert insert_if_absent(new, old.union(first.select("code")), "code", "seq").isEmpty()


def test_repeated_keys_of_the_stored_side_cost_nothing(spark):
    existing = spark.range(3000).select((F.col("id") % 2).alias("k"))
    assert rows(absent_rows(spark.range(4).withColumnRenamed("id", "k"), existing, ("k",))) == [(2,), (3,)]


# -- dimensions, snapshots, facts -------------------------------------------------------------------

COMPANY = "ticker string, company_name string, exchange_code string, exchange_name string, industry_l2_name string, " \
          "founded_year string, listed_year string"


def empty_dims(spark):
    return {"dim_exchange": spark.createDataFrame([], schemas.DIM_EXCHANGE),
            "dim_industry_l2": spark.createDataFrame([], schemas.DIM_INDUSTRY),
            "dim_data_source": spark.createDataFrame([], schemas.DIM_SOURCE),
            "dim_firm": spark.createDataFrame([], schemas.DIM_FIRM)}


def test_dimensions_load_once(spark, table, tmp_path):
    companies = table([("AAA", "A", "HOSE", "Ho Chi Minh", "Steel", "1990", None), ("BBB", "B", "HOSE", "later name", None, "1991.0", "2001"),
                       ("aaa", "again", "HNX", "Ha Noi", "Steel", None, None)], COMPANY).coalesce(1)
    sources = table([("s1", "market", "p", None)], "source_name string, source_type string, provider string, note string")
    paths = {n: str(tmp_path / n) for n in empty_dims(spark)}
    for name, df in empty_dims(spark).items():
        sinks.overwrite(df, paths[name])
    new = dimensions.load_dimensions(companies, sources, {n: spark.read.parquet(p) for n, p in paths.items()})
    assert rows(new.dim_exchange) == [(1, "HOSE", "Ho Chi Minh"), (2, "HNX", "Ha Noi")]
    assert [(r.ticker, r.status, r.founded_year) for r in new.dim_firm.collect()] == [("AAA", "active", 1990)]
    assert rows(new.rejected_firms) == [("BBB", "HOSE", None, "unknown industry")]
    dimensions.store_dimensions(new, paths, str(tmp_path / "staging"))
    sinks.StagedBatch.resume(spark, str(tmp_path / "staging"))  # nothing is added twice
    again = dimensions.load_dimensions(companies, sources, {n: spark.read.parquet(p) for n, p in paths.items()})
    assert all(df.isEmpty() for df in again[:4])
    broken = dimensions.broken_values(companies, sources.withColumn("source_type", F.lit("rumour")))
    assert rows(broken) == [("source_info", "s1")]


def test_cut_off_publish_is_resumed(spark, table, tmp_path):
    live, staging = {n: str(tmp_path / n) for n in "abc"}, str(tmp_path / "staging")
    sinks.overwrite(table([(1, "old")], "id bigint, v string"), live["a"])
    sinks.overwrite(table([(2020, 1), (2021, 2)], "fiscal_year int, v int"), live["c"], ("fiscal_year",))
    batch = sinks.StagedBatch(spark, staging)
    batch.stage("a", table([(1, "x"), (2, "new")], "id bigint, v string"), live["a"], ("id",))
    batch.stage("b", table([(7,)], "id bigint"), live["b"], ("id",))
    staged = batch.stage("c", table([(2020, 5, "update"), (2022, 6, None)], "fiscal_year int, v int, _action string"), live["c"])
    batch.stage("d", table([], "fiscal_year int, v int"), str(tmp_path / "d"))
    assert rows(staged.filter("_action IS NOT NULL").select("v")) == [(5,)]
    with pytest.raises(keys.RejectedBatch, match="no sealed batch"):
        sinks.StagedBatch.resume(spark, staging)
    types = {"a": "id bigint, v string", "b": "id bigint", "c": "v int, fiscal_year int"}

    def seen():
        found = sinks.StagedBatch.tables(spark, staging, live, {n: T.StructType.fromDDL(t) for n, t in types.items() if n in live})
        return {n: rows(df.select(*sorted(df.columns))) for n, df in found.items()}

    old = {"a": [(1, "old")], "b": [], "c": [(2020, 1), (2021, 2)]}
    new = {"a": [(1, "old"), (2, "new")], "b": [(7,)], "c": [(2020, 5), (2021, 2), (2022, 6)]}
    assert seen() == old
    (tmp_path / "b").write_text("no table")
    live.pop("b")
    with pytest.raises(Exception, match="CANNOT_READ|FAILED_READ|not a Parquet"):
        batch.publish()  # ends after the first table: the second cannot be read
    assert not sinks.StagedBatch.is_published(spark, staging)
    # A part is published, and readers have all of the batch.
    assert rows(spark.read.parquet(live["a"])) == new["a"] and rows(spark.read.parquet(live["c"]).select("fiscal_year", "v")) == old["c"]
    assert seen() == {n: r for n, r in new.items() if n != "b"}
    with pytest.raises(keys.RejectedBatch, match="sealed"):
        sinks.StagedBatch(spark, staging)
    (tmp_path / "b").unlink()
    live["b"] = str(tmp_path / "b")
    assert seen() == new
    for _ in range(2):
        sinks.StagedBatch.resume(spark, staging)
        assert rows(spark.read.parquet(live["a"])) == [(1, "old"), (2, "new")]
        assert rows(spark.read.parquet(live["b"])) == [(7,)]
        assert rows(spark.read.parquet(live["c"]).select("fiscal_year", "v")) == [(2020, 5), (2021, 2), (2022, 6)]
        assert seen() == new
    assert sinks.StagedBatch.is_published(spark, staging)


def test_snapshot_batch_is_refused_whole(spark, table, tmp_path):
    versions = table([("s1", "2020", None, None, "v1"), ("s1", "2021", "2021-01-01", None, "v1"), ("s1", "2021", None, None, None),
                      ("s1", "2021", None, None, None), ("nobody", "2021", None, None, "v1")],
                     "source_name string, fiscal_year string, period_from string, period_to string, version_tag string").coalesce(1)
    sources = table([(5, "S1")], "source_id bigint, source_name string")
    path = str(tmp_path / "snapshots")
    sinks.overwrite(spark.createDataFrame([], schemas.SNAPSHOT), path)
    new = snapshots.create_snapshots(versions, sources, spark.read.parquet(path), "2026-01-01")
    assert new.skipped.count() == 1
    snapshots.store_snapshots(new, path)  # absent tags do not clash
    assert sorted(r.snapshot_id for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4]
    with pytest.raises(keys.RejectedBatch, match="exist already"):
        snapshots.store_snapshots(snapshots.create_snapshots(versions, sources, spark.read.parquet(path), "2026-01-01"), path)
    assert spark.read.parquet(path).count() == 4
    assert snapshots.create_snapshots(versions, sources, spark.read.parquet(path), "2026-01-02").clashes.isEmpty()


@pytest.fixture
def load(spark, table, tmp_path):
    """Runs a fact load of master sheet rows and returns a reader of the stored tables; one of them has no folder before its first load."""
    paths = {n: str(tmp_path / n) for n in ("fact_financial_year", "fact_innovation_year")}
    sinks.overwrite(spark.createDataFrame([], schemas.fact_schema("fact_financial_year")), paths["fact_financial_year"], ("fiscal_year",))
    dims = {"dim_firm": table([(1, "AAA"), (2, "BBB")], "firm_id bigint, ticker string"),
            "dim_data_source": table([(6, "Src")], "source_id bigint, source_name string"),
            "fact_data_snapshot": table([(10, datetime.date(2025, 1, 1), 2020, 6, "v1"), (11, datetime.date(2025, 2, 1), 2020, 6, "v1"),
                                         (12, datetime.date(2025, 2, 1), 2021, 6, "v1")],
                                        "snapshot_id bigint, snapshot_date date, fiscal_year int, source_id bigint, version_tag string")}
    runs = iter(range(100))

    def run(sheet, source="src", tag="V1"):
        sheet = tables.with_row_order(table(sheet, "ticker string, fiscal_year string, net_sales string, eps string, product_innovation string").coalesce(1))
        counts = facts.load_facts(spark, standardise_panel(sheet, keep=("_row",)), dims, paths, str(tmp_path / f"stage{next(runs)}"),
                                  source, tag, "2026-01-01")
        return rows(counts), lambda n: spark.read.schema(schemas.fact_schema(n)).parquet(paths[n])

    return run


def test_load_facts(load):
    counts, stored = load([("aaa", "2020", "1", "0.5", "1 (x)"), ("AAA ", "2020.0", "1,5", None, "no"), ("BBB", "2021", "7", None, None)])
    assert ("fact_financial_year", 2, 0) in counts
    got = {(r.firm_id, r.fiscal_year): r for r in stored("fact_financial_year").collect()}
    assert str(got[1, 2020].net_sales) == "1.50" and got[1, 2020].snapshot_id == 11 and got[1, 2020].currency_code == "VND"
    innovation = {r.firm_id: r for r in stored("fact_innovation_year").collect()}
    assert (innovation[1].product_innovation, innovation[1].evidence_note, innovation[1].evidence_source_id) == (0, None, 6)
    # The same batch again changes nothing, another one overwrites with NULL and leaves other years alone.
    before = rows(stored("fact_financial_year"))
    counts, stored = load([("aaa", "2020", "1", "0.5", "1 (x)"), ("AAA ", "2020.0", "1,5", None, "no"), ("BBB", "2021", "7", None, None)])
    assert ("fact_financial_year", 0, 2) in counts and rows(stored("fact_financial_year")) == before
    load([("AAA", "2020", "", None, None)])
    got = {(r.firm_id, r.fiscal_year): r.net_sales for r in stored("fact_financial_year").collect()}
    assert got[1, 2020] is None and got[2, 2021] == 7


@pytest.mark.parametrize("sheet, options, message", [
    ([("ZZZ", "2020", "1", None, None)], {}, "unknown ticker"),
    ([("AAA", "1999", "1", None, None)], {}, "no snapshot for year"),
    ([("AAA", "2020", "1", None, None)], {"source": "other"}, "unknown source"),
    ([("AAA", "2020", "1", None, None)], {"tag": "v9"}, "no snapshot for year"),
])
def test_load_is_refused_whole(load, sheet, options, message):
    _, stored = load([("AAA", "2020", "5", None, None)])
    with pytest.raises(keys.RejectedBatch, match=message):
        load([("BBB", "2020", "1", None, None), *sheet], **options)
    assert stored("fact_financial_year").count() == 1


def test_a_stored_batch_asks_once_a_ticker_for_its_firm(spark, table, monkeypatch, tmp_path):
    """Collation keys are costly, so rows are joined by the ticker as it is written."""
    looked_up = []
    monkeypatch.setattr(facts, "with_lookup", lambda df, *args, **how: looked_up.append(rows(df)) or with_lookup(df, *args, **how))
    sheet = table([(t, 2020, i) for i, t in enumerate(["AAA"] * 50 + ["ÁAA"] * 50 + ["BBB"] * 50)], "ticker string, fiscal_year bigint, _row bigint")
    sheet = standardise_panel(sheet, keep=("_row",))
    dims = {"dim_firm": table([(1, "aaa"), (2, "BBB"), (3, "bbb "), (None, "CCC")], "firm_id bigint, ticker string"),
            "dim_data_source": table([(6, "Src")], "source_id bigint, source_name string"),
            "fact_data_snapshot": table([(11, datetime.date(2025, 2, 1), 2020, 6, "v1")],
                                        "snapshot_id bigint, snapshot_date date, fiscal_year int, source_id bigint, version_tag string")}
    name = "fact_firm_year_meta"
    counts = facts.load_facts(spark, sheet, dims, {name: str(tmp_path / name)}, str(tmp_path / "stage"), "src", "v1", "2026-01-01")
    assert [len(r) for r in looked_up] == [3]
    # Other spellings of a firm meet, a name of two firms gives a row to each, and one without id is known.
    assert rows(counts) == [(name, 3, 0)]
    kept = spark.read.parquet(str(tmp_path / "stage" / "resolved")).groupBy("firm_id").count()
    assert rows(kept) == [(1, 100), (2, 50), (3, 50)]
    assert [(r.ticker, r._known) for r in facts.ticker_firms(table([("CCC",), ("x",), (None,)], "ticker string"), dims["dim_firm"]).orderBy("ticker").collect()] == [
        (None, None), ("CCC", True), ("x", None)]


def test_standardise_needs_its_keys(table):
    with pytest.raises(keys.RejectedBatch, match="fiscal_year"):
        standardise_panel(table([("A",)], "ticker string"))
    got = standardise_panel(table([("a ", 2020.0, 5.0)], "` ticker ` string, fiscal_year double, employees double")).first()
    assert (got.ticker, got.fiscal_year, got.employees_count, got.net_sales) == ("A", 2020, 5, None)


# -- consolidation ----------------------------------------------------------------------------------

LONG = "ticker string, fiscal_year string, key string, value string, source_file string, seq bigint"


def test_consolidate_first_in_file_last_over_files(table):
    long = [("aaa", "2020", "a", "1", "x/f1_2020.csv", 1), ("AAA", "2020", "a", "2", "x/f1_2020.csv", 0),
            ("AAA", "2020", "b", "(3)", "x/f1_2020.csv", 3), ("AAA", "2020", "b", "9", "x/f1_2020.csv", 4),
            ("AAA", "2020", "b", "-", "x/f2_2020.csv", 5), ("AAA", "2021", "a", "7", "x/f2_2020.csv", 6),
            ("AAA", "2019", "c", "-", "x/f3_2019.csv", 7), ("ticker", "fiscal_year", "key", "value", "x/f1_2020.csv", -1)]
    for order in (long, long[::-1]):
        got = consolidation.consolidate(table(order, LONG)).collect()
        assert [r.asDict() for r in got] == [{"ticker": "AAA", "fiscal_year": 2020, "a": 1.0, "b": -3.0}]


def test_hot_cell_in_consolidation(spark):
    """A third of all rows for one cell: the result is whole and the cell is combined before the shuffle."""
    long = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), "id")).alias("ticker"), F.lit("2020").alias("fiscal_year"),
        F.lit("a").alias("key"), F.col("id").cast("string").alias("value"), F.lit("f_2020.csv").alias("source_file"), F.col("id").alias("seq"))
    wide = consolidation.consolidate(long, ["a"])
    assert wide.filter("ticker = 'HOT'").first().a == 0.0 and wide.count() == 20_001
    assert "partial_max_by" in wide._jdf.queryExecution().executedPlan().toString()


def test_append_new_keys_twice(table):
    existing = table([("AAA", 2020, "edited")], "ticker string, fiscal_year int, a string")
    new = table([("AAA", 2020, 1.0, 2.0), ("BBB", 2020, 3.0, None)], "ticker string, fiscal_year int, a double, b double")
    once = consolidation.append_new_keys(existing, new)
    assert rows(once) == [("AAA", 2020, "edited", None), ("BBB", 2020, "3", "")]
    assert rows(consolidation.append_new_keys(once, new)) == rows(once)


def test_documents_on_disk(spark, tmp_path):
    for name, body in (("AAA_2020.csv", 'ticker,fiscal_year,key,label,value,unit,currency,source_snippet,confidence\n'
                                        'AAA,2020,a,l,1.000,,,"two\nlines, ""quoted""",1\nAAA,2020,a,l,5,,,,\n'),
                       ("notes.csv", "AAA,2020,a,l,9,,,,\n"), ("AAA_2021.csv", "AAA,2020,a,l,9,,,,\n"), ("x/B_2020.csv", "NA,2020,a,l,9,,,,\n")):
        file = tmp_path / "in" / name
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(body, encoding="utf-8")
    long = extractions.read_extraction_csvs(spark, str(tmp_path / "in"))
    assert [r.asDict() for r in consolidation.consolidate(long).collect()] == [{"ticker": "AAA", "fiscal_year": 2020, "a": 1000.0}]
    listed = documents.list_csvs(spark, str(tmp_path / "in")).select("path").union(spark.sql("SELECT 'gone_2020.csv'"))
    counts = consolidation.run_counters(listed, long).first().asDict()
    assert counts == {"total_files": 5, "skip_no_year_in_filename": 1, "read_ok": 3, "read_fail": 1, "year_filter_empty": 1, "pivot_ok": 2}


def test_file_order_holds_in_long_files(spark, tmp_path):
    """Row numbers follow the file, also in files larger than a read block."""
    for i in range(4):
        (tmp_path / f"T{i}_2020.csv").write_text("".join(f'T{i},2020,k,l,{n},,,"a\nb",1\n' for n in range(20_000)))
    long = extractions.read_extraction_csvs(spark, str(tmp_path))
    broken = long.selectExpr("source_file", "seq", "cast(value as int) AS v",
                             "lag(cast(value as int)) OVER (PARTITION BY source_file ORDER BY seq) AS before").filter("v <> before + 1")
    assert long.count() == 80_000 and broken.isEmpty()


def test_parts_of_a_document_are_read_in_order(spark, tmp_path):
    """The first value of a cell is in the first part, whichever part is larger or read first."""
    for part, n in ((0, 1), (1, 5000), (2, 300)):
        file = tmp_path / "A_2020.csv" / f"part-0000{part}-x.csv"
        file.parent.mkdir(exist_ok=True)
        file.write_text("".join(f"A,2020,k,l,{part}{i:04d},,,,\n" for i in range(n)))
    long = extractions.read_extraction_csvs(spark, str(tmp_path))
    assert [r.value for r in long.orderBy("seq").collect()] == [
        f"{part}{i:04d}" for part, n in ((0, 1), (1, 5000), (2, 300)) for i in range(n)]
    assert consolidation.consolidate(long).first().k == 0.0


def test_damaged_documents_are_rejected_whole(spark, tmp_path):
    folder, rejects = tmp_path / "in", str(tmp_path / "rejects")
    line = "AAA,{},sales,l,{},VND,,{},0.5\n"
    folder.mkdir()
    (folder / "mark_2020.csv").write_bytes(b"\xef\xbb\xbf" + line.format(2020, 1, "snippet").encode() + b"AAA,2020,tax,l,2,,,,1")
    (folder / "latin_2021.csv").write_bytes((line.format(2021, 1, "plain") + line.format(2021, 2, "caf\u00e9")).encode("latin-1"))
    rows = spark.range(20_000).repartition(2).selectExpr("'AAA'", "'2022'", "concat('k', id)", "'l'", "CAST(id AS STRING)", "''", "''", "'s'", "'1'")
    rows.write.csv(str(folder / "torn_2022.csv"))
    part = sorted((folder / "torn_2022.csv").glob("part-*.csv"))[1]
    data = bytearray(part.read_bytes())
    data[-100] ^= 1  # the checksum beside the file tells
    part.write_bytes(data)
    damaged = {r.source_file.rsplit("/", 1)[1]: r.reason for r in extractions.damaged_documents(spark, str(folder)).collect()}
    assert damaged == {"latin_2021.csv": "not UTF-8", "torn_2022.csv": "breaks off"}
    kept = extractions.read_whole_documents(spark, str(folder), rejects)
    assert {r.source_file.rsplit("/", 1)[1] for r in kept.select("source_file").distinct().collect()} == {"mark_2020.csv"}
    assert spark.read.parquet(rejects).count() == 2


def test_paths(table, spark, tmp_path):
    df = table([("gs://bucket/ABC/sub/r_2021_2022.pdf",), ("s3://b/X.csv/part-0001.csv",)], "path string")
    got = df.select(documents.ticker_of_uri(F.col("path")), documents.report_year(documents.document_path(F.col("path"))),
                    documents.document_name(F.col("path"))).collect()
    assert [tuple(r) for r in got] == [("ABC", 2021, "r_2021_2022.pdf"), ("X.csv", None, "X.csv")]
    for name in ("a.pdf", "b.PDF", "c.txt", "d/e.Pdf"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("x")
    pdfs = documents.list_pdfs(spark, str(tmp_path))
    assert pdfs.count() == 3 and pdfs.columns == ["path", "length"]
    done = table([("a",), ("e",)], "name string")
    assert [r.name for r in documents.not_yet_done(pdfs, done).collect()] == ["b"]


def test_nested_documents(table):
    docs = table([("d1", '{"ticker":"own","records":[{"fiscal_year":2020,"items":[{"key":"a","label":"l","value":"1","confidence":0.5},'
                         '{"key":"b","label":"l","value":""}]},{"fiscal_year":2021,"items":[]}]}', ""),
                  ("d2", '{"records":[{"fiscal_year":2021,"items":[{"key":"a","label":"l","value":"2"}]}]}', "given"), ("d3", "broken", "")],
                 "doc string, json string, company string")
    got = extractions.flatten_documents(docs, "json", F.col("company")).orderBy("doc", "seq").collect()
    assert [(r.ticker, r.fiscal_year, r.key, r.value, r.confidence) for r in got] == [
        ("own", "2020", "a", "1", 0.5), ("own", "2020", "b", "", None), ("given", "2021", "a", "2", None)]


def test_year_end_prices(table):
    t = datetime.datetime
    daily = table([("A", t(2020, 12, 30), 1.0), ("A", t(2020, 12, 31), 2.0), ("A", t(2021, 3, 1), 3.0), ("A", t(2022, 1, 1), 9.0)],
                  "ticker string, time timestamp, close double")
    assert rows(prices.year_end_prices(daily, "2020-12-31", "2021-12-31")) == [("A", 2020, "2020-12-31", 2.0), ("A", 2021, "2021-03-01", 3.0)]


# -- review -----------------------------------------------------------------------------------------

def test_key_columns():
    class Named:
        def __init__(self, *columns):
            self.columns = list(columns)

    assert keys.key_columns(Named("ticker", " company ", "year")) == (" company ", "year")
    assert keys.key_columns(Named("ticker", "fiscal_year")) == ("ticker", "fiscal_year")
    assert keys.key_columns(Named()) == ("ticker", "fiscal_year")
    assert keys.key_columns(Named("x")) == ("company", "year")
    assert keys.key_columns(Named("company", "year"), empty=True) == ("ticker", "fiscal_year")


def test_split_protects_edits(table, spark, tmp_path):
    wide = table([("aaa", "2020", "1"), ("BBB", "2020", "2"), ("CCC", "2020", "3")], "ticker string, fiscal_year string, v string")
    groups = table([("g1", "AAA"), ("g1", "bbb "), ("g2", "BBB"), ("g3", "ZZZ")], "group string, ticker string")
    first = review.split_for_review(wide, groups)
    assert rows(first.rows) == [("g1", "AAA", 2020, "1"), ("g1", "BBB", 2020, "2"), ("g2", "BBB", 2020, "2")]
    assert rows(first.empty_groups) == [("g3",)]
    edited = first.rows.withColumn("v", F.lit("edited")).withColumn("comment", F.lit("c"))
    later = wide.union(table([("AAA", "2021", "9")], "ticker string, fiscal_year string, v string")).withColumn("w", F.lit("new"))
    second = review.split_for_review(later, groups, edited)
    assert rows(second.appended) == [("g1", "AAA", 2021, "9", "new")]
    assert ("g1", "AAA", 2020, "edited", "c", "") in rows(second.rows) and ("g1", "AAA", 2021, "9", "", "new") in rows(second.rows)
    assert review.split_for_review(later, groups, second.rows).appended.isEmpty()
    review.write_split(first, str(tmp_path / "split"))
    assert spark.read.parquet(str(tmp_path / "split")).count() == 3
    kept = {f.name for f in (tmp_path / "split").rglob("part-*")}
    review.write_split(second, str(tmp_path / "split"))
    assert kept < {f.name for f in (tmp_path / "split").rglob("part-*")}
    stored = spark.read.option("mergeSchema", "true").parquet(str(tmp_path / "split"))
    assert rows(stored.filter("fiscal_year = 2021").select("ticker", "v", "w")) == [("AAA", "9", "new")] and stored.count() == 4


def test_collect_keeps_whole_rows_of_the_best_source(table):
    a = table([("A", "2020", "", "1")], "company string, year string, v string, w string")
    b = table([("a ", "2020.0", "x"), ("B", "2021", "y"), ("B", None, "z")], "company string, year string, v string")
    empty = table([], "company string, year string, odd string")
    got = review.collect_reviews({"a": ("ida", a), "b": ("idb", b), "e": ("ide", empty)})
    assert got.columns == ["company", "year", "v", "w", "_manual_source", "_manual_source_id"]
    assert rows(got) == [("A", 2020, "", "1", "a", "ida"), ("B", 2021, "y", "", "b", "idb")]
    assert ("A", 2020, "x", "", "b", "idb") in rows(review.collect_reviews({"a": ("ida", a), "b": ("idb", b)}, ["b"]))
    assert ("A", 2020, "x", "", "source_2", "idb") in rows(review.collect_reviews([("ida", a), ("idb", b)], ["idb"]))


def test_merge_fills_cell_by_cell(table):
    manual = table([("A", "2020", "", "m", "h")], "ticker string, fiscal_year string, v string, w string, _helper string")
    extra = table([("a", "2020", "e", "e", " "), ("B", "2020", None, "e", "k")], "ticker string, fiscal_year string, v string, w string, z string")
    ocr = table([("A", "2020", "o", "o"), ("C", "2020", "o", None)], "ticker string, fiscal_year string, v string, z string")
    got = review.merge_master(manual, extra, ocr)
    assert got.columns == ["ticker", "fiscal_year", "v", "w", "z"]
    assert rows(got) == [("A", 2020, "e", "m", "o"), ("B", 2020, "", "e", "k"), ("C", 2020, "o", "", "")]
    assert rows(review.merge_master(manual, extra, ocr, fill_from_extracted=False))[2] == ("C", 2020, "", "", "")
    assert rows(review.merge_master(None, extra)) == [("A", 2020, "e", "e", " "), ("B", 2020, "", "e", "k")]
    none = table([], "company string, year string, odd string")  # the first day of a cycle: nobody has edited anything yet
    assert rows(review.merge_master(none, extra)) == rows(review.merge_master(None, extra))
    assert review.merge_master(none, none).columns == ["company", "year", "odd"]
    with pytest.raises(Exception, match="key twice"):
        review.merge_master(manual.union(manual), extra).collect()
    with pytest.raises(keys.RejectedBatch):
        review.merge_master(manual, extra.withColumnRenamed("ticker", "code"))


def test_missing_tasks(table):
    master = table([("a", "2020", "", "None", "1"), ("B", "2021", "x", "y", " ")], "ticker string, fiscal_year string, v string, w string, z string")
    groups = table([("g1", "A", 1), ("g2", "A", 2)], "group string, ticker string, _row int")
    got = review.missing_tasks(master, owners=review.owners_of_groups(groups))
    assert rows(got) == [("A", 2020, "v", "g2", "todo", ""), ("A", 2020, "w", "g2", "todo", ""), ("B", 2021, "z", "", "todo", "")]
    assert rows(review.missing_tasks(master, required=["z", "unknown"])) == [("B", 2021, "z", "", "todo", "")]


# -- corrections ------------------------------------------------------------------------------------

FIX = "ticker string, fiscal_year string, table_name string, column_name string, error_type string, message string, old_value string, new_value string"


def fix(*values):
    ticker, year, name, column, new = values
    return (ticker, year, name, column, "E", "why", None, new)


@pytest.fixture
def market(table):
    df = table([(1, 2020, 1, 5, 1.0), (1, 2020, 2, 7, 2.0), (1, 2021, 1, None, 3.0)],
               "firm_id bigint, fiscal_year int, snapshot_id bigint, shares_outstanding bigint, p double")
    df = df.withColumn("share_price", F.col("p").cast(schemas.PRICE)).drop("p")
    return keys.with_columns_of(df, schemas.FACT_COLUMNS["fact_market_year"])


def test_reasons(table):
    m = "fact_market_year"
    cases = [
        (fix("A", "2020", m, "share_price", "1,5"), "value does not fit the column"), (fix("A", "2020", m, "share_price", "2.5"), None),
        (fix("A", "2020", None, "share_price", "1"), "no table"), (fix("A", "2020", " nan", "share_price", "1"), "no table"),
        (fix("A", "2020", m, "a/b", "1"), "more than one column"), (fix("A", "2020", m, None, "1"), "no column"),
        (fix("A", "2020-2022", None, "fiscal_year", "1"), "no table"), (fix("A", "2020-2022", m, "share_price", "1"), "not a single year"),
        (fix("A", "2020", m, "share_price", " "), "no new value"), (fix("A", "2020", "users", "share_price", "1"), "unknown table"),
        (fix("A", "2020", m, "firm_id", "1"), "unknown column"), (fix("A", "2022.0", m, "shares_outstanding", "500.9"), None),
        (fix("A", "2020", m, "shares_outstanding", "x"), None), (fix("A", "2020", m, "shares_outstanding", "1e30"), "value does not fit the column"),
    ]
    got = corrections.eligible_fixes(table([c for c, _ in cases], FIX).coalesce(1)).orderBy("_row").collect()
    assert [r.reason for r in got] == [reason for _, reason in cases]
    assert (got[1].new_value, got[11].new_value, got[11].fiscal_year, got[12].new_value) == ("2.5000", "500", 2022, None)
    as_whole = corrections.eligible_fixes(table([cases[1][0]], FIX), {"share_price": schemas.MARKET["shares_outstanding"]}).first()
    assert as_whole.new_value == "2"


def test_fixes(spark, table, market, tmp_path):
    m = "fact_market_year"
    findings = table([fix("aaa ", "2020", m, "share_price", "9"), fix("AAA", "2020", m, "share_price", "10.5"),
                      fix("AAA", "2020", m, "shares_outstanding", "x"), fix("AAA", "1999", m, "share_price", "1"),
                      fix("ZZZ", "2020", m, "share_price", "1")], FIX).coalesce(1)
    firms = table([(1, "AAA")], "firm_id bigint, ticker string")
    done = corrections.settle_fixes(spark, findings, {m: market}, firms, str(tmp_path / "fixes"))
    assert sorted(r.reason for r in done.rejected.collect()) == ["no stored row", "unknown ticker"]
    fixed = corrections.corrected_fact(market, m, done.accepted)
    got = {(r.fiscal_year, r.snapshot_id): (r.shares_outstanding, r.share_price) for r in fixed.collect()}
    assert {k: (s, float(p)) for k, (s, p) in got.items()} == {(2020, 1): (5, 1.0), (2020, 2): (None, 10.5), (2021, 1): (None, 3.0)}
    assert rows(corrections.corrected_fact(fixed, m, done.accepted)) == rows(fixed)
    log = corrections.override_log(done.accepted, "2026-01-01").orderBy("override_id").collect()
    assert [(r.override_id, r.column_name, r.old_value, r.new_value, r.changed_by) for r in log] == [
        (1, "share_price", "2.0000", "9.0000", "Group_Member"), (2, "share_price", "9.0000", "10.5000", "Group_Member"),
        (3, "shares_outstanding", "7", "None", "Group_Member")]
    master = table([("aaa", "2020.0", "1"), ("BBB", "2020", "2")], "ticker string, fiscal_year string, share_price string")
    assert rows(corrections.sync_master(master, done.accepted)) == [("BBB", "2020", "2", None), ("aaa", "2020.0", "10.5000", None)]


# -- sheets -----------------------------------------------------------------------------------------

def test_sheets(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿ ticker ,v\nA,1\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("ticker,v\n")
    assert tables.read_sheet(spark, str(tmp_path / "a.csv"), ("ticker",)).columns == ["ticker", "v"]
    empty = tables.read_sheet(spark, str(tmp_path / "b.csv"))
    assert empty.isEmpty() and empty.columns == ["ticker", "v"]
    with pytest.raises(ValueError, match="lacks"):
        tables.read_sheet(spark, str(tmp_path / "b.csv"), ("year",))
    with pytest.raises(ValueError, match="cannot be read"):
        tables.read_sheets(spark, {"a": str(tmp_path / "a.csv"), "gone": str(tmp_path / "gone.csv")})
    text = keys.text_cells(spark.sql("SELECT 12000000D AS a, CAST(NULL AS INT) AS b, 'x' AS c"))
    assert rows(text) == [("12000000", "", "x")]
    sinks.write_sheet_csv(spark.sql("SELECT 1 AS a, CAST(NULL AS INT) AS b WHERE false"), str(tmp_path / "none"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "none")).isEmpty()


def test_jobs_stay_in_the_jvm(spark):
    """No job hands rows to Python workers."""
    import __spark_entry__ as spark_entry

    for name in ("latest_panel", "standardise_panel", "consolidate_append", "merge_master", "load_facts_upsert"):
        plan = spark_entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan, name


# -- quotes, splits and the ledger ------------------------------------------------------------------

def quoted_text(rng, records):
    """CSV text with line breaks, commas and doubled quotes inside quotes, and stray quotes outside."""
    def field():
        if rng.random() < 0.5:
            return rng.choice(["a", "", '5" pipe', 'x"y"', "12"])
        return '"' + "".join(rng.choice(["a", ",", "\n", '""', "b", '""""']) for _ in range(rng.randrange(6))) + '"'
    return "\n".join(",".join(field() for _ in range(3)) for _ in range(records)) + "\n"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_records_of_split_files(spark, tmp_path, small_splits):
    """Many tasks on one file read the records that one reader of the whole file finds, in its order."""
    rng, schema = random.Random(1), "a string, b string, c string, d string"
    for i in range(12):
        (tmp_path / f"f{i}.csv").write_text(quoted_text(rng, rng.choice([1, 3, 40, 300])))
    (tmp_path / "long.csv").write_text('x,"' + "no quote for many splits,\n" * 400 + '",z\n1,2,3')
    name = F.element_at(F.split("path", "/"), -1).alias("name")
    found = quotes.read_records(spark, str(tmp_path)).where("record <> ''").select(name, "at", F.from_csv("record", schema, {"escape": '"'}).alias("r"))
    got = [tuple(r) for r in found.select("name", "r.*").orderBy("name", "at").collect()]
    whole = spark.read.schema(schema).options(multiLine="true", escape='"').csv(str(tmp_path)).select(
        F.element_at(F.split("_metadata.file_path", "/"), -1).alias("name"), "*", F.monotonically_increasing_id().alias("id"))
    assert got == [tuple(r)[:-1] for r in whole.orderBy("name", "id").collect()]
    tasks = quotes.read_lines(spark, str(tmp_path / "long.csv")).select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 2


def test_quotes_that_are_never_closed(spark, tmp_path, small_splits):
    bodies = {"closed": 'a,"b\n\n""c"\n' * 200, "open": 'a,"b",c\n' * 500 + '1,"\n' + "x,y,z\n" * 500, "late": 'a,b\n"', "stray": 'a,5" pipe\n' * 99,
              "even": 'a,"b\nc\n"d"\n', "doubled": 'a,"b""\nc""\n"\n', "none": "a,b\n"}
    for name, body in bodies.items():
        (tmp_path / f"{name}.csv").write_text(body)
    found = quotes.unclosed_files(quotes.read_lines(spark, str(tmp_path)))
    assert {r.path.rsplit("/", 1)[1] for r in found.collect()} == {"open.csv", "late.csv"}
    assert {r.source_file.rsplit("/", 1)[1]: r.reason for r in extractions.damaged_documents(spark, str(tmp_path)).collect()} == {
        "open.csv": "quote not closed", "late.csv": "quote not closed"}


def test_large_documents_are_read_by_splits(spark, tmp_path, small_splits):
    """Documents above the size for whole reading, one of them in parts, give the same cells in the same order."""
    folder = tmp_path / "in"
    (folder / "B_2020.csv").mkdir(parents=True)
    for name, n in (("A_2020.csv", 300), ("B_2020.csv/part-00000.csv", 200), ("B_2020.csv/part-00001.csv", 90), ("C_2020.csv", 2)):
        (folder / name).write_text("".join(f'{name[0]},2020,k,"l\n{i}",{i},,,"a ""b""\n",1\n' for i in range(n)))
    found = {}
    for size in (1 << 30, 1000, 0):
        rows = extractions.read_whole_documents(spark, str(folder), str(tmp_path / f"rejects{size}"), whole_file_bytes=size)
        found[size] = [(r.source_file, r.ticker, r.value) for r in rows.orderBy("source_file", "seq").collect()]
    assert found[0] == found[1000] == found[1 << 30] and len(found[0]) == 592


def test_stream_accounts_for_every_document(spark, tmp_path):
    """Each document that was seen ends among the stored or the rejected ones, also if no row can be read, batch by batch."""
    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    line = "AAA,{},sales,l,{},VND,,s,0.5\n"

    def land(bodies):
        for name, body in bodies.items():
            (folder / name).write_bytes(body)
        ingest_new_extractions(spark, str(folder), target, str(tmp_path / "checkpoint"), files_per_batch=2).awaitTermination()
        ledger = {r.source_file.rsplit("/", 1)[1]: (r.rows, r.reason) for r in spark.read.parquet(f"{target}-ledger").collect()}
        stored = {r.source_file.rsplit("/", 1)[1]: r.n for r in spark.read.parquet(target).groupBy("source_file").agg(F.count("*").alias("n")).collect()}
        return ledger, stored

    first = {"one_2020.csv": line.format(2020, 1).encode() * 3, "blank_2020.csv": b"\n\n", "open_2020.csv": b'a,"b\n', "a bü_2020.csv": line.format(2020, 2).encode()}
    ledger, stored = land(first)
    assert ledger == {"one_2020.csv": (3, None), "blank_2020.csv": (0, "no rows"), "open_2020.csv": (1, "quote not closed"), "a bü_2020.csv": (1, None)}
    assert stored == {"one_2020.csv": 3, "a bü_2020.csv": 1}
    ledger, stored = land({"two_2021.csv": line.format(2021, 1).encode(), "latin_2021.csv": line.format(2021, "café").encode("latin-1")})
    assert len(ledger) == 6 and ledger["latin_2021.csv"][1] == "not UTF-8" and stored == {"one_2020.csv": 3, "a bü_2020.csv": 1, "two_2021.csv": 1}


def test_new_documents_are_listed_in_tables(spark, tmp_path, table):
    folder = tmp_path / "in"
    folder.mkdir()
    header = ",".join(schemas.EXTRACTION_CSV.names) + "\n"
    for name in ("old_2020.csv", "new_2020.csv", "a b_2021.csv"):
        (folder / name).write_text(header + f"{name[0]},2020,k,l,1,,,s,1\n")
    (folder / "bad_2020.csv").write_text(header + 'AAA,2020,k,"l\n')
    os.utime(folder / "old_2020.csv", (1_000_000_000, 1_000_000_000))
    loaded = table([("old_2020",)], "source_file string")
    cells = per_file.load_new_documents(spark, str(folder), loaded, str(tmp_path / "listing"), rejects=str(tmp_path / "rejects"))
    assert {r.source_file for r in cells.collect()} == {"new_2020", "a b_2021"}
    assert {r.source_file.rsplit("/", 1)[1] for r in spark.read.parquet(str(tmp_path / "rejects")).collect()} == {"bad_2020.csv"}
    assert spark.read.parquet(str(tmp_path / "listing")).count() == 3
    none = per_file.load_new_documents(spark, str(folder), loaded, str(tmp_path / "later"), modifiedAfter="2999-01-01T00:00:00")
    assert none.isEmpty()
    (folder / "x").mkdir()
    (folder / "x" / "new_2020.csv").write_text(header)
    with pytest.raises(keys.RejectedBatch, match="one base name"):
        per_file.load_new_documents(spark, str(folder), loaded, str(tmp_path / "again"))


# -- natural keys and the daily run -----------------------------------------------------------------

def test_natural_keys_know_no_case_accents_or_edge_blanks(table):
    lookup = table([("Công nghệ", 1), ("Thép", 2)], "name string, id int")
    left = table([("CONG NGHE ", "a"), ("thep", "b"), ("  ", "c"), (None, "d"), ("Thépp", "e")], "k string, v string")
    assert rows(with_lookup(left, "k", lookup, "name", ["id"]).select("v", "id")) == [("a", 1), ("b", 2), ("c", None), ("d", None), ("e", None)]
    assert rows(with_lookup(left, "k", lookup, "name", ["id"], how="inner").select("v", "id")) == [("a", 1), ("b", 2)]
    blank = lookup.union(table([("", 3)], "name string, id int"))
    assert ("c", 3) in rows(with_lookup(left, "k", blank, "name", ["id"]).select("v", "id"))
    assert rows(insert_if_absent(table([("thép", 1), ("Đá", 2), ("đÀ", 3), ("", 4)], "name string, seq int"), lookup, "name", "seq").select("seq")) == [(2,), (4,)]


def test_blank_keys_are_dealt_over_all_tasks(spark):
    """A third of the rows without a usable key: no join bucket holds them all."""
    left = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), "id")
    lookup = spark.range(50).select(F.concat(F.lit("K"), "id").alias("name"), F.col("id").alias("n"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = with_lookup(left, "k", lookup, "name", ["n"])
        blank = joined.where("n IS NULL").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(blank) == 8 and max(r["count"] for r in blank) < 600


def test_daily_run(table, spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("manual", "master", "missing")}
    one = table([("aaa", "2020", "1", "")], "ticker string, fiscal_year string, x string, y string")
    two = table([("AAA", "2020", "9", "2"), ("bbb", "2021", "", "")], "ticker string, fiscal_year string, x string, y string")
    ocr = table([("CCC", "2021", "5", "")], "ticker string, fiscal_year string, x string, y string")
    groups = table([("g1", "AAA"), ("g2", "BBB")], "group string, ticker string")
    for _ in range(2):
        counts = run_reviews(spark, {"t1": ("1", one), "t2": ("2", two)}, paths, extracted=ocr, groups=groups, prefer_order=["t2"])
        assert rows(counts) == [("manual", 2), ("master", 3), ("missing", 3)]
    assert rows(spark.read.parquet(paths["master"])) == [("AAA", 2020, "9", "2"), ("BBB", 2021, "", ""), ("CCC", 2021, "5", "")]
    assert rows(spark.read.parquet(paths["missing"]).select("ticker", "missing_var", "assigned_to")) == [
        ("BBB", "x", "g2"), ("BBB", "y", "g2"), ("CCC", "y", "")]


def test_documents_are_written_by_many_tasks(spark, table):
    from catalogue.common import by_document

    rows = table([(f"d{i % 40}", i) for i in range(400)], "doc string, n int")
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert by_document(rows).rdd.getNumPartitions() == wanted
    assert by_document(rows.groupBy("doc").count()).rdd.getNumPartitions() == wanted


def test_named_files_are_not_listed_again(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,2020,k,,1\n")
    listed = documents.csv_files(spark, str(tmp_path)).select("path", (F.col("length") + 9).alias("length"))
    found = extractions.damaged_documents(spark, str(tmp_path), listed).collect()
    assert [r.reason for r in found] == ["breaks off"]


def test_findings_of_many_part_files_keep_their_order(spark, tmp_path):
    columns = schemas.FINDING.names
    rows = spark.range(300).repartitionByRange(3, "id").sortWithinPartitions("id").select(
        *[F.format_string("%05d", "id").alias(c) if i == 0 else F.lit("x" * 9).alias(c) for i, c in enumerate(columns)])
    rows.write.option("header", "true").csv(str(tmp_path / "f"))
    # The last part is the largest file, so it is scanned first.
    late = spark.range(300, 900).coalesce(1).select(*[F.format_string("%05d", "id").alias(c) for c in columns])
    late.write.option("header", "true").csv(str(tmp_path / "late"))
    part = next((tmp_path / "late").glob("part-*.csv"))
    (tmp_path / "f" / "part-00007-late.csv").write_bytes(part.read_bytes())
    got = tables.read_findings(spark, str(tmp_path / "f")).orderBy("_row").collect()
    assert [r[columns[0]] for r in got] == [f"{i:05d}" for i in range(900)]
    assert len({r._row for r in got}) == 900


def test_derived_facts_are_dealt_to_named_tasks(spark, tmp_path):
    from firmament.standins import TestTables

    orders = spark.range(60).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "DATE'2020-01-01' AS o_orderdate", "CAST(id AS DOUBLE) AS o_totalprice", "'1-URGENT' AS o_orderpriority")
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    facts_of = TestTables(spark, str(tmp_path)).facts()
    assert facts_of["fact_financial_year"].rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert facts_of["fact_financial_year"].count() == 7


def test_many_folders_are_listed_by_few_tasks(spark, tmp_path):
    for i in range(90):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "a.csv").write_text("x,2020,k,,1\n")
    name, most = "spark.sql.sources.parallelPartitionDiscovery.parallelism", documents.LISTING_TASKS * spark.sparkContext.defaultParallelism
    spark.conf.set(name, "10000")
    context = spark.sparkContext
    context.setJobGroup("few-listing-tasks", "", False)
    try:
        assert documents.csv_files(spark, str(tmp_path)).count() == 90
        assert spark.conf.get(name) == "10000"
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup("few-listing-tasks") for s in tracker.getJobInfo(j).stageIds]
        assert max(info.numTasks for info in map(tracker.getStageInfo, stages) if info) <= most < 90
        spark.conf.set(name, "3")
        with documents.few_listing_tasks(spark):
            assert spark.conf.get(name) == "3"
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.unset(name)


def test_a_batch_scans_its_own_files_only(spark, tmp_path, monkeypatch):
    from firmament.streaming import incremental

    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    for i, name in enumerate(["f_2020.csv", "g[1]{2}_2020.csv", "h 100%+_2020.csv"]):
        (folder / name).write_text(f"x,2020,k,,{i}\n")
    seen = []
    read = incremental.read_extraction_csvs
    monkeypatch.setattr(incremental, "read_extraction_csvs", lambda s, paths, *more, **o: seen.append(paths) or read(s, paths, *more, **o))
    ingest_new_extractions(spark, str(folder), target, str(tmp_path / "checkpoint"), files_per_batch=1).awaitTermination()
    assert [len(paths) for paths in seen] == [1, 1, 1]
    stored = spark.read.parquet(target).collect()
    assert {(r.source_file.rsplit("/", 1)[1], r.value) for r in stored} == {
        ("f_2020.csv", "0"), ("g[1]{2}_2020.csv", "1"), ("h 100%+_2020.csv", "2")}


def test_a_batch_goes_on_if_a_file_is_gone(spark, tmp_path, monkeypatch):
    from firmament.streaming import incremental

    folder, target = tmp_path / "in", str(tmp_path / "out")
    folder.mkdir()
    (folder / "f_2020.csv").write_text("x,2020,k,,1\n")
    monkeypatch.setattr(incremental, "literal_path", lambda path: f"{path}-gone")
    ingest_new_extractions(spark, str(folder), target, str(tmp_path / "checkpoint")).awaitTermination()
    assert [r.value for r in spark.read.parquet(target).collect()] == ["1"]


def test_lines_are_read_once(spark, tmp_path):
    """The check opens no document again once it has looked at its lines; what it tells was kept."""
    for name, text in {"whole": "a,2020,k,v\n", "open": 'a,2020,k,"v\n', "latin": "a,2020,k,\xe9\n"}.items():
        (tmp_path / f"{name}.csv").write_bytes(text.encode("latin-1"))
    listed = spark.createDataFrame([(r.path, r.length) for r in documents.csv_files(spark, str(tmp_path)).collect()], "path string, length long")
    found = extractions.damaged_documents(spark, str(tmp_path), listed)
    for file in tmp_path.iterdir():
        file.unlink()
    assert {r.source_file.rsplit("/", 1)[1]: r.reason for r in found.collect()} == {"open.csv": "quote not closed", "latin.csv": "not UTF-8"}


def test_documents_are_landed_as_the_csv_writer_writes_them(spark, table, tmp_path):
    from catalogue.common import by_document, land_documents

    rows = table([(f"d{i % 3}_2020.csv" if i % 7 else None, i, 'a "b", \xe9€' if i % 2 else None, "" if i % 5 else "two\nlines ") for i in range(200)], "doc string, seq int, a string, b string")
    dealt = by_document(rows).sortWithinPartitions("doc", "seq")
    for name, options in {"plain": {}, "other": {"header": "true", "escape": '"', "emptyValue": "", "encoding": "ISO-8859-1", "ignoreTrailingWhiteSpace": "false"}}.items():
        land_documents(dealt, str(tmp_path / name / "landed"), **options)
        dealt.write.partitionBy("doc").options(**options).csv(str(tmp_path / name / "written"))
        landed, written = ({f.parent.name: f.read_bytes() for f in (tmp_path / name / at).glob("doc=*/*.csv")} for at in ("landed", "written"))
        assert landed == written and len(landed) == 4
        assert not list((tmp_path / name / "landed").glob("*/.*"))  # no checksums, nothing half written


def test_paths_are_cut_as_patterns_would(table):
    paths = ["/a/x.csv/part-00001-u.csv", "x.csv/part-", "/a/x.txt/part-1.csv", "part-7.csv", "/a/part-7", "s3://b/doc=f_2020.csv/part-00012-u.csv", "/a/k=v/", "/a/2021/b.csv",
             "/a=1/b_12345_2020.csv", "/a/x.csv/part-9/y.csv", "/x.csv/part-12-a.csv/part-3", "", "/", "a b%20+=c_1999", "/2020=x", None]
    got = table([(p,) for p in paths], "path string").select(
        documents.document_path(F.col("path")), F.regexp_replace("path", r"(?<=\.csv)/part-[^/]*$", ""),
        documents.document_name(F.col("path")), F.regexp_extract(F.regexp_replace("path", r"(?<=\.csv)/part-[^/]*$", ""), r"([^/=]*)/*$", 1),
        documents.report_year(F.col("path")), F.regexp_extract("path", r"(?:^|[/=])[^/=]*?(\d{4})[^/=]*$", 1).try_cast("int")).collect()
    assert [(r[0], r[2], r[4]) for r in got] == [(r[1], r[3], r[5]) for r in got]


def test_whole_texts_end_as_their_lines_do(spark, tmp_path):
    rng = random.Random(5)
    for i in range(150):
        (tmp_path / f"f{i}.csv").write_text(rng.choice(["", "﻿"]) + "".join(rng.choice(['"', '"', '""', ",", "a", "\n", "\r\n"]) for _ in range(rng.choice([1, 3, 9, 30]))), newline="")
    by_line = {r.path for r in quotes.unclosed_files(quotes.read_lines(spark, str(tmp_path))).collect()}
    whole = {r.path for r in quotes.read_texts(spark, str(tmp_path), 1 << 20).where(quotes.text_ends_quoted(F.col("value"))).collect()}
    assert whole == by_line and 20 < len(whole) < 130


def test_many_small_documents_are_scanned_by_few_tasks(spark, table, tmp_path):
    """A task takes many documents, in the check of a reload as in its scan; the setting is put back."""
    (tmp_path / "in").mkdir()
    for i in range(300):
        (tmp_path / "in" / f"f{i}_2020.csv").write_text(",".join(schemas.EXTRACTION_CSV.names) + "\nx,2020,k,,1,,,,\n")
    context, group = spark.sparkContext, "few-scan-tasks"
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")
    context.setJobGroup(group, "", False)
    try:
        cells = per_file.load_new_documents(spark, str(tmp_path / "in"), table([], "source_file string"), str(tmp_path / "listing"), rejects=str(tmp_path / "rejects"))
        per_file.write_per_file(cells, str(tmp_path / "out"))
        tracker = context.statusTracker()
        stages = [s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
        assert max(info.numTasks for info in map(tracker.getStageInfo, stages) if info) < 40  # 75 of four documents each before
        assert spark.conf.get("spark.sql.files.openCostInBytes") == before["spark.sql.files.openCostInBytes"]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 300


def test_rows_of_whole_documents_hold_no_listing(spark, tmp_path):
    """The documents are read once, when they are checked: no scan of them, with its listing on the driver, is part of what is returned."""
    folder = tmp_path / "in"
    folder.mkdir()
    for name, text in {"a_2020": "A,2020,k,,1\n", "b_2020": "B,2019,k,,1\n", "c_2020": 'C,2020,k,"v\n', "notes": "A,2020,k,,1\nA,2020,k,,2\n"}.items():
        (folder / f"{name}.csv").write_text(text)
    listed = extractions.stored_files(spark, str(folder), str(tmp_path / "listing"))
    rows = extractions.read_whole_documents(spark, str(folder), str(tmp_path / "rejects"))
    assert not [f for f in rows.inputFiles() if f.endswith(".csv")]
    for file in folder.iterdir():
        file.unlink()
    assert consolidation.run_counters(listed, rows).first().asDict() == {
        "total_files": 4, "skip_no_year_in_filename": 1, "read_ok": 2, "read_fail": 1, "year_filter_empty": 1, "pivot_ok": 1}
