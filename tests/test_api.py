"""The commands over small tables."""

import pytest

from ledgerflow import api
from ledgerflow.api import Engine
from ledgerflow.plans import tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    e = Engine(spark, tables.create(spark, ["companies", "securities", "identifier_xref", "prices", "fx_rates", "financials", "filings", "filing_documents", "run_log", "daily_metrics"]))
    master = [("US", "aapl", "Apple", "COMMON", "USD", 1, None, 1), ("KR", "5930.KS", "Samsung", None, "KRW", 1, None, 2), ("US", "SMSN", "Samsung ADR", "ADR", "USD", 0, "KR:005930", 3)]
    e.load_master(spark.createDataFrame(master, "market string, symbol string, name string, security_type string, currency string, is_primary int, underlying_symbol string, _ord long"))
    ids = {r["symbol"]: r["security_id"] for r in e.tables["securities"].collect()}
    prices = [(ids["AAPL"], "2024-01-02", 190.0, "USD", "s", 1), (ids["AAPL"], "2024-01-03", 185.0, "USD", "s", 2), (ids["005930"], "2024-01-03", 70000.0, "KRW", "s", 3)]
    e.write("prices", spark.createDataFrame(prices, "security_id long, trade_date string, close double, currency string, source string, _ord long"))
    e.write("fx_rates", spark.createDataFrame([("2024-01-01", "KRW", "USD", "spot", 0.001, "s", 1)], "rate_date string, base_ccy string, quote_ccy string, rate_type string, rate double, source string, _ord long"))
    company = {r["name"]: r["company_id"] for r in e.tables["companies"].collect()}
    facts = [(company["Apple"], y, "FY", "CFS", "IS", a, v, "USD", "s", i) for i, (y, a, v) in enumerate([(2022, "Revenues", 1e9), (2023, "revenue", 5e9), (2023, "Revenues", 3e9), (2023, "NetIncomeLoss", 2e6)])]
    e.write("financials", spark.createDataFrame(facts, "company_id long, fiscal_year int, fiscal_period string, fs_scope string, statement_type string, account string, value double, currency string, source string, _ord long"))
    return e.store(str(tmp_path_factory.mktemp("tables")))


@pytest.fixture()
def engine(stored, spark):
    return Engine(spark, dict(stored.tables)).create()


def test_master(engine):
    by = {r["symbol"]: r["company_id"] for r in engine.tables["securities"].collect()}
    assert by["SMSN"] == by["005930"] != by["AAPL"] and engine.tables["companies"].count() == 2


def test_compare(engine):
    rows = {r["asked"]: r for r in engine.compare(["AAPL", "KR:5930", "5930", "none"]).collect()}
    assert set(rows) == {"AAPL", "5930"} and rows["AAPL"]["close"] == 185.0 and rows["AAPL"]["revenue"] == "3.00B" and rows["AAPL"]["net_income"] == "2.00M"
    assert rows["5930"]["close_usd"] == pytest.approx(70.0) and rows["5930"]["revenue"] == "-"


def test_links(engine):
    assert engine.link(["AAPL", "KR:005930", "zzz"]) == 2
    assert len({r["company_id"] for r in engine.tables["securities"].where("symbol <> 'SMSN'").collect()}) == 1


def test_placeholders(engine, spark):
    engine.ensure_master(spark.createDataFrame([("HK", "700", 9), ("US", "AAPL", 10)], "market string, symbol string, _ord long"))
    r = engine.tables["securities"].where("symbol = '00700'").first()
    assert (r["currency"], r["source"]) == ("HKD", "placeholder") and engine.tables["securities"].count() == 4


def test_coverage(engine, spark):
    rows = spark.createDataFrame([("US", "AAPL", "2024-01-02", 3.0, "s", 1), ("US", "none", "2024-01-02", 3.0, "s", 2), ("US", "AAPL", "2010-01-02", 1.0, "s", 3)], "market string, symbol string, metric_date string, market_cap double, source string, _ord long")
    assert engine.coverage("metrics", rows, today="2024-06-01") == 1 and engine.tables["daily_metrics"].count() == 1


def test_documents(engine, spark):
    company = engine.tables["securities"].first()["company_id"]
    engine.write("filings", spark.createDataFrame([(company, "f1", '["u0","u1"]', "p", "s", 1), (company, "f2", "broken", "p2", "s", 2)], "company_id long, filing_id string, doc_urls string, url string, source string, _ord long"))
    engine.write("filing_documents", spark.createDataFrame([(company, "f1", "s", 0, 1)], "company_id long, filing_id string, source string, doc_seq int, _ord long"))
    assert sorted((r["filing_id"], r["doc_seq"], r["doc_url"]) for r in engine.documents_to_fetch().collect()) == [("f1", 1, "u1"), ("f2", 0, "p2")]


def test_status_and_runs(engine, spark):
    schema = "run_id long, started_at string, status string, message string, rows_written long, _ord long"
    engine.write("run_log", spark.createDataFrame([(1, "a", "running", None, None, 1), (2, "b", "running", None, None, 2)], schema))
    engine.write("run_log", spark.createDataFrame([(1, None, "ok", "m" * 99, 5, 3)], schema))
    rows = engine.status(1).collect()
    assert len(rows) == 1 and rows[0]["run_id"] == 2
    first = engine.status().where("run_id = 1").first()
    assert (first["started_at"], first["status"], len(first["message"]), first["rows_written"]) == ("a", "ok", 60, 5)


@pytest.mark.parametrize("sql", ["select count(*) as n from securities", " WITH x AS (select 1 as n) SELECT * FROM x", "explain select 1", "show tables", "describe table securities"])
def test_reads_run(engine, sql):
    assert engine.query(sql).count() >= 1


@pytest.mark.parametrize("sql", ["insert into securities values (1)", "WITH x AS (SELECT 1) INSERT INTO t SELECT * FROM x", "drop view securities", "create table t as select 1", "delete from securities", "explain drop view securities", "set x = 1"])
def test_writes_do_not(engine, sql):
    with pytest.raises(ValueError):
        engine.query(sql)


def test_collect(engine, spark):
    landed = {("US", "news"): spark.createDataFrame([("US", "AAPL", '[{"title":"t","url":"u"}]')], "market string, symbol string, payload string"), ("KR", "news"): spark.createDataFrame([(1,)], "wrong int")}
    rows, failed = engine.collect("news", landed)
    assert [(r["symbol"], r["title"], r["data_type"]) for r in rows.collect()] == [("AAPL", "t", "news")] and len(failed) == 1
    assert api.default_source("us", "insiders") == "edgar" and api.default_source("US", "x") is None
    with pytest.raises(NotImplementedError):
        api.parser("krx", "news")
    with pytest.raises(ValueError):
        api.parser("none", "news")


def test_law_and_evaluate(engine, spark):
    text = '{"LawSearch":{"law":{"법령ID":"1","법령일련번호":"2","법령명한글":"법","소관부처명":"x"}}}'
    assert engine.law("search", spark.createDataFrame([(text,), ("broken",)], "payload string"), []).first()["name"] == "법"
    with pytest.raises(ValueError):
        engine.law("none", spark.range(1))
    cases = spark.createDataFrame([("a", "x", "p", ["p"], [[["1"]]], [[["1"]]])], "name string, category string, text string, paragraphs array<string>, pred array<array<array<string>>>, gold array<array<array<string>>>")
    assert {r["category"]: r["teds"] for r in engine.evaluate(cases).collect()} == {"x": 1.0, "overall": 1.0}
