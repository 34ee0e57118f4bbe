"""Every default route from landed payloads to rows, the FX job, coverage, gold folders and guards."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from ledgerflow import api
from ledgerflow.api import Engine
from ledgerflow.operators import evaluation
from ledgerflow.plans import tables
from ledgerflow.sources import formats, routes

PAYLOAD = "market string, symbol string, payload string"
CHART = {"chart": {"result": [{"meta": {"currency": "KRW", "longName": "Samsung", "exchangeName": "KSC"}, "timestamp": [1704153600, 1704240000], "indicators": {"quote": [{"open": [1.0, 2.0], "high": [1.0, 2.0], "low": [1.0, 2.0], "close": [70000.0, None], "volume": [5, 6]}]}, "events": {"dividends": {"a": {"date": 1704153600, "amount": 361.0}}, "splits": {"b": {"date": 1704240000, "numerator": 2.0, "denominator": 1.0}}}}]}}
FACTS = {"facts": {"us-gaap": {"Revenues": {"units": {"USD": [{"start": "2023-01-01", "end": "2023-12-31", "val": 5.0, "fy": 2023, "fp": "FY", "form": "10-K", "filed": "2024-02-01"}]}}}}}


def landed(spark, payload, market="US", symbol="AAPL"):
    return spark.createDataFrame([(market, symbol, json.dumps(payload))], PAYLOAD)


def test_every_default_route_has_a_parser():
    assert {s for s in routes.DEFAULTS.values()} <= set(routes.SOURCES)
    for (_, kind), source in routes.DEFAULTS.items():
        assert callable(routes.parser(source, kind))
    assert api.default_source("kr", "prices") == api.default_source("KR", "master") == "yfinance" and api.default_source("US", "none") is None


@pytest.mark.parametrize("market", routes.MARKETS)
def test_charts_give_prices_actions_and_masters(spark, market):
    rows = lambda kind: routes.parsed(market, kind, landed(spark, CHART, market, "005930"), "yfinance").collect()
    assert [(r["market"], r["trade_date"], r["close"], r["source"]) for r in rows("prices")] == [(market, "2024-01-02", 70000.0, "yfinance")]
    assert sorted((r["action_type"], r["ex_date"], r["amount"], r["ratio"], r["currency"]) for r in rows("actions")) == [("dividend", "2024-01-02", 361.0, None, "KRW"), ("split", "2024-01-03", None, 2.0, None)]
    (m,) = rows("master")
    assert (m["name"], m["exchange"], m["currency"], m["is_primary"]) == ("Samsung", "KSC", "KRW", 1)


def test_first_ticker_that_answers(spark):
    bare, empty = {"chart": {"result": None}}, {"chart": {"result": [{"meta": {"currency": "USD"}}]}}
    tried = [("KR", "035420", 0, "035420.KS", json.dumps(bare)), ("KR", "035420", 1, "035420.KQ", json.dumps(CHART)), ("KR", "005930", 1, "005930.KQ", json.dumps(empty)), ("KR", "005930", 0, "005930.KS", json.dumps(CHART)), ("KR", "1", 0, "1.KS", json.dumps(empty))]
    df = spark.createDataFrame(tried, "market string, symbol string, attempt int, ticker string, payload string")
    assert sorted(r["symbol"] for r in routes.parsed("KR", "prices", df).collect()) == ["005930", "035420"]
    assert sorted(r["symbol"] for r in routes.chart_master(df).collect()) == ["005930", "035420"]


def test_regulator_routes(spark):
    facts = routes.parsed("US", "financials", landed(spark, FACTS)).collect()
    assert [(r["account"], r["value"], r["currency"], r["fs_scope"], r["statement_type"]) for r in facts] == [("Revenues", 5.0, "USD", "CFS", "IS")]
    filings = spark.createDataFrame([("A", "DRS", "2023-01-10", "d", 1, "x"), ("A", "S-1", "2023-03-01", "p", 2, "initial offering price is between $10.00 and $12.00")], "symbol string, filing_type string, filed_date string, url string, ord int, text string").withColumn("filing_id", F.lit("f"))
    got = {r["signal_type"] for r in routes.parsed("US", "demand", {"filings": filings}).collect()}
    assert got == {"price_band", "confidential_review"}
    forms = spark.createDataFrame([("A", "SC 13G", "2023-01-10", "u", 1, "doc.htm", "4/x.xml")], "symbol string, filing_type string, filed_date string, url string, ord int, document string, xml_url string").withColumns({"filing_id": F.lit("f"), "filed": F.lit("x")})
    docs = spark.createDataFrame([("none", "<p/>")], "url string, content string")
    assert routes.parsed("US", "ownership", {"filings": forms, "documents": docs}).count() == 0 == routes.parsed("US", "insiders", {"filings": forms, "documents": docs}).count()
    with pytest.raises(ValueError, match="documents"):
        routes.parsed("US", "insiders", {"filings": forms})


def test_exchange_and_vendor_routes(spark):
    snap = spark.createDataFrame([("005930", "1000", "55.5", "2024-01-02")], "ticker string, `상장주식수` string, `지분율(%)` string, day string")
    r = routes.parsed("KR", "metrics", snap).first()
    assert (r["market"], r["symbol"], r["metric_date"], r["shares_outstanding"], r["foreign_own_pct"]) == ("KR", "005930", "2024-01-02", 1000.0, 55.5)
    members = spark.createDataFrame([("1028", "005930"), ("1028", "1")], "code string, ticker string")
    assert [(r["market"], r["symbol"]) for r in routes.parsed("KR", "index", {"members": members, "wanted": snap.select(F.col("ticker").alias("symbol"))}).collect()] == [("KR", "005930")]
    wanted = spark.createDataFrame([("US", "AAPL")], "market string, symbol string")
    lists = spark.createDataFrame([("S&P500", '[{"symbol":"AAPL","dateFirstAdded":"1982-11-30"}]')], "index_name string, payload string")
    assert [(r["index_name"], r["added"], r["source"]) for r in routes.parsed("US", "index", {"wanted": wanted, "lists": lists}).collect()] == [("S&P500", "1982-11-30", "fmp")]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    e = Engine(spark).create()
    master = [("KR", "5930", "Samsung", "KRW", 1), ("US", "AAPL", "Apple", "USD", 2), ("HK", "700", "Tencent", "HKD", 3)]
    return e.load_master(spark.createDataFrame(master, "market string, symbol string, name string, currency string, _ord long")).store(str(tmp_path_factory.mktemp("tables")))


@pytest.fixture()
def engine(stored, spark):
    return Engine(spark, dict(stored.tables)).create()


def test_fx_job(spark, engine):
    c = engine.tables["companies"].first()["company_id"]
    engine.write("financials", spark.createDataFrame([(c, 2018, "FY", "CFS", "IS", "a", 1.0, "KRW", "2018-12-31", "s", 1)], "company_id long, fiscal_year int, fiscal_period string, fs_scope string, statement_type string, account string, value double, currency string, period_end string, source string, _ord long"))
    want = [tuple(r) for r in engine.fx_wanted("2024-06-01").collect()]
    assert want == [("HKD", "2019-06-01", "2024-06-01"), ("KRW", "2017-12-31", "2024-06-01")]
    chart = lambda days, close: json.dumps({"chart": {"result": [{"timestamp": days, "indicators": {"quote": [{"close": close}]}}]}})
    engine.collect_fx(spark.createDataFrame([("KRW", chart([1514764800, 1546214400, 1577836800], [1000.0, 2000.0, 0.0])), ("HKD", chart([1704153600], [8.0]))], "base_ccy string, payload string"))
    got = sorted((r["base_ccy"], r["rate_date"], r["rate_type"], r["rate"], r["source"]) for r in engine.tables["fx_rates"].collect())
    assert got == [("HKD", "2024-01-02", "spot", 0.125, "yfinance"), ("KRW", "2018-01-01", "spot", 0.001, "yfinance"), ("KRW", "2018-12-31", "avg", 0.00075, "computed"), ("KRW", "2018-12-31", "spot", 0.0005, "yfinance")]


def test_coverage_of_all_types(spark, engine):
    assert {name for name, _ in api.COVERAGE.values()} <= set(tables.TABLES) and len(api.COVERAGE) == 12
    n = engine.collect_coverage("actions", {"KR": landed(spark, CHART, "KR", "5930"), "US": landed(spark, CHART, "US", "NEW")}, "2024-06-01", start="2024-01-03")
    assert n == {"KR": 1, "US": 1} and engine.tables["securities"].where("symbol = 'NEW' and source = 'placeholder'").count() == 1
    wanted = spark.createDataFrame([("US", "AAPL")], "market string, symbol string")
    lists = spark.createDataFrame([("S&P500", '[{"symbol":"AAPL"}]')], "index_name string, payload string")
    assert engine.collect_coverage("index", {"US": {"wanted": wanted, "lists": lists}}, "2024-06-01") == {"US": 1}
    assert engine.tables["index_membership"].columns == ["company_id", "index_name", "added", "removed", "source"] and engine.tables["index_membership"].first()["company_id"] is not None


def test_collect_reports_what_fails(spark, engine):
    rows, failed = engine.collect("prices", {("KR", "prices"): landed(spark, CHART, "KR", "5930"), ("US", "prices"): spark.createDataFrame([(1,)], "wrong int")})
    assert [(r["market"], r["close"], r["source"], r["data_type"]) for r in rows.collect()] == [("KR", 70000.0, "yfinance", "prices")] and len(failed) == 1


def test_law_details(spark, engine):
    engine.write("statutes", spark.createDataFrame([("1", "2", "Law", 7, 1)], "law_id string, law_serial_no string, name string, company_id long, _ord long"))
    engine.law_detail(spark.createDataFrame([("1", "2", None, "text", 1), ("3", "4", "Other", "more", 2)], "law_id string, law_serial_no string, name string, raw_text string, _ord long"))
    assert sorted((r["law_id"], r["name"], r["company_id"], r["raw_text"]) for r in engine.tables["statutes"].collect()) == [("1", "Law", 7, "text"), ("3", "Other", None, "more")]


def test_gold_folders(spark, engine, tmp_path):
    table = [["a", "1"], ["b", "2"]]
    cases = {"one": ({"category": "x", "tables": [table], "paragraphs": ["A paragraph."]}, "a paragraph."), "two": ({"tables": [table]}, " "), "broken": ("{", "t"), "no-doc": ({"category": "x"}, None), "no-spec": (None, "t")}
    for name, (spec, text) in cases.items():
        (tmp_path / name).mkdir()
        if spec is not None:
            (tmp_path / name / "expected.json").write_text(spec if isinstance(spec, str) else json.dumps(spec), "utf-8")
        if text is not None:
            (tmp_path / name / "doc.pdf").write_bytes(text.encode())
        (tmp_path / name / "notes.txt").write_text("x")
    gold = {r["name"]: r for r in evaluation.gold_cases(spark, str(tmp_path)).collect()}
    assert {n: (r["category"], r["gold"], r["paragraphs"], bytes(r["content"])) for n, r in gold.items()} == {"one": ("x", [table], ["A paragraph."], b"a paragraph."), "two": ("two", [table], [], b" "), "broken": ("broken", [], [], b"t")}
    read = lambda df: df.select("name", F.decode("content", "UTF-8").alias("text"), F.array(F.array(F.array(F.lit("a"), F.lit("1")), F.array(F.lit("b"), F.lit("2")))).alias("tables")).where("name <> 'two'")
    got = {r["category"]: (r["teds"], r["continuity"], r["n_cases"]) for r in engine.evaluate(str(tmp_path), read).collect()}
    assert got["x"] == (1.0, 1.0, 1) and got["two"][0] < 1 and got["broken"] == (None, None, 1) and got["overall"][2] == 3
    with pytest.raises(ValueError):
        engine.evaluate(str(tmp_path))


def test_long_statements_are_refused(engine, monkeypatch):
    monkeypatch.setattr(api, "MOST_NODES", 50)
    long = "select 1 as n" + " union all select 1" * 60
    with pytest.raises(ValueError, match="50 nodes"):
        engine.query(long + " union all select * from securities")
    assert engine.query("select 1 as n union all select 2").count() == 2


def test_archives_beyond_the_limit_give_nothing(monkeypatch):
    monkeypatch.setattr(formats, "MAX_BYTES", 1000)
    assert formats.text_of(gzip.compress(b"<p>" + b"x" * 2000 + b"</p>")) is None
    assert formats.text_of(gzip.compress(b"<p>short</p>")) == "short"
