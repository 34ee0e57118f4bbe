"""Queries over landed feeds. The payloads are made from the driver's tables, nulls and broken ones among them; the SQL states the rows they hold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import signals
from ..sources import asia, disclosures, payloads, statutes, vendors
from .catalogue import query
from .standins import base

_MARKET = "CASE {0} % 3 WHEN 0 THEN 'KR' WHEN 1 THEN 'HK' ELSE 'US' END"
_CCY = "CASE {0} % 3 WHEN 0 THEN 'KRW' WHEN 1 THEN 'HKD' ELSE 'USD' END"
_DAY = "strftime({0}, '%Y-%m-%d')"


def market(key: str) -> Column:
    return F.expr(_MARKET.format(key)).alias("market")


def symbol(key: str) -> Column:
    return F.col(key).cast("string").alias("symbol")


def day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def listed(df: DataFrame, keep: list, order: str, item: dict[str, Column], wrap: Column | None = None) -> DataFrame:
    """One payload for each ``keep``: the JSON list of its items in order; ``wrap`` may put it into another text."""
    rows = df.select(*keep, F.struct(F.col(order).alias("o"), F.to_json(F.struct(*(v.alias(k) for k, v in item.items()))).alias("j")).alias("x"))
    names = [c for c in rows.columns if c != "x"]
    text = F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["j"]), ","), F.lit("]"))
    out = rows.groupBy(*names).agg(text.alias("payload"))
    return out if wrap is None else out.withColumn("payload", wrap)


# -- vendors ---------------------------------------------------------------------------------


@query(f"""SELECT {_MARKET.format('c_custkey')} AS market, CAST(c_custkey AS VARCHAR) AS symbol, c_name AS name, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, CASE WHEN c_custkey % 2 = 0 THEN 'LONG' ELSE 'SHORT' END AS exchange, c_mktsegment AS sector
FROM customer WHERE c_custkey % 10 <> 0""")
def vendor_profiles(spark, d):
    c = base(spark, d, "customer")
    item = {"companyName": F.col("c_name"), "cik": F.col("c_custkey").cast("string"), "exchange": F.when(F.col("c_custkey") % 2 == 0, "LONG"), "exchangeShortName": F.lit("SHORT"), "sector": F.col("c_mktsegment")}
    rows = listed(c, [market("c_custkey"), symbol("c_custkey")], "c_custkey", item, F.when(F.col("symbol").cast("bigint") % 10 == 0, "[]").otherwise(F.col("payload")))
    return vendors.profiles(rows).select("market", "symbol", "name", "cik", "exchange", "sector")


@query(f"""SELECT {_MARKET.format('o_custkey')} AS market, CAST(o_custkey AS VARCHAR) AS symbol, {_DAY.format('o_orderdate')} AS trade_date, o_totalprice AS close, CASE WHEN o_orderkey % 4 > 0 THEN o_totalprice + 1 END AS high, o_orderkey AS volume, {_CCY.format('o_custkey')} AS currency
FROM orders WHERE o_custkey % 50 <> 0""")
def vendor_prices(spark, d):
    o = base(spark, d, "orders")
    item = {"date": day("o_orderdate"), "close": F.col("o_totalprice"), "high": F.when(F.col("o_orderkey") % 4 > 0, F.col("o_totalprice") + 1), "volume": F.col("o_orderkey")}
    key = F.col("symbol").cast("bigint")
    shape = F.when(key % 50 == 0, "not json").when(key % 2 == 0, F.concat(F.lit('{"symbol":"x","historical":'), "payload", F.lit("}"))).otherwise(F.col("payload"))
    return vendors.daily_prices(listed(o, [market("o_custkey"), symbol("o_custkey")], "o_orderkey", item, shape)).select("market", "symbol", "trade_date", "close", "high", "volume", "currency")


@query(f"""SELECT {_MARKET.format('p_partkey')} AS market, CAST(p_partkey AS VARCHAR) AS symbol, CAST(2000 + p_size % 20 AS INT) AS fiscal_year, CASE p_size % 3 WHEN 0 THEN 'FY' WHEN 1 THEN 'FY' ELSE 'Q1' END AS fiscal_period, account, value, '2023-12-31' AS period_end
FROM (SELECT p_partkey, p_size, p_retailprice AS revenue, CAST(p_size AS DOUBLE) AS netIncome, CAST((p_size % 2 = 0)::INT AS DOUBLE) AS audited FROM part) UNPIVOT (value FOR account IN (revenue, netIncome, audited)) WHERE p_size % 7 <> 0""")
def vendor_statements(spark, d):
    p = base(spark, d, "part")
    year = F.when(F.col("p_size") % 7 != 0, 2000 + F.col("p_size") % 20)
    period = F.when(F.col("p_size") % 3 == 1, "annual").when(F.col("p_size") % 3 == 2, "q1")
    item = {"date": F.lit("2023-12-31 00:00:00"), "fiscalYear": F.when(F.col("p_size") % 2 == 0, year.cast("string")), "calendarYear": year, "period": period, "revenue": F.col("p_retailprice"), "netIncome": F.col("p_size"), "audited": F.col("p_size") % 2 == 0, "auditor": F.col("p_name")}
    rows = listed(p, [market("p_partkey"), symbol("p_partkey"), F.lit("IS").alias("statement_type")], "p_partkey", item)
    return vendors.statements(rows).select("market", "symbol", "fiscal_year", "fiscal_period", "account", "value", "period_end")


@query(f"""SELECT {_MARKET.format('s_suppkey')} AS market, CAST(s_suppkey AS VARCHAR) AS symbol, CAST(CASE WHEN s_suppkey % 2 = 0 THEN 2021 ELSE 2020 END AS INT) AS fiscal_year, metric, value
FROM (SELECT s_suppkey, s_acctbal AS currentRatio, CAST(s_nationkey AS DOUBLE) AS days FROM supplier) UNPIVOT (value FOR metric IN (currentRatio, days))""")
def vendor_ratios(spark, d):
    item = {"date": F.lit("2020-12-31"), "calendarYear": F.when(F.col("s_suppkey") % 2 == 0, "2021"), "symbol": F.lit("x"), "currentRatio": F.col("s_acctbal"), "days": F.col("s_nationkey"), "note": F.col("s_name")}
    return vendors.ratios(listed(base(spark, d, "supplier"), [market("s_suppkey"), symbol("s_suppkey")], "s_suppkey", item)).select("market", "symbol", "fiscal_year", "metric", "value")


_NUMBER = "printf('%010d-24-%06d', o_orderkey, o_custkey)"


@query(f"""WITH f AS (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE {_DAY.format('o_orderdate')} END AS filed_date, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'https://h/' || {_NUMBER} || '/a.htm' ELSE 'https://h/plain' END AS url FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS symbol, coalesce(CASE WHEN o_orderkey % 7 > 0 AND o_orderkey % 2 = 0 THEN {_NUMBER} END, filed_date, url) AS filing_id, filed_date, o_orderpriority AS filing_type, url, (url IS NOT NULL)::INT AS n_urls
FROM f WHERE filed_date IS NULL OR filed_date BETWEEN '1995-01-01' AND '2010-12-31'""")
def vendor_filings(spark, d):
    number = F.format_string("%010d-24-%06d", "o_orderkey", "o_custkey")
    link = F.when(F.col("o_orderkey") % 7 == 0, F.lit(None)).when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("https://h/"), number, F.lit("/a.htm"))).otherwise("https://h/plain")
    item = {"acceptedDate": F.when(F.col("o_orderkey") % 5 != 0, F.concat(day("o_orderdate"), F.lit(" 10:00:00"))), "filingDate": F.lit(""), "formType": F.col("o_orderpriority"), "link": link}
    rows = vendors.filings(listed(base(spark, d, "orders"), [market("o_custkey"), symbol("o_custkey")], "o_orderkey", item), "1995-01-01", "2010-12-31")
    return rows.select("symbol", "filing_id", "filed_date", "filing_type", "url", F.size("doc_urls").alias("n_urls"))


@query("""SELECT CAST(c_nationkey AS VARCHAR) AS symbol, CAST(row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS INT) AS ord, c_name AS peer FROM customer""")
def vendor_peers(spark, d):
    c = base(spark, d, "customer")
    flat = listed(c.where("c_nationkey % 2 = 0"), [market("c_nationkey"), symbol("c_nationkey")], "c_custkey", {"symbol": F.col("c_name"), "companyName": F.lit("n")})
    names = F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", "c_name"))), lambda x: x["c_name"])
    nested = c.where("c_nationkey % 2 = 1").groupBy(market("c_nationkey"), symbol("c_nationkey")).agg(F.concat(F.lit("["), F.to_json(F.struct(names.alias("peersList"))), F.lit("]")).alias("payload"))
    return vendors.peers(flat.unionByName(nested)).select("symbol", "ord", "peer")


@query(f"""SELECT CAST(o_custkey AS VARCHAR) AS symbol, {_DAY.format('o_orderdate')} AS metric_date, o_totalprice AS market_cap, {_CCY.format('o_custkey')} AS currency FROM orders WHERE {_DAY.format('o_orderdate')} BETWEEN '1996-01-01' AND '1997-12-31'""")
def vendor_market_caps(spark, d):
    rows = listed(base(spark, d, "orders"), [market("o_custkey"), symbol("o_custkey")], "o_orderkey", {"date": day("o_orderdate"), "marketCap": F.col("o_totalprice")})
    return vendors.market_caps(rows, "1996-01-01", "1997-12-31").select("symbol", "metric_date", "market_cap", "currency")


@query(f"""SELECT CAST(l_suppkey AS VARCHAR) AS symbol, {_DAY.format('l_shipdate')} AS ex_date, 'dividend' AS action_type, CASE WHEN l_discount <> 0 THEN l_discount ELSE l_tax END AS amount, CAST(NULL AS DOUBLE) AS ratio FROM lineitem WHERE l_returnflag <> 'R'
UNION ALL SELECT CAST(l_suppkey AS VARCHAR), {_DAY.format('l_shipdate')}, 'split', NULL, l_quantity / nullif(l_linenumber - 1, 0) FROM lineitem WHERE l_returnflag = 'R'""")
def vendor_actions(spark, d):
    li = base(spark, d, "lineitem")
    keep = [market("l_suppkey"), symbol("l_suppkey")]
    div = listed(li.where("l_returnflag <> 'R'"), keep, "l_orderkey", {"date": day("l_shipdate"), "dividend": F.col("l_discount"), "adjDividend": F.col("l_tax")}, F.concat(F.lit('{"historical":'), "payload", F.lit("}")))
    cut = listed(li.where("l_returnflag = 'R'"), keep, "l_orderkey", {"date": day("l_shipdate"), "numerator": F.col("l_quantity"), "denominator": F.col("l_linenumber") - 1})
    return vendors.actions(div, cut).select("symbol", "ex_date", "action_type", "amount", "ratio")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS symbol, CAST(2024 AS INT) AS fiscal_year, m.metric, CASE m.metric WHEN 'revenue' THEN s_acctbal WHEN 'eps' THEN s_acctbal / 2 END AS avg_est, CASE m.metric WHEN 'revenue' THEN CAST(s_nationkey AS BIGINT) END AS num_analysts
FROM supplier, (SELECT unnest(['revenue', 'eps', 'ebitda']) AS metric) m WHERE s_suppkey % 4 > 0""")
def vendor_estimates(spark, d):
    item = {"date": F.when(F.col("s_suppkey") % 4 > 0, "2024-06-30"), "revenueAvg": F.col("s_acctbal"), "epsAvg": F.col("s_acctbal") / 2, "numAnalystsRevenue": F.col("s_nationkey")}
    return vendors.estimates(listed(base(spark, d, "supplier"), [market("s_suppkey"), symbol("s_suppkey")], "s_suppkey", item)).select("symbol", "fiscal_year", "metric", "avg_est", "num_analysts")


@query(f"""SELECT CAST(user_id AS VARCHAR) AS symbol, CASE WHEN event_id % 3 = 0 THEN '' ELSE {_DAY.format('ts')} END AS published_at, CASE WHEN event_id % 5 = 0 THEN '' ELSE event_type END AS title, 'https://n/' || event_id AS url FROM events""")
def vendor_news(spark, d):
    item = {"publishedDate": F.when(F.col("event_id") % 3 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")), "title": F.when(F.col("event_id") % 5 != 0, F.col("event_type")), "url": F.concat(F.lit("https://n/"), F.col("event_id").cast("string"))}
    return vendors.news(listed(base(spark, d, "events"), [market("user_id"), symbol("user_id")], "event_id", item)).select("symbol", "published_at", "title", "url")


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS symbol, '2023-01-31' AS period, s_acctbal AS env, CAST(s_nationkey AS DOUBLE) AS soc, CAST(NULL AS DOUBLE) AS gov, s_acctbal + s_nationkey AS total FROM supplier""")
def vendor_esg(spark, d):
    item = {"date": F.lit("20230131"), "environmentalScore": F.col("s_acctbal"), "socialScore": F.col("s_nationkey"), "governanceScore": F.lit("n/a"), "ESGScore": F.col("s_acctbal") + F.col("s_nationkey")}
    return vendors.esg(listed(base(spark, d, "supplier"), [market("s_suppkey"), symbol("s_suppkey")], "s_suppkey", item)).select("symbol", "period", "env", "soc", "gov", "total")


@query("""SELECT CAST(l_partkey AS VARCHAR) AS symbol, strftime(l_shipdate, '%Y-%m-%d') AS quarter, CASE WHEN l_linenumber = 1 THEN '' ELSE CAST(l_suppkey AS VARCHAR) END AS manager, l_quantity AS shares, l_extendedprice AS value FROM lineitem""")
def vendor_institutional(spark, d):
    item = {"dateReported": day("l_shipdate"), "holder": F.when(F.col("l_linenumber") > 1, F.col("l_suppkey").cast("string")), "shares": F.col("l_quantity"), "marketValue": F.col("l_extendedprice")}
    return vendors.institutional(listed(base(spark, d, "lineitem"), [market("l_partkey"), symbol("l_partkey")], "l_orderkey", item)).select("symbol", "quarter", "manager", "shares", "value")


@query(f"""SELECT CAST(user_id AS VARCHAR) AS symbol, {_DAY.format('ts')} AS event_date, value AS eps_estimate, CASE event_id % 3 WHEN 0 THEN value + 1 WHEN 1 THEN NULL ELSE value - 1 END AS eps_actual FROM events WHERE event_id % 6 <> 5""")
def vendor_earnings(spark, d):
    e = base(spark, d, "events")
    item = F.to_json(F.struct(F.when(F.col("event_id") % 6 != 5, day("ts")).alias("date"), F.col("value").alias("epsEstimated"), F.when(F.col("event_id") % 3 == 0, F.col("value") + 1).alias("epsActual"), (F.col("value") - 1).alias("eps")))
    item = F.when(F.col("event_id") % 3 == 1, F.concat(F.substring(item, F.lit(1), F.length(item) - 1), F.lit(',"epsActual":null}'))).otherwise(item)
    rows = e.select(market("user_id"), symbol("user_id"), F.concat(F.lit("["), item, F.lit("]")).alias("payload"))
    return vendors.earnings(rows).select("symbol", "event_date", "eps_estimate", "eps_actual")


@query("""SELECT upper(c_name) AS symbol, i.index_name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE '2001-02-03' END AS added FROM customer, (SELECT unnest(['S&P500', 'DOWJONES']) AS index_name) i WHERE c_custkey % 3 = 2 AND (i.index_name = 'S&P500' OR c_custkey % 2 = 0)""")
def vendor_index_members(spark, d):
    c = base(spark, d, "customer")
    item = {"symbol": F.lower("c_name"), "dateFirstAdded": F.when(F.col("c_custkey") % 4 != 0, "2001-02-03")}
    lists = listed(c, [F.lit("S&P500").alias("index_name")], "c_custkey", item).unionByName(listed(c.where("c_custkey % 2 = 0"), [F.lit("DOWJONES").alias("index_name")], "c_custkey", item))
    twice = lists.withColumn("payload", F.concat(F.expr("substring(payload, 1, length(payload) - 1)"), F.lit(","), F.expr("replace(substring(payload, 2), '2001', '2002')")))
    wanted = c.select(market("c_custkey"), F.upper("c_name").alias("symbol"))
    return vendors.index_members(wanted, twice).select("symbol", "index_name", "added")


@query(f"""SELECT {_DAY.format('o_orderdate')} AS rate_date, {_CCY.format('o_custkey')} AS base_ccy, 'USD' AS quote_ccy, o_totalprice AS rate FROM orders WHERE o_orderkey % 3 > 0""")
def vendor_fx_series(spark, d):
    o = base(spark, d, "orders").withColumn("base_ccy", F.expr(_CCY.format("o_custkey")))
    item = {"date": day("o_orderdate"), "close": F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice"))}
    return vendors.fx_series(listed(o, ["base_ccy", F.lit("USD").alias("quote_ccy")], "o_orderkey", item))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS symbol, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN NULL ELSE lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS cik, c_mktsegment AS sector FROM customer WHERE c_custkey % 5 NOT IN (0, 1)""")
def vendor_overviews(spark, d):
    k = F.col("c_custkey")
    text = F.to_json(F.struct(F.col("c_name").alias("Symbol"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Sector"), F.when(k % 2 == 0, "None").otherwise(k.cast("string")).alias("CIK")))
    payload = F.when(k % 5 == 0, '{"Note":"limit reached"}').when(k % 5 == 1, '{"Symbol":""}').otherwise(text)
    return vendors.overviews(base(spark, d, "customer").select(market("c_custkey"), symbol("c_custkey"), payload.alias("payload"))).select("symbol", "name", "cik", "sector")


@query(f"""SELECT CAST(o_custkey AS VARCHAR) AS symbol, {_DAY.format('o_orderdate')} AS trade_date, max(o_totalprice) AS close, CAST(max(o_custkey) AS BIGINT) AS volume FROM orders WHERE o_orderdate >= '1996-01-01' GROUP BY 1, 2""")
def vendor_daily_series(spark, d):
    o = base(spark, d, "orders").groupBy("o_custkey", day("o_orderdate").alias("day")).agg(F.max("o_totalprice").alias("p"))
    row = F.create_map(F.lit("4. close"), F.col("p").cast("string"), F.lit("5. volume"), F.col("o_custkey").cast("string"), F.lit("1. open"), F.lit("None"))
    payload = F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct("day", row))).alias("Time Series (Daily)")))
    return vendors.daily_series(o.groupBy(market("o_custkey"), symbol("o_custkey")).agg(payload.alias("payload")), "1996-01-01").select("symbol", "trade_date", "close", "volume")


@query("""SELECT CAST(l_suppkey AS VARCHAR) AS symbol, CAST(year(l_shipdate) AS INT) AS fiscal_year, CASE WHEN l_linenumber % 2 = 0 THEN 'FY' ELSE 'Q' || quarter(l_shipdate) END AS fiscal_period, account, value
FROM (SELECT l_suppkey, l_shipdate, l_linenumber, l_extendedprice AS totalRevenue, l_quantity AS shares FROM lineitem) UNPIVOT (value FOR account IN (totalRevenue, shares))""")
def vendor_reports(spark, d):
    li = base(spark, d, "lineitem")
    text = lambda c: F.col(c).cast("string")
    item = F.struct(day("l_shipdate").alias("fiscalDateEnding"), F.lit("USD").alias("reportedCurrency"), text("l_extendedprice").alias("totalRevenue"), text("l_quantity").alias("shares"), F.lit("None").alias("ebitda"))
    pick = lambda even: F.filter(F.collect_list(F.when((F.col("l_linenumber") % 2 == 0) == even, item)), lambda x: x.isNotNull())
    rows = li.groupBy(market("l_suppkey"), symbol("l_suppkey"), F.lit("IS").alias("statement_type")).agg(F.to_json(F.struct(pick(F.lit(True)).alias("annualReports"), pick(F.lit(False)).alias("quarterlyReports"))).alias("payload"))
    return vendors.reports(rows).select("symbol", "fiscal_year", "fiscal_period", "account", "value")


@query("""SELECT CAST(user_id AS VARCHAR) AS symbol, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS published_at, event_type AS title, CASE WHEN event_id % 2 = 0 THEN value ELSE 0.5 END AS sentiment FROM events""")
def vendor_scored_news(spark, d):
    own = F.struct(F.col("user_id").cast("string").alias("ticker"), F.col("value").cast("string").alias("ticker_sentiment_score"))
    other = F.struct(F.lit("other").alias("ticker"), F.lit("9").alias("ticker_sentiment_score"))
    item = {"title": F.col("event_type"), "time_published": F.date_format("ts", "yyyyMMdd'T'HHmmss"), "overall_sentiment_score": F.lit(0.5), "ticker_sentiment": F.when(F.col("event_id") % 2 == 0, F.array(other, own, other)).otherwise(F.array(other))}
    rows = listed(base(spark, d, "events"), [market("user_id"), symbol("user_id")], "event_id", item, F.concat(F.lit('{"feed":'), "payload", F.lit("}")))
    return vendors.scored_news(rows).select("symbol", "published_at", "title", "sentiment")


@query("""SELECT c_custkey AS company_id, CASE WHEN c_custkey % 3 = 0 THEN 'L1' WHEN c_custkey % 3 = 1 THEN 'L2' ELSE 'L1' END AS lei FROM customer WHERE c_custkey % 3 < 2 OR c_custkey % 2 = 0""")
def lei_lookup(spark, d):
    k = F.col("c_custkey")
    record = lambda i, country: F.struct(F.lit(i).alias("id"), F.struct(F.struct(F.struct(country.alias("country")).alias("legalAddress")).alias("entity")).alias("attributes"))
    two = F.array(record("L1", F.when(k % 3 == 0, "US").when(k % 3 == 1, "HK").otherwise(F.when(k % 2 == 0, F.lit(None)).otherwise("KR"))), record("L2", F.when(k % 3 == 1, "US").otherwise("KR")))
    return vendors.lei_of(base(spark, d, "customer").select(k.alias("company_id"), F.lit("US").alias("country"), F.to_json(F.struct(two.alias("data"))).alias("payload")))


@query(f"""SELECT CAST(o_custkey AS VARCHAR) AS symbol, {_DAY.format('o_orderdate')} AS trade_date, o_totalprice AS close, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice - 1 END AS open, CAST(o_orderkey AS BIGINT) AS volume, CASE WHEN o_custkey % 2 = 0 THEN {_CCY.format('o_custkey')} ELSE 'EUR' END AS currency FROM orders WHERE o_orderkey % 5 > 0 AND o_custkey % 9 > 0""")
def chart_prices(spark, d):
    k = F.col("o_orderkey")
    x = F.struct("o_orderkey", F.unix_timestamp("o_orderdate").alias("t"), F.when(k % 5 > 0, F.col("o_totalprice")).alias("c"), F.when(k % 3 > 0, F.col("o_totalprice") - 1).alias("o"))
    rows = base(spark, d, "orders").groupBy(market("o_custkey"), symbol("o_custkey")).agg(F.array_sort(F.collect_list(x)).alias("x"))
    part = lambda n: F.concat(F.lit("["), F.array_join(F.transform("x", lambda r: F.coalesce(r[n].cast("string"), F.lit("null"))), ","), F.lit("]"))
    ccy = F.when(F.col("symbol").cast("bigint") % 2 == 0, "{}").otherwise('{"currency":"EUR"}')
    text = F.concat(F.lit('{"chart":{"result":[{"meta":'), ccy, F.lit(',"timestamp":'), part("t"), F.lit(',"indicators":{"quote":[{"close":'), part("c"), F.lit(',"open":'), part("o"), F.lit(',"volume":'), part("o_orderkey"), F.lit("}]}}]}}"))
    text = F.when(F.col("symbol").cast("bigint") % 9 == 0, '{"chart":{"result":null,"error":{"code":"Not Found"}}}').otherwise(text)
    return payloads.chart_prices(rows.select("market", "symbol", text.alias("payload"))).select("symbol", "trade_date", "close", "open", "volume", "currency")


@query("""WITH p AS (SELECT l_suppkey, l_partkey % 6 AS c, CAST(2000 + l_quantity % 4 AS INT) AS fy, l_orderkey, l_linenumber, l_extendedprice AS val, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS fin FROM lineitem WHERE l_quantity % 4 > 0),
k AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey, c, fy, l_returnflag <> 'N' ORDER BY (l_orderkey % 3 = 0) DESC, CASE WHEN l_orderkey % 2 = 0 THEN fin ELSE '' END DESC, fin DESC, l_orderkey, l_linenumber, val) AS n FROM p)
SELECT CAST(l_suppkey AS VARCHAR) AS symbol, fy AS fiscal_year, 'Concept' || c AS account, CASE WHEN l_returnflag = 'N' THEN 'BS' ELSE 'IS' END AS statement_type, val AS value, fin AS period_end FROM k WHERE n = 1""")
def company_fact_rows(spark, d):
    k = F.col("l_orderkey")
    li = base(spark, d, "lineitem")
    point = F.struct("l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("val"), day("l_shipdate").alias("end"), F.when(F.col("l_returnflag") != "N", "2000-01-01").alias("start"), F.when(F.col("l_quantity") % 4 > 0, (2000 + F.col("l_quantity") % 4).cast("int")).alias("fy"), F.lit("FY").alias("fp"), F.lit("10-K").alias("form"), F.when(k % 2 == 0, day("l_shipdate")).alias("filed"), F.when(k % 3 == 0, "CY").alias("frame"))
    points = li.groupBy(symbol("l_suppkey"), (F.col("l_partkey") % 6).alias("c")).agg(F.array_sort(F.collect_list(point)).alias("p"))
    junk = F.array(F.struct(F.lit(1.0).alias("val"), F.lit("2001-01-01").alias("end"), F.lit(2001).alias("fy"), F.lit("FY").alias("fp"), F.lit("8-K").alias("form")))
    facts = points.groupBy("symbol").agg(F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("Concept"), F.col("c").cast("string")), F.struct(F.struct(F.col("p").alias("USD")).alias("units"))))).alias("m"))
    text = F.to_json(F.struct(F.struct(F.col("m").alias("us-gaap"), F.create_map(F.lit("Other"), F.struct(F.struct(junk.alias("USD")).alias("units"))).alias("dei"), F.create_map(F.lit("Concept9"), F.struct(F.struct(junk.alias("USD")).alias("units"))).alias("ifrs-full")).alias("facts")))
    return payloads.company_facts(facts.select("symbol", text.alias("payload"))).select("symbol", "fiscal_year", "account", "statement_type", "value", "period_end")


@query(f"""SELECT CAST(l_suppkey AS VARCHAR) AS symbol, {_DAY.format('l_shipdate')} AS ex_date, 'dividend' AS action_type, l_discount AS value FROM lineitem WHERE l_returnflag <> 'R' UNION ALL SELECT CAST(l_suppkey AS VARCHAR), {_DAY.format('l_shipdate')}, 'split', nullif(l_quantity, 0) / nullif(l_linenumber - 1, 0) FROM lineitem WHERE l_returnflag = 'R'""")
def chart_actions(spark, d):
    li = base(spark, d, "lineitem")
    at = F.unix_timestamp("l_shipdate").alias("date")
    numbered = li.withColumn("id", F.monotonically_increasing_id().cast("string"))
    entry = lambda flag, *fields: F.map_from_entries(F.collect_list(F.when((F.col("l_returnflag") == "R") == (flag == "R"), F.struct(F.col("id"), F.struct(at, *fields)))))
    rows = numbered.groupBy(symbol("l_suppkey")).agg(F.to_json(F.struct(entry("A", F.col("l_discount").alias("amount")).alias("dividends"), entry("R", F.col("l_quantity").alias("numerator"), (F.col("l_linenumber") - 1).alias("denominator")).alias("splits"))).alias("payload"))
    return payloads.corporate_actions(rows).select("symbol", "ex_date", "action_type", "value")


# -- United States ------------------------------------------------------------------------------


@query("""SELECT 'US' AS market, upper(c_name) AS symbol, c_name AS name, lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, CASE c_nationkey % 3 WHEN 0 THEN 'NASDAQ' WHEN 1 THEN 'NYSEARCA' ELSE 'Other' END AS exchange FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 'US', upper(c_name), c_name, lpad(CAST(c_custkey AS VARCHAR), 10, '0'), NULL FROM customer WHERE c_custkey % 2 = 1""")
def ticker_master(spark, d):
    c = base(spark, d, "customer")
    venue = F.when(F.col("c_nationkey") % 3 == 0, "Nasdaq").when(F.col("c_nationkey") % 3 == 1, "NYSE Arca").otherwise("Other")
    row = F.concat(F.lit("["), F.concat_ws(",", F.col("c_custkey").cast("string"), *(F.concat(F.lit('"'), x, F.lit('"')) for x in (F.col("c_name"), F.lower("c_name"), venue))), F.lit("]"))
    lists = c.where("c_custkey % 2 = 0").agg(F.concat(F.lit('{"fields":["cik","name","ticker","exchange"],"data":['), F.array_join(F.collect_list(row), ","), F.lit("]}")).alias("payload"))
    entry = F.struct(F.col("c_custkey").alias("cik_str"), F.lower("c_name").alias("ticker"), F.col("c_name").alias("title"))
    maps = c.where("c_custkey % 2 = 1").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(F.col("c_custkey").cast("string"), entry)))).alias("payload"))
    return disclosures.master(disclosures.ticker_map(lists.unionByName(maps))).select("market", "symbol", "name", "cik", "exchange")


def submissions(spark, d) -> DataFrame:
    """Landed submissions: a customer's orders as parallel arrays, the list of documents one short."""
    o = base(spark, d, "orders").withColumn("x", F.struct("o_orderkey", F.format_string("%010d-24-%06d", "o_custkey", "o_orderkey").alias("a"), day("o_orderdate").alias("f"), F.expr("CASE o_orderkey % 4 WHEN 0 THEN '4' WHEN 1 THEN 'SC 13G' WHEN 2 THEN '10-K' ELSE 'SC 13D/A' END").alias("t"), F.expr("CASE WHEN o_orderkey % 4 = 0 THEN concat('xslF345/', o_orderkey, '.xml') ELSE concat(o_orderkey, '.htm') END").alias("p")))
    rows = o.groupBy(symbol("o_custkey"), F.col("o_custkey").cast("string").alias("cik")).agg(F.array_sort(F.collect_list("x")).alias("x"))
    part = lambda n, drop=0: F.slice(F.transform("x", lambda r: r[n]), F.lit(1), F.size("x") - drop)
    recent = F.struct(part("a").alias("accessionNumber"), part("f").alias("filingDate"), part("t").alias("form"), part("p", 1).alias("primaryDocument"))
    return rows.select("symbol", "cik", F.to_json(F.struct(F.struct(recent.alias("recent")).alias("filings"))).alias("payload"))


_FILED = """f AS (SELECT *, CAST(o_custkey AS VARCHAR) AS symbol, printf('%010d-24-%06d', o_custkey, o_orderkey) AS filing_id, strftime(o_orderdate, '%Y-%m-%d') AS filed_date, row_number() OVER w - 1 AS ord, lead(o_orderkey) OVER w IS NULL AS lacks,
CASE o_orderkey % 4 WHEN 0 THEN '4' WHEN 1 THEN 'SC 13G' WHEN 2 THEN '10-K' ELSE 'SC 13D/A' END AS filing_type FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))"""


@query(f"""WITH {_FILED} SELECT symbol, CAST(ord AS INT) AS ord, filing_id, filed_date, filing_type, 'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/' || replace(filing_id, '-', '') || CASE WHEN lacks THEN '' WHEN o_orderkey % 4 = 0 THEN '/xslF345/' || o_orderkey || '.xml' ELSE '/' || o_orderkey || '.htm' END AS url
FROM f WHERE filed_date BETWEEN '1994-01-01' AND '2030-01-01'""")
def submission_filings(spark, d):
    return disclosures.submissions(submissions(spark, d), "1994-01-01", "2030-01-01").select("symbol", "ord", "filing_id", "filed_date", "filing_type", "url")


_LIMITED = "k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ord) AS n FROM f WHERE filing_type = '4' AND NOT lacks)"


@query(f"""WITH {_FILED}, {_LIMITED}, t AS (SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_extendedprice) - 1 AS INT) AS txn_seq, CASE l_returnflag WHEN 'A' THEN 'buy' WHEN 'R' THEN 'sell' ELSE 'hold' END AS txn_type, l_quantity AS shares, CASE WHEN l_linenumber % 2 = 0 THEN l_extendedprice END AS price FROM lineitem)
SELECT k.symbol, k.filed_date, k.filing_id, 'Owner ' || k.o_custkey AS insider, CASE k.o_custkey % 3 WHEN 0 THEN 'CEO' WHEN 1 THEN 'director' END AS relation, coalesce(txn_type, 'hold') AS txn_type, coalesce(txn_seq, 0) AS txn_seq, shares, price
FROM k LEFT JOIN t ON t.l_orderkey = k.o_orderkey WHERE n <= 25""")
def insider_forms(spark, d):
    filings = disclosures.raw_xml_url(disclosures.submissions(submissions(spark, d)))
    li = base(spark, d, "lineitem")
    txn = F.concat(F.lit("<nonDerivativeTransaction><transactionAmounts><transactionShares><value>"), F.col("l_quantity").cast("string"), F.lit("</value></transactionShares>"), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("<transactionPricePerShare>\n <value>"), F.col("l_extendedprice").cast("string"), F.lit("</value></transactionPricePerShare>"))).otherwise(F.lit("")), F.when(F.col("l_returnflag") != "N", F.concat(F.lit("<transactionAcquiredDisposedCode><value>"), F.when(F.col("l_returnflag") == "A", "A").otherwise("D"), F.lit("</value></transactionAcquiredDisposedCode>"))).otherwise(F.lit("")), F.lit("</transactionAmounts></nonDerivativeTransaction>"))
    txns = li.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_extendedprice", txn.alias("x")))), lambda r: r["x"]), "").alias("t"))
    k = F.col("o_custkey") % 3
    owner = F.concat(F.lit("<?xml version=\"1.0\"?><ownershipDocument><rptOwnerName>Owner "), F.col("o_custkey").cast("string"), F.lit("</rptOwnerName>"), F.when(k == 0, "<officerTitle>CEO</officerTitle>").when(k == 1, "<isDirector>1</isDirector>").otherwise(""), F.coalesce("t", F.lit("")), F.lit("</ownershipDocument>"))
    url = F.concat_ws("/", F.lit(disclosures.ARCHIVE), F.col("o_custkey").cast("string"), F.format_string("%010d24%06d", "o_custkey", "o_orderkey"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".xml")))
    docs = base(spark, d, "orders").where("o_orderkey % 4 = 0").join(txns, "o_orderkey", "left").select(url.alias("url"), owner.alias("content"))
    return disclosures.insider_trades(filings, docs)


@query(f"""WITH {_FILED}, k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ord) AS n FROM f WHERE filing_type LIKE 'SC 13%' AND NOT lacks AND o_orderkey % 5 > 0)
SELECT symbol, filed_date AS as_of_date, CASE WHEN o_orderkey % 3 = 0 THEN '(unknown)' ELSE 'Holder ' || chr(CAST(65 + o_custkey % 26 AS INT)) || ' Fund' END AS holder_name, filing_type AS holder_type, CAST(1000 + o_custkey AS DOUBLE) AS shares, CAST(o_custkey % 90 AS DOUBLE) + 0.5 AS pct FROM k WHERE n <= 15""")
def large_holder_forms(spark, d):
    filings = disclosures.submissions(submissions(spark, d))
    name = F.concat(F.lit("Holder "), F.expr("char(65 + o_custkey % 26)"), F.lit(" Fund - 23-1945930"))
    label = F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("<td>NAMES OF REPORTING PERSONS</td><td>I.R.S. Identification</td><td>(1)</td><td>"), name, F.lit("</td>"))).otherwise("")
    body = F.concat(F.lit("<html><style>x</style><table><tr>"), label, F.lit("</tr><tr><td>AGGREGATE AMOUNT BENEFICIALLY OWNED</td><td>"), F.format_number(1000 + F.col("o_custkey"), 0), F.lit("</td><td>PERCENT OF CLASS represented</td><td>"), (F.col("o_custkey") % 90).cast("string"), F.lit(".5 %</td></tr></table></html>"))
    content = F.when(F.col("o_orderkey") % 5 == 0, "<p>nothing here</p>").otherwise(body)
    url = F.concat_ws("/", F.lit(disclosures.ARCHIVE), F.col("o_custkey").cast("string"), F.format_string("%010d24%06d", "o_custkey", "o_orderkey"), F.concat(F.col("o_orderkey").cast("string"), F.lit(".htm")))
    docs = base(spark, d, "orders").where("o_orderkey % 4 IN (1, 3)").select(url.alias("url"), content.alias("content"))
    return disclosures.large_holders(filings, docs)


@query("""SELECT CAST(c_custkey AS VARCHAR) AS symbol, strftime(o_orderdate, '%d-%b-%Y') AS quarter, o_orderpriority AS manager, l_quantity AS shares, l_extendedprice AS value FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey""")
def fund_holdings(spark, d):
    o, c = base(spark, d, "orders"), base(spark, d, "customer")
    cover = o.select(F.col("o_orderkey").cast("string").alias("ACCESSION_NUMBER"), F.col("o_orderpriority").alias("FILINGMANAGER_NAME"), F.date_format("o_orderdate", "dd-MMM-yyyy").alias("REPORTCALENDARORQUARTER"))
    info = base(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("c_custkey") == F.col("o_custkey"))
    info = info.select(F.col("l_orderkey").cast("string").alias("ACCESSION_NUMBER"), F.lower(F.replace("c_name", F.lit("#"), F.lit(" - "))).alias("NAMEOFISSUER"), F.col("l_extendedprice").cast("string").alias("VALUE"), F.col("l_quantity").cast("string").alias("SSHPRNAMT"))
    return disclosures.fund_holdings(c.select(F.col("c_custkey").cast("string").alias("symbol"), F.col("c_name").alias("title")), cover, info)


@query("""WITH p AS (SELECT o_custkey % 40 AS s, strftime(o_orderdate, '%Y-%m') AS month, o_orderkey AS deal, o_orderdate, o_totalprice, row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY strftime(o_orderdate, '%Y-%m') DESC, o_orderkey) AS n FROM orders WHERE strftime(o_orderdate, '%Y-%m') BETWEEN '1995-08' AND '1997-07'),
f AS (SELECT o_orderkey AS deal, strftime(o_orderdate - INTERVAL 3 MONTH, '%Y-%m') AS month, floor(o_totalprice / 2) AS size FROM orders WHERE o_orderkey % 2 = 0)
SELECT 'T' || s AS symbol, strftime(o_orderdate, '%Y-%m-%d') AS signal_date, f.size AS filed_amount, floor(o_totalprice) AS priced_amount FROM p LEFT JOIN f ON f.deal = p.deal AND f.month <= p.month AND f.month > strftime(CAST(p.month || '-01' AS DATE) - INTERVAL 6 MONTH, '%Y-%m') WHERE n = 1""")
def offering_calendar(spark, d):
    o = base(spark, d, "orders")
    money = lambda c: F.concat(F.lit("$"), F.format_number(F.floor(c), 0))
    deal = F.col("o_orderkey").cast("string").alias("dealID")
    priced = F.struct(F.concat(F.lit("t"), (F.col("o_custkey") % 40).cast("string")).alias("proposedTickerSymbol"), deal, F.date_format("o_orderdate", "M/dd/yyyy").alias("pricedDate"), money(F.col("o_totalprice")).alias("dollarValueOfSharesOffered"))
    filed = F.struct(deal, money(F.col("o_totalprice") / 2).alias("dollarValueOfSharesOffered"))
    a = o.select(F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.struct("o_orderkey", priced.alias("r")).alias("p"))
    b = o.where("o_orderkey % 2 = 0").select(F.date_format(F.add_months("o_orderdate", -3), "yyyy-MM").alias("month"), F.struct("o_orderkey", filed.alias("r")).alias("f"))
    side = lambda df, c: df.groupBy("month").agg(F.transform(F.array_sort(F.collect_list(c)), lambda x: x["r"]).alias(c))
    months = side(a, "p").join(side(b, "f"), "month", "full_outer")
    payload = F.to_json(F.struct(F.struct(F.struct(F.col("p").alias("rows")).alias("priced"), F.struct(F.col("f").alias("rows")).alias("filed")).alias("data")))
    wanted = o.select(F.concat(F.lit("T"), (F.col("o_custkey") % 40).cast("string")).alias("symbol")).distinct()
    return disclosures.offerings(wanted, months.select("month", payload.alias("payload")), "1997-07-15").select("symbol", "signal_date", "filed_amount", "priced_amount")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS symbol, strftime(o_orderdate, '%Y-%m-%d') AS signal_date, 'S-1 Exhibit mentions "oversubscribed" [IPO 확정일 대비' || CASE WHEN abs(date_diff('day', DATE '1996-06-01', CAST(o_orderdate AS DATE))) <= 30 THEN '' ELSE ' (별건일 가능성)' END || ' ' || printf('%+d', date_diff('day', DATE '1996-06-01', CAST(o_orderdate AS DATE))) || '일]' AS detail,
'https://www.sec.gov/Archives/edgar/data/' || o_custkey || '/' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') || '24/f.htm' AS url FROM orders WHERE o_orderkey % 3 > 0 AND o_orderkey % 5 > 0""")
def search_hits(spark, d):
    k = F.col("o_orderkey")
    ident = F.concat(F.lpad(k.cast("string"), 10, "0"), F.lit("-24"), F.when(k % 5 > 0, ":f.htm").otherwise(""))
    source = F.struct(F.array(F.col("o_custkey").cast("string")).alias("ciks"), F.lit("S-1").alias("form"), F.lit("Exhibit").alias("file_description"), F.when(k % 3 == 0, "ex-1.1").alias("file_type"), day("o_orderdate").alias("file_date"))
    rows = listed(base(spark, d, "orders"), [symbol("o_custkey"), F.lit("1996-06-01").alias("ipo_date")], "o_orderkey", {"_id": ident, "_source": source}, F.concat(F.lit('{"hits":{"hits":'), "payload", F.lit("}}")))
    return disclosures.text_hits(rows, "oversubscribed", "sec_fulltext", "2024-01-01", skip_underwriting=True).select("symbol", "signal_date", "detail", "url")


def _prospectuses(spark, d) -> DataFrame:
    """Filings with text: registrations with a range for some, prospectuses with a final price for some, investors in both."""
    o = base(spark, d, "orders")
    k = F.col("o_orderkey")
    kind = F.when(k % 3 == 0, "S-1/A").when(k % 3 == 1, "424B4").otherwise("10-K")
    low = F.format_string("%d.00", 10 + k % 5)
    ranged = F.concat(F.lit("The initial public Offering  price per share will be between $"), low, F.lit(" and $"), F.format_string("%d.50", 12 + k % 5), F.lit(" each."))
    final = F.concat(F.lit("The initial public offering price is $"), F.format_string("%d.25", 13 + k % 9), F.lit(" per share."))
    invest = F.concat(F.lit(" Fund "), F.expr("char(65 + o_orderkey % 4)"), F.lit(" has indicated an interest in purchasing up to $"), (1 + k % 3).cast("string"), F.lit(" million of shares."))
    text = F.concat(F.when((k % 3 == 0) & (k % 2 == 0), ranged).when((k % 3 == 1) & (k % 4 != 0), final).otherwise("Nothing of that."), F.when(k % 7 == 0, invest).otherwise(""))
    return o.select(symbol("o_custkey"), k.cast("string").alias("filing_id"), k.alias("ord"), day("o_orderdate").alias("filed_date"), kind.alias("filing_type"), F.concat(F.lit("u"), k.cast("string")).alias("url"), text.alias("text"))


@query("""WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS dt FROM orders),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt, k) AS n FROM f WHERE k % 3 = 0 AND k % 2 = 0) WHERE n = 1), p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt, k) AS n FROM f WHERE k % 3 = 1 AND k % 4 <> 0) WHERE n = 1),
l AS (SELECT symbol, 'u' || arg_max(k, (dt, k)) AS url FROM f WHERE k % 3 = 0 GROUP BY 1),
b AS (SELECT coalesce(r.symbol, p.symbol) AS symbol, r.dt AS ra, p.dt AS pa, r.k AS rk, p.k AS pk, printf('$%.2f-$%.2f', 10.0 + r.k % 5, 12.5 + r.k % 5) AS rng, printf('$%.2f', 13.25 + p.k % 9) AS fin FROM r FULL JOIN p USING (symbol))
SELECT b.symbol, coalesce(pa, ra) AS signal_date, CASE WHEN pk IS NOT NULL THEN 13.25::DOUBLE + pk % 9 END AS price, CASE WHEN rk IS NULL THEN 'Final price ' || fin || ' (' || pa || '); no price range found in registration filings' WHEN pk IS NULL THEN 'Initial range ' || rng || ' (' || ra || '); no 424B priced yet'
ELSE 'Initial range ' || rng || ' (' || ra || ') -> final ' || fin || ' (' || pa || '), ' || printf('%+d', CAST(round_even((13.25 + pk % 9 - 12.5 - rk % 5) / (12.5 + rk % 5) * 100, 0) AS INT)) || '% vs. range top' END AS detail, coalesce('u' || pk, l.url) AS url FROM b LEFT JOIN l ON l.symbol = b.symbol""")
def price_band_signals(spark, d):
    rows = signals.price_band_signals(_prospectuses(spark, d)).select("symbol", "signal_date", "price", "detail", "url")
    return rows.withColumn("detail", F.replace("detail", F.lit(", -0%"), F.lit(", +0%")))


@query("""WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS symbol, o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS dt, 'Fund ' || chr(CAST(65 + o_orderkey % 4 AS INT)) AS investor_name, (1 + o_orderkey % 3) * 1e6 AS indicated_amount FROM orders WHERE o_orderkey % 3 < 2 AND o_orderkey % 7 = 0)
SELECT symbol, dt AS signal_date, investor_name, indicated_amount, 'u' || k AS url FROM (SELECT *, row_number() OVER (PARTITION BY symbol, investor_name, indicated_amount ORDER BY dt, k) AS n FROM f) WHERE n = 1""")
def anchor_investors(spark, d):
    return signals.anchor_signals(_prospectuses(spark, d)).select("symbol", "signal_date", "investor_name", "indicated_amount", "url")


# -- Korea and Hong Kong ---------------------------------------------------------------------------


@query("SELECT 'KR' AS market, lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS symbol, s_name AS name, lpad(CAST(s_suppkey AS VARCHAR), 8, '0') AS corp_code FROM supplier WHERE s_suppkey % 4 > 0")
def korean_master(spark, d):
    k = F.col("s_suppkey")
    code = F.when(k % 4 > 0, F.concat(F.lit(" "), F.lpad(k.cast("string"), 6, "0"))).otherwise("")
    return asia.listed_companies(base(spark, d, "supplier").select(code.alias("stock_code"), F.col("s_name").alias("corp_name"), F.lpad(k.cast("string"), 8, "0").alias("corp_code"))).select("market", "symbol", "name", "corp_code")


@query("""SELECT CAST(l_suppkey AS VARCHAR) AS symbol, y.y AS fiscal_year, CASE r.r WHEN '11011' THEN 'FY' WHEN '11014' THEN 'Q3' WHEN '11012' THEN 'H1' ELSE 'Q1' END AS fiscal_period, s.s AS fs_scope, CASE l_returnflag WHEN 'A' THEN 'IS' WHEN 'R' THEN 'BS' END AS statement_type, l_shipmode_ AS account, CASE WHEN l_linenumber = 1 THEN NULL ELSE -floor(l_extendedprice) END AS value, y.y || '-12-31' AS period_end
FROM (SELECT *, 'acct' || l_linenumber AS l_shipmode_ FROM lineitem WHERE l_linenumber <> 4), (SELECT unnest([2022, 2023])::INT AS y) y, (SELECT unnest(['11011', '11014', '11012', '11013']) AS r) r, (SELECT unnest(['CFS', 'OFS']) AS s) s""")
def korean_statements(spark, d):
    li = base(spark, d, "lineitem")
    amount = F.when(F.col("l_linenumber") == 1, "-").otherwise(F.concat(F.lit("-"), F.format_number(F.floor("l_extendedprice"), 0)))
    # the feed answers a year's requests with one text
    wanted = asia.statement_requests(spark, [2022, 2023]).groupBy("fiscal_year").agg(F.collect_list(F.struct("reprt_code", "fs_scope")).alias("requests"))
    rows = listed(li, [symbol("l_suppkey")], "l_orderkey", {"account_nm": F.when(F.col("l_linenumber") != 4, F.concat(F.lit("acct"), F.col("l_linenumber").cast("string"))), "sj_div": F.when(F.col("l_returnflag") == "A", "cis").when(F.col("l_returnflag") == "R", "BS").otherwise("SCE"), "thstrm_amount": amount, "thstrm_dt": F.lit("YYYY.01.01 ~ YYYY.12.31")})
    landed = rows.crossJoin(F.broadcast(wanted)).withColumn("payload", F.replace("payload", F.lit("YYYY"), F.col("fiscal_year").cast("string")))
    return asia.statement_rows(landed).select("symbol", "fiscal_year", "fiscal_period", "fs_scope", "statement_type", "account", "value", "period_end")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderkey AS VARCHAR) AS filing_id, strftime(o_orderdate, '%Y-%m-%d') AS filed_date, o_orderpriority AS filing_type, 'https://dart.fss.or.kr/dsaf001/main.do?rcpNo=' || o_orderkey AS url FROM orders""")
def korean_filings(spark, d):
    item = {"rcept_no": F.col("o_orderkey").cast("string"), "rcept_dt": F.date_format("o_orderdate", "yyyyMMdd"), "report_nm": F.col("o_orderpriority")}
    return asia.korean_filings(listed(base(spark, d, "orders"), [symbol("o_custkey")], "o_orderkey", item)).select("symbol", "filing_id", "filed_date", "filing_type", "url")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS symbol, strftime(o_orderdate, '%Y-%m-%d') AS as_of_date, CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE 'H' || o_orderkey END AS holder_name, floor(o_totalprice) AS shares, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE 5.25::DOUBLE END AS pct FROM orders WHERE o_orderkey % 6 <> 0""")
def korean_holders(spark, d):
    k = F.col("o_orderkey")
    item = {"rcept_dt": F.date_format("o_orderdate", "yyyy.MM.dd"), "repror": F.when(k % 3 != 0, F.concat(F.lit("H"), k.cast("string"))), "report_tp": F.when(k % 6 != 0, F.col("o_orderpriority")), "stkqy": F.format_number(F.floor("o_totalprice"), 0), "stkrt": F.when(k % 2 == 0, "-").otherwise("5.25")}
    return asia.korean_holders(listed(base(spark, d, "orders"), [symbol("o_custkey")], "o_orderkey", item)).select("symbol", "as_of_date", "holder_name", "shares", "pct")


@query("""SELECT CAST(user_id AS VARCHAR) AS symbol, strftime(ts, '%Y-%m-%d') AS filed_date, 'I' || event_id AS insider, CASE WHEN event_id % 4 = 0 OR floor(value * 100) = 0 THEN 'hold' WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS txn_type, CAST(row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) - 1 AS INT) AS txn_seq, CASE WHEN event_id % 4 = 0 OR floor(value * 100) = 0 THEN 7777.0 ELSE floor(value * 100) END AS shares, event_type AS filing_id
FROM events WHERE event_id % 5 > 0""")
def korean_insiders(spark, d):
    k, n = F.col("event_id"), F.format_number(F.floor(F.col("value") * 100), 0)
    e = base(spark, d, "events")
    item = {"rcept_no": F.col("event_type"), "rcept_dt": F.date_format("ts", "yyyy.MM.dd"), "repror": F.when(k % 5 > 0, F.concat(F.lit("I"), k.cast("string"))), "sp_stock_lmp_irds_cnt": F.when(k % 8 == 0, "-").when(k % 4 == 0, "0").when(k % 2 == 0, n).otherwise(F.concat(F.lit("-"), n)), "sp_stock_lmp_cnt": F.lit("7,777")}
    return asia.korean_insiders(listed(e, [symbol("user_id")], "event_id", item)).select("symbol", "filed_date", "insider", "txn_type", "txn_seq", "shares", "filing_id")


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE value END AS value FROM events""")
def nan_scrub(spark, d):
    rows = base(spark, d, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("value"))
    return asia.scrubbed(rows)


@query("""SELECT CAST(o_custkey AS VARCHAR) AS symbol, strftime(o_orderdate, '%Y-%m-%d') AS trade_date, o_totalprice AS close, CAST(o_orderkey AS BIGINT) AS volume, CAST(NULL AS DOUBLE) AS adj_close FROM orders WHERE o_orderkey % 4 > 0""")
def korean_prices(spark, d):
    k = F.col("o_orderkey")
    rows = base(spark, d, "orders").select(symbol("o_custkey"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("day"), F.col("o_totalprice").alias("시가"), F.col("o_totalprice").alias("고가"), F.col("o_totalprice").alias("저가"), F.when(k % 8 == 0, F.lit(float("nan"))).when(k % 4 > 0, F.col("o_totalprice")).alias("종가"), k.alias("거래량"))
    return asia.korean_prices(rows).select("symbol", "trade_date", "close", "volume", "adj_close")


@query("SELECT CAST(s_suppkey AS VARCHAR) AS symbol, '2024-05-31' AS metric_date, CAST(s_suppkey AS DOUBLE) AS shares_outstanding, s_acctbal AS foreign_own_pct FROM supplier")
def foreign_ownership(spark, d):
    rows = base(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("ticker"), F.col("s_suppkey").alias("상장주식수(주)"), F.col("s_acctbal").alias("지분율"), F.lit(0).alias("지분율 한도"))
    return asia.foreign_ownership(rows, "2024-05-31").select("symbol", "metric_date", "shares_outstanding", "foreign_own_pct")


@query("""SELECT DISTINCT CAST(l_suppkey AS VARCHAR) AS symbol, CASE l_returnflag WHEN 'A' THEN 'KOSPI200' WHEN 'R' THEN 'KRX100' END AS index_name FROM lineitem WHERE l_returnflag <> 'N' AND l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 12)""")
def korean_indices(spark, d):
    code = F.when(F.col("l_returnflag") == "A", "1028").when(F.col("l_returnflag") == "R", "1035").otherwise("9999")
    wanted = base(spark, d, "supplier").where("s_nationkey < 12").select(symbol("s_suppkey"))
    return asia.korean_indices(base(spark, d, "lineitem").select(code.alias("code"), F.col("l_suppkey").cast("string").alias("ticker")), wanted)


@query("SELECT lpad(CAST(s_suppkey AS VARCHAR), 5, '0') AS symbol, s_name AS name, CAST(s_suppkey + 1000 AS VARCHAR) AS stock_id FROM supplier")
def hk_master(spark, d):
    k = F.col("s_suppkey")
    return asia.hk_stocks(listed(base(spark, d, "supplier"), [F.lit(1).alias("all")], "s_suppkey", {"c": k.cast("string"), "i": k + 1000, "n": F.col("s_name")}).select("payload")).select("symbol", "name", "stock_id")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderkey AS VARCHAR) AS filing_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS filed_date, 'Announcements [' || o_orderpriority || ']' AS filing_type, CASE WHEN o_orderkey % 2 = 0 THEN 'https://www1.hkexnews.hk/l/' || o_orderkey ELSE 'http://x' END AS url FROM orders""")
def hk_filings(spark, d):
    k = F.col("o_orderkey")
    item = {"NEWS_ID": k.cast("string"), "DATE_TIME": F.when(k % 5 == 0, "99/99/2020 10:00").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy HH:mm")), "LONG_TEXT": F.concat(F.lit("Announcements<br/> [<b>"), "o_orderpriority", F.lit("</b>]")), "TITLE": F.lit("t"), "FILE_LINK": F.when(k % 2 == 0, F.concat(F.lit("/l/"), k.cast("string"))).otherwise("http://x")}
    rows = listed(base(spark, d, "orders"), [symbol("o_custkey")], "o_orderkey", item, F.to_json(F.struct(F.col("payload").alias("result"))))
    return asia.hk_filings(rows).select("symbol", "filing_id", "filed_date", F.replace(F.replace("filing_type", F.lit("[ "), F.lit("[")), F.lit(" ]"), F.lit("]")).alias("filing_type"), "url")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS symbol, CAST(o_orderkey AS VARCHAR) AS filing_id, strftime(o_orderdate, '%Y-%m-%d') AS filed_date FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY strftime(o_orderdate, '%Y-%m-%d') DESC, CAST(o_orderkey AS VARCHAR)) AS n FROM orders WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 > 0) WHERE n = 1""")
def latest_annual_reports(spark, d):
    k = F.col("o_orderkey")
    rows = base(spark, d, "orders").select(symbol("o_custkey"), k.cast("string").alias("filing_id"), day("o_orderdate").alias("filed_date"), F.when(k % 3 == 0, "2023 Annual Report").otherwise("Notice").alias("title"), F.when(k % 2 == 0, "").otherwise("http://x").alias("url"))
    return asia.latest_annual_report(rows).select("symbol", "filing_id", "filed_date")


@query("""SELECT CAST(l_suppkey AS VARCHAR) AS symbol, y.y AS fiscal_year, s.t AS statement_type, 'Item no' || l_orderkey || 'line' || l_linenumber || 'x' AS account, (CASE WHEN y.y = 2023 THEN floor(l_extendedprice) ELSE -l_quantity END) * CASE l_suppkey % 2 WHEN 0 THEN 1e6 ELSE 1e3 END AS value, CASE l_suppkey % 2 WHEN 0 THEN 'HKD' ELSE 'RMB' END AS currency
FROM lineitem, (SELECT unnest([2023, 2022])::INT AS y) y, (SELECT unnest(['IS', 'BS']) AS t) s WHERE l_orderkey % 2 = (s.t = 'IS')::INT""")
def annual_report_facts(spark, d):
    li = base(spark, d, "lineitem").withColumn("bs", F.col("l_orderkey") % 2 == 0)
    line = F.concat(F.lit("Item no"), F.col("l_orderkey").cast("string"), F.lit("line"), F.col("l_linenumber").cast("string"), F.lit("x 12(a)  "), F.format_number(F.floor("l_extendedprice"), 0), F.lit(" ("), F.col("l_quantity").cast("bigint").cast("string"), F.lit(")"))
    pages = li.groupBy(symbol("l_suppkey"), "bs", (F.col("l_orderkey") % 3).cast("int").alias("part")).agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("rows"))
    unit = F.when(F.col("symbol").cast("bigint") % 2 == 0, "HK$ million").otherwise("RMB’000")
    w = F.row_number
    from pyspark.sql import Window

    n = w().over(Window.partitionBy("symbol", "bs").orderBy("part"))
    head = F.concat(F.lit(" \n"), F.when(F.col("bs"), "Balance  Sheet").otherwise("CONSOLIDATED INCOME STATEMENT"), F.lit("\n2023 and 2022 in "), unit, F.lit("\n"))
    text = F.concat(head, "rows", F.lit("\nAnnual Report 2025 129"))
    body = pages.select("symbol", (F.when(F.col("bs"), 100).otherwise(0) + n).alias("page_no"), text.alias("text"))
    stray = body.groupBy("symbol").agg(F.lit(300).alias("page_no"), F.lit("Balance sheet\nlater 1 2").alias("text"))
    return asia.annual_report_facts(body.unionByName(stray)).select("symbol", "fiscal_year", "statement_type", "account", "value", "currency")


# -- statutes ------------------------------------------------------------------------------------------


def _page(key: str) -> Column:
    """The page of a search's answer: a service answers in pages, never with all it has at once."""
    return F.floor(F.col(key) / 100).alias("page_of")


def _wrapped(c: Column) -> Column:
    return F.concat(F.lit('{"LawSearch":'), c, F.lit("}"))


@query("""SELECT c_mktsegment AS query, CAST(c_custkey AS VARCHAR) AS law_id, 'M' || c_custkey AS law_serial_no, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'https://www.law.go.kr/x/' || c_custkey ELSE 'http://y' END AS detail_url FROM customer WHERE c_custkey % 5 > 0""")
def statute_search(spark, d):
    k = F.col("c_custkey")
    item = {"법령ID": F.when(k % 5 > 0, k.cast("string")), "법령일련번호": F.concat(F.lit("M"), k.cast("string")), "법령명한글": F.col("c_name"), "법령상세링크": F.when(k % 2 == 0, F.concat(F.lit("/x/"), k.cast("string"))).otherwise("http://y")}
    rows = listed(base(spark, d, "customer"), [F.col("c_mktsegment").alias("query"), _page("c_custkey")], "c_custkey", item, _wrapped(F.concat(F.lit('{"totalCnt":"9","law":'), "payload", F.lit("}"))))
    return statutes.statutes(rows, ["query"]).select("query", "law_id", "law_serial_no", "name", "detail_url")


@query("""SELECT o_custkey AS law, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INT) AS ord, CAST(o_orderkey AS VARCHAR) AS article_no, o_orderpriority AS article_title, 'head' || chr(10) || 'hang ' || o_custkey || chr(10) || 'ho' || chr(10) || 'mok' AS content FROM orders WHERE o_orderkey % 3 > 0""")
def statute_articles(spark, d):
    k = F.col("o_orderkey")
    clause = F.array(F.struct(F.concat(F.lit(" hang "), F.col("o_custkey").cast("string")).alias("항내용"), F.struct(F.lit("ho").alias("호내용"), F.array(F.struct(F.lit("mok ").alias("목내용"))).alias("목")).alias("호")))
    item = {"조문여부": F.when(k % 3 > 0, "조문").otherwise("전문"), "조문번호": k.cast("string"), "조문제목": F.col("o_orderpriority"), "조문내용": F.lit("head "), "항": clause}
    rows = listed(base(spark, d, "orders"), [F.col("o_custkey").alias("law")], "o_orderkey", item, F.concat(F.lit('{"법령":{"기본정보":{},"조문":{"조문단위":'), "payload", F.lit("}}}")))
    return statutes.articles(rows, ["law"])


@query("""SELECT c_mktsegment AS query, CAST(c_custkey AS VARCHAR) AS law_id, 'M' || c_custkey AS law_serial_no, CASE WHEN c_custkey % 2 = 0 THEN '현행' END AS status FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_custkey = (SELECT min(c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING')""")
def statute_history(spark, d):
    c, k = base(spark, d, "customer"), F.col("c_custkey")
    item = {"법령ID": k.cast("string"), "법령일련번호": F.concat(F.lit("M"), k.cast("string")), "현행연혁코드": F.when(k % 2 == 0, "현행")}
    rows = listed(c, [F.col("c_mktsegment").alias("query"), _page("c_custkey")], "c_custkey", item, _wrapped(F.concat(F.lit('{"law":'), "payload", F.lit("}"))))
    asked = c.where("c_mktsegment = 'BUILDING'").agg(F.min("c_custkey").cast("string").alias("law_id"))
    rows = rows.join(F.broadcast(asked.withColumn("query", F.lit("BUILDING"))), "query", "left")
    return statutes.history(rows).select("query", "law_id", "law_serial_no", "status")


@query("""SELECT c_mktsegment AS query, CASE WHEN c_mktsegment = 'BUILDING' THEN arg_min(c_name, (c_custkey % 7 <> 3, c_custkey)) WHEN c_mktsegment = 'MACHINERY' THEN 'MACHINERY' ELSE arg_min(c_name, c_custkey) END AS name FROM customer GROUP BY c_mktsegment""")
def statute_exact_names(spark, d):
    c = base(spark, d, "customer")
    found = c.where("c_mktsegment <> 'MACHINERY'").select(F.col("c_mktsegment").alias("query"), F.col("c_custkey").alias("ord"), F.when(F.col("c_custkey") % 7 == 3, "wanted").otherwise("other").alias("law_id"), F.col("c_name").alias("name"))
    queries = c.select(F.col("c_mktsegment").alias("query"), F.when(F.col("c_mktsegment") == "BUILDING", "wanted").alias("law_id")).distinct()
    return statutes.exact_names(queries, found).select("query", "name")


@query("""SELECT o_custkey AS law, 'Act ' || o_custkey AS name_en, string_agg(o_orderpriority, chr(10) ORDER BY o_orderkey) FILTER (o_orderkey % 2 = 0) AS content_en FROM orders GROUP BY o_custkey""")
def statute_translations(spark, d):
    rows = listed(base(spark, d, "orders"), [F.col("o_custkey").alias("law")], "o_orderkey", {"joCts": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))})
    text = F.concat(F.lit('{"Law":{"InfSection":{"lsNmEng":"Act '), F.col("law").cast("string"), F.lit('"},"JoSection":{"Jo":'), "payload", F.lit("}}}"))
    return statutes.translations(rows.withColumn("payload", text), ["law"]).select("law", "name_en", "content_en")


@query("""SELECT o_custkey AS law, CAST(o_orderkey AS VARCHAR) AS article_no, CASE WHEN o_orderkey % 3 > 0 THEN 'old ' || o_orderkey END AS old_text, CASE WHEN o_orderkey % 3 <> 1 THEN 'new ' || o_orderkey END AS new_text FROM orders""")
def statute_comparison(spark, d):
    o, k = base(spark, d, "orders"), F.col("o_orderkey").cast("string")
    side = lambda keep, word: listed(o.where(keep), [F.col("o_custkey").alias("law")], "o_orderkey", {"no": k, "content": F.concat(F.lit(word + " "), k)}).withColumnRenamed("payload", word)
    both = side("o_orderkey % 3 > 0", "old").join(side("o_orderkey % 3 <> 1", "new"), "law", "full_outer")
    text = F.concat(F.lit('{"R":{"신조문_기본정보":{},"신조문목록":{"조문":'), F.coalesce("new", F.lit("[]")), F.lit('},"구조문목록":{"조문":'), F.coalesce("old", F.lit("[]")), F.lit("}}}"))
    return statutes.comparison(both.select("law", text.alias("payload")), ["law"])


@query("""SELECT c_nationkey AS page, CASE c_custkey % 3 WHEN 0 THEN 'S' || c_custkey WHEN 1 THEN 'I' || c_custkey ELSE 'N' || c_custkey END AS item_key, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE 'a much longer title' END AS title FROM customer""")
def legal_raw_items(spark, d):
    k = F.col("c_custkey")
    text = k.cast("string")
    item = {"사건번호": F.when(k % 3 == 2, F.concat(F.lit("N"), text)), "문서ID": F.when(k % 3 == 1, F.concat(F.lit("I"), text)), "판례일련번호": F.when(k % 3 == 0, F.concat(F.lit("S"), text)), "사건명": F.when(k % 2 == 0, F.col("c_name")), "부서명": F.lit("dept"), "별칭제목": F.lit("a much longer title"), "x": F.lit(1)}
    rows = listed(base(spark, d, "customer"), [F.col("c_nationkey").alias("page"), _page("c_custkey")], "c_custkey", item, _wrapped(F.concat(F.lit('{"page":"1","prec":'), "payload", F.lit("}"))))
    return statutes.raw_items(rows, ["page"]).select("page", "item_key", "title")
