"""Named queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import geometry, signals
from ..operators.upsert import upsert
from . import views
from .standins import base, standin, with_standins

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = with_standins(sql)
        return f

    return register


# -- views ------------------------------------------------------------------------


@query("""
SELECT s.company_id, s.security_id, s.market, s.symbol, s.security_type, p.currency, p.trade_date, p.source, p.ord, p.close AS close_local,
  CASE WHEN p.currency = 'USD' THEN p.close ELSE p.close * fx.rate END AS close_usd
FROM securities s JOIN prices p USING (security_id)
JOIN (SELECT security_id, max(trade_date) AS trade_date FROM prices GROUP BY 1) m ON m.security_id = p.security_id AND m.trade_date = p.trade_date
ASOF LEFT JOIN fx_rates fx ON fx.base_ccy = p.currency AND fx.rate_date <= p.trade_date
""")
def latest_price_usd(spark, d):
    out = views.latest_price(standin(spark, d, "securities"), standin(spark, d, "prices"), standin(spark, d, "fx_rates"))
    return out.select("company_id", "security_id", "market", "symbol", "security_type", "currency", "trade_date", "source", "ord", "close_local", "close_usd")


@query("""SELECT security_id, trade_date, count(*) AS n FROM prices p WHERE trade_date = (SELECT max(trade_date) FROM prices q WHERE q.security_id = p.security_id) GROUP BY 1, 2 HAVING count(*) > 1""")
def latest_price_ties(spark, d):
    return views.latest_rows(standin(spark, d, "prices"), "security_id", "trade_date").groupBy("security_id", "trade_date").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query("""
SELECT c.company_id, c.name, c.country, c.sector, c.lei,
  string_agg(s.market || ':' || s.symbol || '(' || coalesce(s.security_type, '?') || ')', ',' ORDER BY s.market, s.symbol) AS listings
FROM companies c LEFT JOIN securities s ON s.company_id = c.company_id GROUP BY ALL
""")
def company_overview(spark, d):
    return views.company_overview(standin(spark, d, "companies"), standin(spark, d, "securities"))


_FX_ALL = "SELECT rate_date, base_ccy, quote_ccy, rate_type, rate, source FROM fx_rates UNION ALL SELECT rate_date, base_ccy, quote_ccy, 'avg', round(rate * 0.9, 6), source FROM fx_rates"


@query(f"""
WITH fx AS ({_FX_ALL}), k AS (SELECT *, CASE WHEN statement_type IN ('IS', 'CF') THEN 'avg' ELSE 'spot' END AS t, coalesce(period_end, printf('%04d-12-31', fiscal_year)) AS at FROM financials)
SELECT k.company_id, k.fiscal_year, k.fiscal_period, k.fs_scope, k.statement_type, k.account, k.value AS value_local, k.currency, k.period_end,
  CASE WHEN k.currency = 'USD' THEN k.value ELSE k.value * fx.rate END AS value_usd
FROM k ASOF LEFT JOIN fx ON fx.base_ccy = k.currency AND fx.rate_type = k.t AND fx.rate_date <= k.at
""")
def financials_usd(spark, d):
    fx = standin(spark, d, "fx_rates")
    both = fx.unionByName(fx.withColumns({"rate_type": F.lit("avg"), "rate": F.round(F.col("rate") * 0.9, 6)}))
    return views.financials_usd(standin(spark, d, "financials"), both).select("company_id", "fiscal_year", "fiscal_period", "fs_scope", "statement_type", "account", F.col("value").alias("value_local"), "currency", "period_end", "value_usd")


@query("""
WITH p AS (SELECT DISTINCT currency AS base_ccy, fiscal_period, coalesce(period_end, printf('%04d-12-31', fiscal_year)) AS period_end FROM financials WHERE currency IS NOT NULL AND currency <> 'USD'),
w AS (SELECT base_ccy, period_end, min(CAST(CAST(period_end AS DATE) - CAST(CASE fiscal_period WHEN 'FY' THEN 365 WHEN 'H1' THEN 183 ELSE 92 END AS INT) AS VARCHAR)) AS start FROM p GROUP BY 1, 2)
SELECT w.period_end AS rate_date, w.base_ccy, 'USD' AS quote_ccy, 'avg' AS rate_type, round(avg(fx.rate) + 1e-9, 4) AS rate
FROM w JOIN fx_rates fx ON fx.base_ccy = w.base_ccy AND fx.rate_date BETWEEN w.start AND w.period_end GROUP BY 1, 2
""")
def fx_period_average(spark, d):
    return views.period_average_fx(standin(spark, d, "financials"), standin(spark, d, "fx_rates")).withColumn("rate", F.round(F.col("rate") + 1e-9, 4))


@query("SELECT DISTINCT currency FROM (SELECT currency FROM prices UNION SELECT currency FROM financials UNION SELECT currency FROM securities) WHERE currency IS NOT NULL AND currency <> 'USD'")
def needed_currencies(spark, d):
    one = lambda n: standin(spark, d, n).select("currency")
    return one("prices").union(one("financials")).union(one("securities")).where("currency IS NOT NULL AND currency <> 'USD'").distinct()


@query("""SELECT company_id, round(value, 2) AS value FROM (SELECT company_id, value, row_number() OVER (PARTITION BY company_id ORDER BY fiscal_year DESC, CASE account WHEN 'O' THEN 1 ELSE 2 END, statement_type DESC, value DESC) AS r
FROM financials WHERE fiscal_period = 'FY' AND fs_scope = 'CFS' AND value IS NOT NULL AND account IN ('O', 'F')) WHERE r = 1""")
def latest_metric_cfs_fy(spark, d):
    return views.latest_metric(standin(spark, d, "financials"), ["O", "F"], "value").withColumn("value", F.round("value", 2))


@query("""
WITH m AS (SELECT company_id, arg_max(value, fiscal_year * 10.0 + CASE statement_type WHEN 'IS' THEN 2 WHEN 'CF' THEN 1 ELSE 0 END) AS metric FROM financials WHERE fiscal_period = 'FY' AND fs_scope = 'CFS' AND account = 'O' GROUP BY 1),
l AS (SELECT security_id, max(close) AS close FROM prices p WHERE trade_date = (SELECT max(trade_date) FROM prices q WHERE q.security_id = p.security_id) GROUP BY 1)
SELECT s.symbol, s.market, l.close, m.metric, CASE WHEN m.metric IS NULL THEN '-' WHEN abs(m.metric) >= 1e9 THEN format('{:,.2f}B', m.metric / 1e9) WHEN abs(m.metric) >= 1e6 THEN format('{:,.2f}M', m.metric / 1e6) ELSE format('{:,.2f}', m.metric) END AS shown
FROM securities s LEFT JOIN l USING (security_id) LEFT JOIN m ON m.company_id = s.company_id WHERE s.symbol IN ('1', '2', '7', '14', '100')
""")
def compare_symbols(spark, d):
    sec = standin(spark, d, "securities").where(F.col("symbol").isin("1", "2", "7", "14", "100"))
    close = views.latest_rows(standin(spark, d, "prices"), "security_id", "trade_date").groupBy("security_id").agg(F.max("close").alias("close"))
    metric = views.latest_metric(standin(spark, d, "financials"), ["O"], "metric")
    return sec.join(close, "security_id", "left").join(metric, "company_id", "left").select("symbol", "market", "close", "metric", S.compact_number(F.col("metric")).alias("shown"))


@query("""SELECT company_id, security_id, symbol FROM (SELECT *, row_number() OVER (PARTITION BY company_id ORDER BY is_primary DESC, security_id) AS r FROM securities) WHERE r = 1""")
def primary_listing(spark, d):
    return standin(spark, d, "securities").groupBy("company_id").agg(F.max_by(F.struct("security_id", "symbol"), F.struct("is_primary", -F.col("security_id"))).alias("s")).select("company_id", "s.*")


# -- upserts -------------------------------------------------------------------------

_KEY = ["security_id", "trade_date", "source"]


def _halves(spark, d):
    p = standin(spark, d, "prices").withColumn("_ord", F.col("ord"))
    once = p.groupBy(*_KEY).agg(F.max_by(F.struct([c for c in p.columns if c not in _KEY]), "ord").alias("r")).select(*_KEY, "r.*")
    new = p.where("ord % 5 > 1").withColumns({"close": F.col("close") + 1, "currency": F.when(F.col("ord") % 3 > 0, F.col("currency"))})
    return once.where("ord % 5 < 3").drop("_ord"), new


_BOTH = "WITH o AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY security_id, trade_date, source ORDER BY ord DESC) AS n FROM prices) WHERE n = 1 AND ord % 5 < 3), r AS (SELECT 0 AS side, * EXCLUDE (n) FROM o UNION ALL SELECT 1, * REPLACE (close + 1 AS close, CASE WHEN ord % 3 > 0 THEN currency END AS currency) FROM prices WHERE ord % 5 > 1), k AS (SELECT *, row_number() OVER (PARTITION BY security_id, trade_date, source ORDER BY side {0}, ord {0}) AS n FROM r)"
_UPSERTED = "SELECT security_id, trade_date, source, close, currency, ord FROM k WHERE n = 1"


_FILLED = "SELECT security_id, trade_date, source, arg_max(close, (side, ord)) AS close, arg_max(currency, (side, ord)) FILTER (currency IS NOT NULL) AS currency, arg_max(ord, (side, ord)) AS ord FROM k GROUP BY 1, 2, 3"


@query(f"{_BOTH.format('DESC')} {_FILLED}")
def upsert_prices_update(spark, d):
    return upsert(*_halves(spark, d), _KEY, "update", {"currency": "coalesce_new_old"})


@query(f"{_BOTH.format('DESC')} {_UPSERTED}")
def upsert_prices_replace(spark, d):
    return upsert(*_halves(spark, d), _KEY, "replace")


@query(f"{_BOTH.format('ASC')} {_UPSERTED}")
def upsert_prices_ignore(spark, d):
    return upsert(*_halves(spark, d), _KEY, "ignore")


@query("""
WITH r AS (SELECT o_custkey AS k, o_orderkey AS ord, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS a, CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderstatus END AS b, o_orderpriority AS c FROM orders)
SELECT k, arg_max(a, ord) FILTER (a IS NOT NULL) AS a, arg_min(b, ord) FILTER (b IS NOT NULL) AS b, arg_max(c, ord) AS c FROM r GROUP BY k
""")
def upsert_coalesce_rules(spark, d):
    rows = base(spark, d, "orders").select(F.col("o_custkey").alias("k"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("a"), F.when(F.col("o_orderkey") % 2 != 0, F.col("o_orderstatus")).alias("b"), F.col("o_orderpriority").alias("c"), F.col("o_orderkey").alias("_ord"))
    return upsert(rows.limit(0), rows, ["k"], "update", {"a": "coalesce_new_old", "b": "coalesce_old_new"})


@query("""SELECT o_custkey AS company, o_orderstatus AS holder, arg_max(o_totalprice, o_orderkey) AS v FROM orders WHERE o_orderkey % 3 > 0 GROUP BY 1, 2 UNION ALL SELECT o_custkey, NULL, o_totalprice FROM orders WHERE o_orderkey % 3 = 0""")
def upsert_null_key(spark, d):
    rows = base(spark, d, "orders").select(F.col("o_custkey").alias("company"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).alias("holder"), F.col("o_totalprice").alias("v"), F.col("o_orderkey").alias("_ord"))
    first = upsert(rows.limit(0).drop("_ord"), rows.where("_ord % 2 = 0"), ["company", "holder"], "replace")
    return upsert(first, rows.where("_ord % 2 = 1"), ["company", "holder"], "replace").where("holder is null").unionByName(upsert(rows.limit(0).drop("_ord"), rows, ["company", "holder"], "replace").where("holder is not null"))


@query("""WITH r AS (SELECT s.company_id, CAST(CAST(e.ts AS DATE) AS VARCHAR) AS day, e.event_type, e.value, row_number() OVER (PARTITION BY s.company_id, CAST(e.ts AS DATE), e.event_type ORDER BY e.event_id DESC) AS n
FROM events e JOIN securities s ON s.symbol = CAST(e.user_id AS VARCHAR)) SELECT company_id, day, event_type, value FROM r WHERE n = 1""")
def coverage_grain_company(spark, d):
    known = standin(spark, d, "securities").select("symbol", "company_id")
    rows = base(spark, d, "events").withColumns({"symbol": F.col("user_id").cast("string"), "day": F.date_format("ts", "yyyy-MM-dd"), "_ord": F.col("event_id")}).join(known, "symbol")
    rows = rows.select("company_id", "day", "event_type", "value", "_ord")
    return upsert(rows.limit(0), rows, ["company_id", "day", "event_type"], "replace")


@query("""SELECT DISTINCT least(a.c_custkey, b.c_custkey) AS company_id, greatest(a.c_custkey, b.c_custkey) AS peer_company_id FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1 AND a.c_nationkey = b.c_nationkey WHERE a.c_custkey <> b.c_custkey""")
def peers_first_wins(spark, d):
    c = base(spark, d, "customer")
    pairs = c.alias("a").join(c.alias("b"), (F.col("b.c_custkey") == F.col("a.c_custkey") + 1) & (F.col("a.c_nationkey") == F.col("b.c_nationkey"))).select(F.least("a.c_custkey", "b.c_custkey").alias("company_id"), F.greatest("a.c_custkey", "b.c_custkey").alias("peer_company_id"))
    return upsert(pairs.limit(0), pairs.where("company_id <> peer_company_id").withColumn("_ord", F.col("company_id")), ["company_id", "peer_company_id"], "ignore")


# -- documents ---------------------------------------------------------------------------


@query("""SELECT f.company_id, f.filing_id, f.source FROM filings f WHERE (SELECT count(*) FROM filing_documents x WHERE x.company_id = f.company_id AND x.filing_id = f.filing_id AND x.source = f.source) < greatest(1, f.n_urls)
AND EXISTS (SELECT 1 FROM securities s WHERE s.company_id = f.company_id)""")
def pending_documents(spark, d):
    return views.pending_filings(standin(spark, d, "filings"), standin(spark, d, "filing_documents"), standin(spark, d, "securities")).select("company_id", "filing_id", "source")


@query("""SELECT f.filing_id, CAST(u.seq AS INT) AS doc_seq FROM filings f, (SELECT unnest(range(4)) AS seq) u WHERE u.seq < f.n_urls AND NOT EXISTS (SELECT 1 FROM filing_documents x WHERE x.filing_id = f.filing_id AND x.doc_seq = u.seq)""")
def incremental_missing_seqs(spark, d):
    wanted = standin(spark, d, "filings").where("n_urls > 0").select("filing_id", F.explode(F.sequence(F.lit(0), F.col("n_urls") - 1)).alias("doc_seq"))
    return wanted.join(standin(spark, d, "filing_documents").select("filing_id", "doc_seq"), ["filing_id", "doc_seq"], "left_anti")


@query("SELECT company_id, filing_id, source FROM filings f WHERE NOT EXISTS (SELECT 1 FROM filing_documents x WHERE x.company_id = f.company_id AND x.filing_id = f.filing_id AND x.source = f.source)")
def filings_without_documents(spark, d):
    keys = ["company_id", "filing_id", "source"]
    return standin(spark, d, "filings").join(standin(spark, d, "filing_documents"), keys, "left_anti").select(keys)


@query("SELECT count(*) AS n_documents, count(*) FILTER (text_chars = 0) AS n_empty FROM filing_documents")
def empty_doc_count(spark, d):
    return standin(spark, d, "filing_documents").agg(F.count(F.lit(1)).alias("n_documents"), F.count_if(F.col("text_chars") == 0).alias("n_empty"))


@query("SELECT DISTINCT c.company_id, c.name FROM companies c JOIN securities s USING (company_id) WHERE c.lei IS NULL")
def missing_lei_candidates(spark, d):
    return standin(spark, d, "companies").where("lei IS NULL").join(standin(spark, d, "securities"), "company_id", "left_semi").select("company_id", "name")


@query("""SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY (props IS NOT NULL)::INT DESC, ts DESC, value DESC, event_id) AS r FROM events) WHERE r = 1""")
def xbrl_best_record(spark, d):
    order = F.struct(F.col("props").isNotNull().cast("int"), "ts", "value", -F.col("event_id"))
    return base(spark, d, "events").groupBy("user_id", "event_type").agg(F.max_by(F.struct("event_id", "value"), order).alias("r")).select("user_id", "event_type", "r.*")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r <= 15")
def recent_filings_topn(spark, d):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey"))
    return base(spark, d, "orders").withColumn("r", F.row_number().over(w)).where("r <= 15").select("o_custkey", "o_orderkey")


@query("SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 20")
def status_limit(spark, d):
    return base(spark, d, "events").select("event_id", "event_type").orderBy(F.desc("event_id")).limit(20)


@query("SELECT filing_id, filed_date FROM filings WHERE filed_date IS NULL OR filed_date BETWEEN '2023-03-01' AND '2023-06-30'")
def undated_range_filter(spark, d):
    return standin(spark, d, "filings").where(F.col("filed_date").isNull() | F.col("filed_date").between("2023-03-01", "2023-06-30")).select("filing_id", "filed_date")


@query("SELECT a.company_id, b.company_id AS other_id FROM companies a JOIN companies b ON lower(a.name) = lower(b.name) AND a.country IS NOT DISTINCT FROM b.country")
def null_safe_country(spark, d):
    c = standin(spark, d, "companies")
    return c.alias("a").join(c.alias("b"), (F.lower("a.name") == F.lower("b.name")) & F.col("a.country").eqNullSafe(F.col("b.country"))).select(F.col("a.company_id"), F.col("b.company_id").alias("other_id"))


@query("SELECT sha256(lower(text)) AS name, min(doc_id) AS doc_id FROM documents GROUP BY 1")
def first_occurrence_dedup(spark, d):
    rows = base(spark, d, "documents").select(F.sha2(F.lower("text").cast("binary"), 256).alias("name"), "doc_id")
    return signals.first_occurrences(rows, ["name"], ["doc_id"])


# -- scalars --------------------------------------------------------------------------------


@query("""SELECT security_id, CASE market WHEN 'KR' THEN CASE WHEN length(symbol) >= 6 THEN symbol ELSE lpad(symbol, 6, '0') END WHEN 'HK' THEN CASE WHEN length(symbol) >= 5 THEN symbol ELSE lpad(symbol, 5, '0') END ELSE symbol END AS code,
CASE market WHEN 'KR' THEN lpad(symbol, greatest(6, length(symbol))::INT, '0') || '.KS' WHEN 'HK' THEN lpad(ltrim(symbol, '0'), greatest(4, length(ltrim(symbol, '0')))::INT, '0') || '.HK' ELSE symbol END AS fmp FROM securities""")
def symbol_normalize(spark, d):
    s = standin(spark, d, "securities")
    return s.select("security_id", S.normalize_symbol(F.col("market"), F.col("symbol")).alias("code"), S.fmp_symbol(F.col("market"), F.col("symbol")).alias("fmp"))


@query("SELECT security_id, CASE market WHEN 'KR' THEN lpad(symbol, greatest(6, length(symbol))::INT, '0') || '.KS' WHEN 'HK' THEN lpad(ltrim(symbol, '0'), greatest(4, length(ltrim(symbol, '0')))::INT, '0') || '.HK' ELSE symbol END AS first_ticker, CAST(CASE WHEN market = 'KR' THEN 2 ELSE 1 END AS INT) AS n FROM securities")
def provider_symbol(spark, d):
    tickers = S.yahoo_symbols(F.col("market"), F.col("symbol"))
    return standin(spark, d, "securities").select("security_id", F.element_at(tickers, 1).alias("first_ticker"), F.size(tickers).alias("n"))


@query("SELECT s_suppkey, lpad(CAST(s_suppkey AS VARCHAR), 10, '0') AS cik, regexp_replace(upper(s_name), '[^A-Z0-9]+', '', 'g') AS issuer, substr(sha1(s_name), 1, 16) AS key FROM supplier")
def cik_pad(spark, d):
    return base(spark, d, "supplier").select("s_suppkey", S.pad_cik(F.col("s_suppkey").cast("string")).alias("cik"), S.normalize_issuer(F.col("s_name")).alias("issuer"), S.content_key(F.col("s_name")).alias("key"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS iso_of_compact, strftime(o_orderdate, '%Y-%m-%d') AS iso_of_stamp, strftime(o_orderdate, '%Y%m%d') AS compact, 'Q' || quarter(o_orderdate) AS quarter,
strftime(CAST(o_orderdate AS DATE) - 92, '%Y-%m-%d') AS window_start, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS from_epoch FROM orders""")
def iso_dates(spark, d):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd")
    return base(spark, d, "orders").select("o_orderkey", S.to_iso(F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyyMMdd"))).alias("iso_of_compact"), S.to_iso(F.concat(iso, F.lit("T10:00:00"))).alias("iso_of_stamp"), S.compact(iso).alias("compact"), S.quarter_of(iso).alias("quarter"), S.window_start(F.lit("Q3"), iso).alias("window_start"), S.epoch_date(F.unix_date(F.to_date("o_orderdate")).cast("long") * 86400 + 100).alias("from_epoch"))


@query("""SELECT o_orderkey, o_totalprice AS money, -floor(o_totalprice) AS signed, round(floor(o_totalprice) * 1e6, 0) AS scaled, CASE WHEN o_totalprice >= 1e9 THEN format('{:,.2f}B', o_totalprice / 1e9) WHEN o_totalprice >= 1e6 THEN format('{:,.2f}M', o_totalprice / 1e6) ELSE format('{:,.2f}', o_totalprice) END AS shown, CAST(NULL AS DOUBLE) AS bad FROM orders""")
def money_parse(spark, d):
    p = F.col("o_totalprice")
    whole = F.floor(p).cast("string")
    return base(spark, d, "orders").select("o_orderkey", S.parse_money(F.concat(F.lit("$"), p.cast("string"))).alias("money"), S.parse_signed(F.concat(F.lit("("), F.format_number(F.floor(p), 0), F.lit(")"))).alias("signed"), F.round(S.parse_scaled(whole, F.lit("Million")), 0).alias("scaled"), S.compact_number(p).alias("shown"), S.parse_money(F.lit("n/a")).alias("bad"))


@query("""SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'BS' WHEN regexp_matches(lower(p_type), 'brass') THEN 'IS' ELSE 'IS' END AS kind, CASE WHEN length(p_name) > 12 THEN substr(p_name, 1, 11) || '…' ELSE p_name END AS short, CAST(len(string_split(p_type, ' ')) AS INT) AS n_parts FROM part""")
def text_helpers(spark, d):
    return base(spark, d, "part").select("p_partkey", S.statement_type(F.col("p_type"), F.col("p_size") % 2 != 0).alias("kind"), S.truncate(F.col("p_name"), 12).alias("short"), F.size(S.split_csv(F.replace(F.col("p_type"), F.lit(" "), F.lit(" , ")))).alias("n_parts"))


# -- text --------------------------------------------------------------------------------------


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(?:script|style)\\b[^>]*>.*?</(?:script|style)\\s*>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages""")
def html_to_text(spark, d):
    return base(spark, d, "pages").select("page_id", S.strip_html(F.col("html")).alias("text"))


_LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"


@query(f"""WITH l AS ({_LINES}), k AS (SELECT lower(trim(regexp_replace(regexp_replace(line, '[0-9]+', '#', 'g'), '\\s+', ' ', 'g'))) AS key FROM l) SELECT key, count(*) AS n FROM k WHERE key <> '' GROUP BY 1 HAVING count(*) >= 3""")
def recurring_lines(spark, d):
    lines = base(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.groupBy(S.line_key(F.col("line")).alias("key")).agg(F.count(F.lit(1)).alias("n")).where("n >= 3 AND key <> ''")


@query(r"""SELECT conv_id, turn, regexp_matches('- Page ' || turn || ' of 9 -', k) AS is_number, regexp_matches(text, k) AS text_is_number, regexp_matches(CASE WHEN turn % 2 = 0 THEN CAST(conv_id AS VARCHAR) ELSE role END, k) AS cell_is_number
FROM conversations, (SELECT '(?i)^[\s\-–—]*(?:page|p\.?|페이지|第)?\s*\d+\s*(?:(?:of|/|–|—|-)\s*\d+)?\s*(?:쪽|페이지|页)?[\s\-–—]*$' AS k)""")
def page_number_lines(spark, d):
    cell = F.when(F.col("turn") % 2 == 0, F.col("conv_id").cast("string")).otherwise(F.col("role"))
    return base(spark, d, "conversations").select("conv_id", "turn", S.is_page_number(F.concat(F.lit("- Page "), F.col("turn").cast("string"), F.lit(" of 9 -"))).alias("is_number"), S.is_page_number(F.col("text")).alias("text_is_number"), S.is_page_number(cell).alias("cell_is_number"))


@query("""WITH l AS (SELECT doc_id, generate_subscripts(a, 1) AS pos, trim(unnest(a)) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents)),
p AS (SELECT *, coalesce(sum(CASE WHEN regexp_matches(line, '[.!?…。！？」』）)]$') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS para FROM l WHERE line <> '')
SELECT doc_id, CAST(para AS BIGINT) AS para, string_agg(line, ' ' ORDER BY pos) AS text FROM p GROUP BY 1, 2""")
def reflow_paragraphs(spark, d):
    lines = base(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "raw")).select("doc_id", "pos", F.trim("raw").alias("text")).where("text <> ''")
    return geometry.paragraphs(lines, "doc_id", ["pos"])


# -- evaluation ----------------------------------------------------------------------------------


@query("SELECT source AS category, round(avg(quality), 4) AS quality, round(avg(toxic), 4) AS toxic, count(*) AS n_cases FROM labels JOIN documents USING (doc_id) GROUP BY 1")
def eval_rollup(spark, d):
    return base(spark, d, "labels").join(base(spark, d, "documents").select("doc_id", "source"), "doc_id").groupBy(F.col("source").alias("category")).agg(F.round(F.avg("quality"), 4).alias("quality"), F.round(F.avg("toxic"), 4).alias("toxic"), F.count(F.lit(1)).alias("n_cases"))


@query("SELECT count(*) FILTER (quality = 0) AS escalated, round(0.02 * count(*) FILTER (quality = 0), 2) AS est_cost FROM labels")
def run_totals(spark, d):
    return base(spark, d, "labels").agg(F.count_if(F.col("quality") == 0).alias("escalated"), F.round(0.02 * F.count_if(F.col("quality") == 0), 2).alias("est_cost"))
