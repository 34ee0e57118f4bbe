"""Rows from vendors' payloads: profiles, prices, statements, ratios, filings, peers, estimates, news and the like.

Landed tables carry ``market`` and ``symbol`` beside the ``payload``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import pad_cik, quarter_of, to_iso
from .landing import in_range, items, market_currency, number, numeric_fields, records, whole

KEY = ["market", "symbol"]
#: Fields of a statement record that describe it.
STATEMENT_META = ("date", "symbol", "reportedCurrency", "cik", "fillingDate", "filingDate", "acceptedDate", "calendarYear", "fiscalYear", "period", "link", "finalLink")
RATIO_META = ("symbol", "date", "calendarYear", "fiscalYear", "period", "reportedCurrency")
REPORT_META = ("fiscalDateEnding", "reportedCurrency")
ACCESSION = r"\d{10}-\d{2}-\d{6}"


def _first(*names: str) -> Column:
    """The first of the text fields that is neither null nor empty."""
    return F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names))


def _year() -> Column:
    return F.substring("date", 1, 4).try_cast("int")


def _fiscal_year() -> Column:
    return whole(_first("fiscalYear", "calendarYear")).cast("int")


def profiles(df: DataFrame) -> DataFrame:
    """One master row for each profile: the first element of its list."""
    fields = ["companyName", "country", "sector", "industry", "isin", "cik", "currency", "exchange", "exchangeShortName", "website"]
    rows = records(df, KEY, fields).where("ord = 0")
    return rows.select(*KEY, F.col("companyName").alias("name"), "country", "sector", "industry", "isin", pad_cik(F.nullif(F.col("cik"), F.lit(""))).alias("cik"), "currency", _first("exchange", "exchangeShortName").alias("exchange"), "website", F.lit("COMMON").alias("security_type"), F.lit(True).alias("is_primary"))


def daily_prices(df: DataFrame) -> DataFrame:
    """Prices of a list of days, or of one wrapped as ``historical``."""
    rows = records(df, KEY, ["date", "open", "high", "low", "close", "volume", "adjClose"], "$", "$.historical")
    return rows.select(*KEY, F.col("date").alias("trade_date"), *(number(c).alias(c) for c in ("open", "high", "low", "close")), whole("volume").alias("volume"), number("adjClose").alias("adj_close"), market_currency(F.col("market")).alias("currency"))


def statements(df: DataFrame) -> DataFrame:
    """Numeric fields of statement records; the landed table also has ``statement_type``. Records without a year go."""
    keep = [*KEY, "statement_type"]
    rows = records(df, keep, ["fiscalYear", "calendarYear", "period", "reportedCurrency", "date"])
    period = F.upper(F.coalesce(F.nullif(F.col("period"), F.lit("")), F.lit("FY")))
    rows = rows.select(*keep, "item", _fiscal_year().alias("fiscal_year"), F.when(period == "ANNUAL", "FY").otherwise(period).alias("fiscal_period"), F.col("reportedCurrency").alias("currency"), to_iso(F.col("date")).alias("period_end"))
    return numeric_fields(rows.where("fiscal_year is not null"), [c for c in rows.columns if c != "item"], STATEMENT_META)


def ratios(df: DataFrame) -> DataFrame:
    """Annual ratios and key metrics; the year may come from the date."""
    rows = records(df, KEY, ["fiscalYear", "calendarYear", "date"])
    rows = rows.select(*KEY, "item", F.coalesce(F.nullif(_fiscal_year(), F.lit(0)), _year()).alias("fiscal_year"), F.lit("FY").alias("fiscal_period"))
    return numeric_fields(rows.where("fiscal_year is not null"), [*KEY, "fiscal_year", "fiscal_period"], RATIO_META).withColumnRenamed("account", "metric")


def filings(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Filings by link; their id is the accession number in it, else the day, else the link. Undated rows stay."""
    rows = records(df, KEY, ["filingDate", "acceptedDate", "finalLink", "link", "formType"])
    rows = rows.select(*KEY, to_iso(_first("filingDate", "acceptedDate")).alias("filed_date"), _first("finalLink", "link").alias("url"), F.col("formType").alias("filing_type")).where(in_range(F.col("filed_date"), start, end))
    number_ = F.nullif(F.regexp_extract("url", ACCESSION, 0), F.lit(""))
    return rows.select(*KEY, F.coalesce(number_, "filed_date", "url").alias("filing_id"), "filed_date", "filing_type", F.col("filing_type").alias("title"), "url", F.when(F.col("url").isNull(), F.array().cast("array<string>")).otherwise(F.array("url")).alias("doc_urls"))


def peers(df: DataFrame) -> DataFrame:
    """Peers in order, from a list of peers or a list that holds ``peersList``."""
    listed = F.from_json(F.get_json_object("payload", "$[0].peersList"), "array<string>")
    single = F.filter(F.transform(items(F.col("payload"), "$"), lambda x: F.get_json_object(x, "$.symbol")), lambda x: x.isNotNull() & (x != ""))
    return df.select(*KEY, F.posexplode(F.coalesce(listed, single)).alias("ord", "peer")).select(*KEY, "ord", "peer")


def market_caps(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    rows = records(df, KEY, ["date", "marketCap"]).withColumn("metric_date", to_iso(F.col("date"))).where(in_range(F.col("metric_date"), start, end))
    return rows.select(*KEY, "metric_date", number("marketCap").alias("market_cap"), market_currency(F.col("market")).alias("currency"))


def actions(dividends: DataFrame, splits: DataFrame) -> DataFrame:
    """Dividends and splits; a split without both parts, or with a zero, has no ratio."""
    div = records(dividends, KEY, ["date", "dividend", "adjDividend"], "$", "$.historical")
    paid = F.coalesce(F.nullif(number("dividend"), F.lit(0.0)), number("adjDividend"))
    div = div.select(*KEY, to_iso(F.col("date")).alias("ex_date"), F.lit("dividend").alias("action_type"), paid.alias("amount"), F.lit(None).cast("double").alias("ratio"), market_currency(F.col("market")).alias("currency"))
    cut = records(splits, KEY, ["date", "numerator", "denominator"], "$", "$.historical")
    ratio = F.nullif(number("numerator"), F.lit(0.0)) / F.nullif(number("denominator"), F.lit(0.0))
    cut = cut.select(*KEY, to_iso(F.col("date")).alias("ex_date"), F.lit("split").alias("action_type"), F.lit(None).cast("double").alias("amount"), ratio.alias("ratio"), F.lit(None).cast("string").alias("currency"))
    return div.unionByName(cut)


def estimates(df: DataFrame) -> DataFrame:
    """Three rows a record: revenue, eps and ebitda with their mean, bounds and number of analysts."""
    names = [f"{m}{x}" for m in ("revenue", "eps", "ebitda") for x in ("Avg", "High", "Low")]
    rows = records(df, KEY, ["date", *names, "numAnalystsRevenue", "numAnalystsEps"]).withColumn("fiscal_year", _year()).where("fiscal_year is not null")
    analysts = {"revenue": whole("numAnalystsRevenue"), "eps": whole("numAnalystsEps"), "ebitda": F.lit(None).cast("bigint")}
    one = lambda m: F.struct(F.lit(m).alias("metric"), number(f"{m}Avg").alias("avg_est"), number(f"{m}High").alias("high_est"), number(f"{m}Low").alias("low_est"), analysts[m].alias("num_analysts"))
    return rows.select(*KEY, "fiscal_year", F.explode(F.array(*map(one, analysts))).alias("e")).select(*KEY, "fiscal_year", "e.*")


def news(df: DataFrame) -> DataFrame:
    rows = records(df, KEY, ["publishedDate", "title", "url"])
    return rows.select(*KEY, F.coalesce(to_iso(F.col("publishedDate")), F.lit("")).alias("published_at"), F.coalesce("title", F.lit("")).alias("title"), "url")


def esg(df: DataFrame) -> DataFrame:
    rows = records(df, KEY, ["date", "environmentalScore", "socialScore", "governanceScore", "ESGScore"])
    return rows.select(*KEY, F.coalesce(to_iso(F.col("date")), F.lit("")).alias("period"), number("environmentalScore").alias("env"), number("socialScore").alias("soc"), number("governanceScore").alias("gov"), number("ESGScore").alias("total"))


def institutional(df: DataFrame) -> DataFrame:
    rows = records(df, KEY, ["dateReported", "holder", "shares", "marketValue"])
    return rows.select(*KEY, F.coalesce(to_iso(F.col("dateReported")), F.lit("")).alias("quarter"), F.coalesce("holder", F.lit("")).alias("manager"), number("shares").alias("shares"), number("marketValue").alias("value"))


def earnings(df: DataFrame) -> DataFrame:
    """Dated events; the actual figure is ``epsActual`` where the field is there, even if null, else ``eps``."""
    rows = records(df, KEY, ["date", "epsEstimated", "epsActual", "eps"]).withColumn("event_date", to_iso(F.col("date"))).where("event_date is not null")
    has = F.array_contains(F.json_object_keys("item"), "epsActual")
    return rows.select(*KEY, "event_date", F.lit("earnings").alias("event_type"), number("epsEstimated").alias("eps_estimate"), F.when(has, number("epsActual")).otherwise(number("eps")).alias("eps_actual"))


def index_members(wanted: DataFrame, lists: DataFrame) -> DataFrame:
    """The first entry of each wanted US symbol in each index's list; ``lists`` has ``index_name`` and ``payload``."""
    entries = lists.select("index_name", F.posexplode(items(F.col("payload"), "$")).alias("ord", "item"))
    entries = entries.select("index_name", "ord", F.upper(F.get_json_object("item", "$.symbol")).alias("_s"), to_iso(F.get_json_object("item", "$.dateFirstAdded")).alias("added"))
    first = entries.groupBy("index_name", "_s").agg(F.min_by(F.struct("added"), "ord").alias("f"))
    us = wanted.where(F.upper("market") == "US").select(*KEY, F.upper("symbol").alias("_s"))
    return us.join(first, "_s").select(*KEY, "index_name", "f.added")


def fx_series(df: DataFrame) -> DataFrame:
    """Closing rates of currency pairs; ``base_ccy`` and ``quote_ccy`` come with the payload. Days without a close go."""
    rows = records(df, ["base_ccy", "quote_ccy"], ["date", "close"], "$", "$.historical").withColumn("rate", number("close")).where("rate is not null")
    return rows.select(F.col("date").alias("rate_date"), "base_ccy", "quote_ccy", "rate")


# -- a second vendor: text numbers, maps by day ---------------------------------------


def unthrottled(df: DataFrame) -> DataFrame:
    """Payloads that are objects and no notice about limits."""
    keys = F.json_object_keys("payload")
    return df.where(keys.isNotNull() & ~F.arrays_overlap(keys, F.array(F.lit("Note"), F.lit("Information"))))


def text_number(c: Column) -> Column:
    return number(F.when(~c.isin("None", "-", ""), c))


def overviews(df: DataFrame) -> DataFrame:
    fields = ["Symbol", "Name", "Country", "Sector", "Industry", "CIK", "Currency", "Exchange"]
    rows = unthrottled(df).select(*KEY, F.from_json("payload", ", ".join(f"`{f}` string" for f in fields)).alias("r")).where("r.Symbol <> ''")
    cik = F.when(F.lower("r.CIK") != "none", F.nullif(F.col("r.CIK"), F.lit("")))
    return rows.select(*KEY, *(F.col(f"r.{f}").alias(f.lower()) for f in ("Name", "Country", "Sector", "Industry")), pad_cik(cik).alias("cik"), F.col("r.Currency").alias("currency"), F.col("r.Exchange").alias("exchange"))


def daily_series(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Prices of a map by day."""
    days = F.from_json(F.get_json_object("payload", "$['Time Series (Daily)']"), "map<string, map<string, string>>")
    rows = unthrottled(df).select(*KEY, F.explode(days).alias("trade_date", "m")).where(in_range(F.col("trade_date"), start, end))
    value = lambda k: text_number(F.try_element_at("m", F.lit(k)))
    return rows.select(*KEY, "trade_date", value("1. open").alias("open"), value("2. high").alias("high"), value("3. low").alias("low"), value("4. close").alias("close"), F.floor(value("5. volume")).cast("bigint").alias("volume"), market_currency(F.col("market")).alias("currency"))


def reports(df: DataFrame) -> DataFrame:
    """Annual and quarterly reports as facts; a quarter is that of its last month. The landed table also has ``statement_type``."""
    keep = [*KEY, "statement_type"]
    side = lambda path, kind: unthrottled(df).select(*keep, F.lit(kind).alias("kind"), F.explode(items(F.col("payload"), path)).alias("item"))
    rows = side("$.annualReports", "FY").unionByName(side("$.quarterlyReports", "Q")).withColumn("m", F.from_json("item", "map<string, string>"))
    end = F.nullif(F.try_element_at("m", F.lit("fiscalDateEnding")), F.lit(""))
    rows = rows.withColumns({"period_end": end, "fiscal_year": F.substring(end, 1, 4).try_cast("int"), "currency": F.try_element_at("m", F.lit("reportedCurrency"))}).where("fiscal_year is not null")
    rows = rows.select(*keep, "fiscal_year", F.when(F.col("kind") == "FY", "FY").otherwise(quarter_of(F.col("period_end"))).alias("fiscal_period"), "currency", "period_end", F.explode("m").alias("account", "v"))
    return rows.where(~F.col("account").isin(*REPORT_META)).withColumn("value", text_number(F.col("v"))).where("value is not null").drop("v")


def stamp(c: Column) -> Column:
    """20260809T105936 as 2026-08-09T10:59:36; shorter texts are null."""
    at = lambda i, n: F.substring(c, i, n)
    day = F.concat_ws("-", at(1, 4), at(5, 2), at(7, 2))
    return F.when(F.length(c) >= 15, F.concat(day, F.lit("T"), F.concat_ws(":", at(10, 2), at(12, 2), at(14, 2))))


def scored_news(df: DataFrame) -> DataFrame:
    """News with the symbol's own sentiment where the item has one, else the overall one."""
    schema = "overall_sentiment_score string, time_published string, title string, url string, ticker_sentiment array<struct<ticker: string, ticker_sentiment_score: string>>"
    rows = unthrottled(df).select(*KEY, F.posexplode(items(F.col("payload"), "$.feed")).alias("ord", "item")).withColumn("r", F.from_json("item", schema))
    own = F.filter("r.ticker_sentiment", lambda t: t["ticker"] == F.col("symbol"))
    score = F.when(F.coalesce(F.size(own), F.lit(0)) > 0, F.get(own, F.lit(0))["ticker_sentiment_score"]).otherwise(F.col("r.overall_sentiment_score"))
    return rows.select(*KEY, "ord", F.coalesce(stamp(F.col("r.time_published")), F.lit("")).alias("published_at"), F.coalesce("r.title", F.lit("")).alias("title"), F.col("r.url").alias("url"), text_number(score).alias("sentiment"))


def lei_of(df: DataFrame) -> DataFrame:
    """The first LEI record of each company whose country is the company's, or absent; companies without a country take the first."""
    rows = df.select("company_id", "country", F.posexplode(items(F.col("payload"), "$.data")).alias("ord", "item"))
    there = F.nullif(F.get_json_object("item", "$.attributes.entity.legalAddress.country"), F.lit(""))
    rows = rows.where(F.col("country").isNull() | there.isNull() | (there == F.col("country")))
    return rows.groupBy("company_id").agg(F.min_by(F.get_json_object("item", "$.id"), "ord").alias("lei")).where("lei is not null")
