"""Rows from Korean and Hong Kong feeds: masters, statements, filings, holders, insiders, prices, annual reports."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import day_first, normalize_symbol, parse_signed, period_end, strip, strip_html, to_iso, zero_fill
from .landing import in_range, listed_fields, number, records, whole

#: Report codes and their periods, statement codes and their types, Korean price columns, index codes.
REPORTS = {"11011": "FY", "11014": "Q3", "11012": "H1", "11013": "Q1"}
STATEMENTS = {"IS": "IS", "CIS": "IS", "BS": "BS", "CF": "CF"}
SCOPES = ("CFS", "OFS")
PRICE_COLUMNS = {"시가": "open", "고가": "high", "저가": "low", "종가": "close", "거래량": "volume"}
INDICES = {"1028": "KOSPI200", "1035": "KRX100", "2203": "KOSDAQ150"}
VIEW_URL, DOCUMENT_URL = "https://dart.fss.or.kr/dsaf001/main.do?rcpNo=", "https://opendart.fss.or.kr/api/document.xml?crtfc_key="
HK_HOST = "https://www1.hkexnews.hk"


def amount(c: Column) -> Column:
    """Numbers with thousands separators; a dash or nothing is null."""
    return number(F.nullif(strip(F.replace(c, F.lit(","), F.lit(""))), F.lit("-")))


def dotted(c: Column) -> Column:
    return to_iso(F.translate(strip(c), "./", "--"))


# -- Korea ---------------------------------------------------------------------------------


def listed_companies(df: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Companies with a six-character stock code."""
    rows = df.withColumn("symbol", strip(F.col("stock_code").cast("string"))).where(F.length("symbol") == 6)
    if wanted:
        rows = rows.where(F.col("symbol").isin(*(w.zfill(6) for w in wanted)))
    return rows.select(F.lit("KR").alias("market"), "symbol", F.col("corp_name").alias("name"), F.col("corp_name").alias("local_name"), F.lit("KR").alias("country"), F.col("corp_code").cast("string").alias("corp_code"), F.lit("KRW").alias("currency"), F.lit("COMMON").alias("security_type"))


def statement_requests(spark: SparkSession, years: list[int]) -> DataFrame:
    """What to ask for: every year, report and scope."""
    return spark.createDataFrame([(y, c, s) for y, c, s in product(years, REPORTS, SCOPES)], "fiscal_year int, reprt_code string, fs_scope string")


def statement_rows(df: DataFrame) -> DataFrame:
    """Facts of landed statements (symbol, fiscal_year, reprt_code, fs_scope, payload); a row without an account goes, an unknown statement has no type.

    Where one payload answers several requests, ``requests`` may hold their (reprt_code, fs_scope) instead: it is parsed once.
    """
    of = lambda table, c: F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), c)
    asked = F.col("requests") if "requests" in df.columns else F.array(F.struct("reprt_code", "fs_scope"))
    asked = F.transform(asked, lambda r: F.struct(of(REPORTS, r["reprt_code"]).alias("fiscal_period"), r["fs_scope"].alias("fs_scope")))
    landed = df.select("symbol", "fiscal_year", asked.alias("asked"), "payload")
    rows = listed_fields(landed, ["symbol", "fiscal_year", "asked"], ["account_nm", "sj_div", "thstrm_amount", "thstrm_dt"]).where("r.account_nm is not null")
    facts = rows.select("symbol", "fiscal_year", "asked", of(STATEMENTS, F.upper("r.sj_div")).alias("statement_type"), F.col("r.account_nm").alias("account"), amount(F.col("r.thstrm_amount")).alias("value"), period_end(F.col("r.thstrm_dt")).alias("period_end"))
    facts = facts.select("symbol", "fiscal_year", "statement_type", "account", "value", "period_end", F.explode_outer("asked").alias("q")).where("q is not null")
    return facts.select("symbol", "fiscal_year", "q.fiscal_period", "q.fs_scope", "statement_type", "account", F.col("account").alias("account_local"), "value", F.lit("KRW").alias("currency"), "period_end")


def korean_filings(df: DataFrame, key: str = "") -> DataFrame:
    rows = records(df, ["symbol"], ["rcept_no", "rcept_dt", "report_nm"])
    return rows.select("symbol", F.col("rcept_no").alias("filing_id"), to_iso(F.col("rcept_dt")).alias("filed_date"), F.col("report_nm").alias("filing_type"), F.concat(F.lit(VIEW_URL), "rcept_no").alias("url"), F.array(F.concat(F.lit(f"{DOCUMENT_URL}{key}&rcept_no="), "rcept_no")).alias("doc_urls"))


def korean_holders(df: DataFrame) -> DataFrame:
    """Large holders; rows that name neither holder nor kind go."""
    rows = records(df, ["symbol"], ["rcept_dt", "repror", "report_tp", "stkqy", "stkrt"])
    holder = F.coalesce(F.nullif(F.col("repror"), F.lit("")), F.nullif(F.col("report_tp"), F.lit("")))
    return rows.withColumn("holder_name", holder).where("holder_name is not null").select("symbol", F.coalesce(dotted(F.col("rcept_dt")), F.lit("")).alias("as_of_date"), "holder_name", F.col("report_tp").alias("holder_type"), amount(F.col("stkqy")).alias("shares"), amount(F.col("stkrt")).alias("pct"))


def korean_insiders(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Trades by the sign of the change, numbered within a filing among the rows that stay; no change is a holding of what is held."""
    rows = records(df, ["symbol"], ["rcept_no", "rcept_dt", "repror", "isu_exctv_ofcps", "sp_stock_lmp_irds_cnt", "sp_stock_lmp_cnt"]).withColumn("day", dotted(F.col("rcept_dt")))
    rows = rows.where(in_range(F.col("day"), start, end) & (F.col("repror") != ""))
    change = amount(F.col("sp_stock_lmp_irds_cnt"))
    none = change.isNull() | (change == 0)
    filing = F.coalesce("rcept_no", F.lit(""))
    seq = F.row_number().over(Window.partitionBy("symbol", filing).orderBy("ord")) - 1
    return rows.select("symbol", F.coalesce("day", F.lit("")).alias("filed_date"), F.col("repror").alias("insider"), F.coalesce(F.nullif(F.col("isu_exctv_ofcps"), F.lit("")), F.lit("임원")).alias("relation"), F.when(none, "hold").when(change > 0, "buy").otherwise("sell").alias("txn_type"), seq.alias("txn_seq"), F.when(none, amount(F.col("sp_stock_lmp_cnt"))).otherwise(F.abs(change)).alias("shares"), filing.alias("filing_id"))


def scrubbed(df: DataFrame) -> DataFrame:
    """NaN as null in every floating column."""
    return df.select(*(F.when(~F.isnan(f"`{n}`"), F.col(f"`{n}`")).alias(n) if t in ("double", "float") else F.col(f"`{n}`") for n, t in df.dtypes))


def exchange_master(lists: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Tickers of the exchange lists (exchange, ticker, name); of a wanted ticker the first list that has it."""
    rows = lists if wanted is None else lists.where(F.col("ticker").isin(*wanted))
    return rows.select(F.lit("KR").alias("market"), F.col("ticker").alias("symbol"), "name", F.col("name").alias("local_name"), "exchange", F.lit("KRW").alias("currency"))


def korean_prices(df: DataFrame) -> DataFrame:
    """Prices of a table with Korean column names; days without a close go."""
    rows = df.withColumnsRenamed(PRICE_COLUMNS).withColumn("close", number("close")).where("close is not null")
    return rows.select("symbol", to_iso(F.col("day").cast("string")).alias("trade_date"), *(number(c).alias(c) for c in ("open", "high", "low")), "close", whole("volume").alias("volume"), F.lit(None).cast("double").alias("adj_close"), F.lit("KRW").alias("currency"))


def column_like(df: DataFrame, name: str) -> Column:
    """The column of that name, else the first whose name contains it, else null."""
    found = name if name in df.columns else next((c for c in df.columns if name in c), None)
    return F.lit(None) if found is None else F.col(f"`{found}`")


def foreign_ownership(df: DataFrame, day: str | Column) -> DataFrame:
    """Listed shares and foreign share of a day's snapshot by ticker, whatever its labels are now."""
    return df.select(F.col("ticker").alias("symbol"), (day if isinstance(day, Column) else F.lit(day)).alias("metric_date"), number(column_like(df, "상장주식수")).alias("shares_outstanding"), number(column_like(df, "지분율")).alias("foreign_own_pct"), F.lit("KRW").alias("currency"))


def korean_indices(members: DataFrame, wanted: DataFrame) -> DataFrame:
    """Index names of the wanted symbols; ``members`` has index code and ticker."""
    names = F.create_map(*(F.lit(x) for kv in INDICES.items() for x in kv))
    rows = members.select(F.try_element_at(names, F.col("code")).alias("index_name"), F.col("ticker").alias("symbol")).where("index_name is not null").distinct()
    return rows.join(wanted.select("symbol"), "symbol", "left_semi")


# -- Hong Kong -------------------------------------------------------------------------------


def hk_stocks(df: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    """Master rows of the stock list; of entries of one code the last."""
    rows = records(df, [], ["c", "i", "n"]).withColumn("symbol", zero_fill(F.coalesce("c", F.lit("")), 5))
    rows = rows.groupBy("symbol").agg(F.max_by(F.struct(F.col("i").alias("stock_id"), F.col("n").alias("name")), "ord").alias("r")).select("symbol", "r.*")
    if wanted:
        rows = rows.join(df.sparkSession.createDataFrame([(w,) for w in wanted], "w string").select(normalize_symbol(F.lit("HK"), F.col("w")).alias("symbol")), "symbol", "left_semi")
    return rows.select(F.lit("HK").alias("market"), "symbol", "name", "stock_id", F.lit("HKEX").alias("exchange"), F.lit("HKD").alias("currency"))


def hk_filings(df: DataFrame) -> DataFrame:
    """Filings of a search whose result is JSON inside a JSON string."""
    inner = df.select("symbol", F.get_json_object("payload", "$.result").alias("payload"))
    rows = records(inner, ["symbol"], ["NEWS_ID", "DATE_TIME", "LONG_TEXT", "TITLE", "FILE_LINK"])
    url = F.when(F.col("FILE_LINK").startswith("/"), F.concat(F.lit(HK_HOST), "FILE_LINK")).otherwise(F.col("FILE_LINK"))
    return rows.select("symbol", F.col("NEWS_ID").alias("filing_id"), day_first(F.col("DATE_TIME")).alias("filed_date"), F.nullif(strip_html(F.col("LONG_TEXT")), F.lit("")).alias("filing_type"), F.col("TITLE").alias("title"), url.alias("url"))


def latest_annual_report(filings: DataFrame, key: str = "symbol") -> DataFrame:
    """The newest filing of each key whose title says annual report and that has a URL; undated ones come last, of one day the first id."""
    rows = filings.where(F.contains(F.upper("title"), F.lit("ANNUAL REPORT")) & (F.col("url") != ""))
    w = Window.partitionBy(key).orderBy(F.desc(F.coalesce("filed_date", F.lit(""))), "filing_id")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


#: Headings of the statements' pages, words for units, labels that are page footers.
HEADINGS = {
    "IS": ("consolidated income statement", "consolidated statement of profit or loss", "consolidated statement of profit or loss and other comprehensive income", "income statement", "statement of profit or loss"),
    "BS": ("consolidated statement of financial position", "consolidated balance sheet", "statement of financial position", "balance sheet"),
    "CF": ("consolidated statement of cash flows", "consolidated cash flow statement", "statement of cash flows", "cash flow statement"),
}
UNIT = r"(?i)(RMB|HKD|USD|CNY|EUR|HK\$|US\$)[’'`]?\s*(MILLION|’000|'000|000)"
DATA_ROW = r"^(.*\S)\s+(\(?\d[\d,]*\)?)\s+(\(?\d[\d,]*\)?)\s*$"
YEAR_PAIR = r"(20\d{2})\D{1,20}(20\d{2})"
FOOTERS = ("annual report", "interim report")


def heading_of(text: Column) -> Column:
    """The first line with anything on it, spaces single, lower case."""
    first = F.get(F.filter(F.transform(F.split(text, r"\r\n|\r|\n"), strip), lambda x: x != ""), F.lit(0))
    return F.coalesce(F.lower(F.regexp_replace(first, r"\s+", " ")), F.lit(""))


def statement_pages(pages: DataFrame) -> DataFrame:
    """Pages (symbol, page_no, text) of each statement: from its first heading on while pages bear one of its headings.

    An island of pages is the page number less its rank among the statement's pages.
    """
    types = F.array(*(F.struct(F.lit(k).alias("statement_type"), F.array(*map(F.lit, v)).alias("names")) for k, v in HEADINGS.items()))
    headed = pages.withColumn("_h", heading_of(F.col("text"))).withColumn("t", F.explode(types)).where(F.array_contains("t.names", F.col("_h")))
    rows = headed.select("symbol", "page_no", "text", "t.statement_type")
    w = Window.partitionBy("symbol", "statement_type").orderBy("page_no")
    rows = rows.withColumns({"_island": F.col("page_no") - F.row_number().over(w), "_first": F.min("page_no").over(Window.partitionBy("symbol", "statement_type"))})
    return rows.where(F.col("_island") == F.col("_first") - 1).drop("_island", "_first")


def unit_of(text: Column) -> tuple[Column, Column]:
    """Currency and scale that a statement names; no currency and 1 if it names none."""
    ccy, word = F.upper(F.regexp_extract(text, UNIT, 1)), F.upper(F.regexp_extract(text, UNIT, 2))
    name = F.when(ccy == "HK$", "HKD").when(ccy == "US$", "USD").otherwise(F.nullif(ccy, F.lit("")))
    return name, F.when(word == "", 1.0).when(word == "MILLION", 1e6).otherwise(1e3)


def row_label(label: Column) -> Column:
    """A row's label without the number of a note; null without letters or if it is a footer."""
    bare = strip(F.regexp_replace(label, r"\s+\d{1,3}(\([a-zA-Z0-9]+\))?$", ""))
    return F.when(bare.rlike(r"\p{L}") & ~F.lower(bare).isin(*FOOTERS), bare)


def annual_report_facts(pages: DataFrame) -> DataFrame:
    """Two facts a data row, for the statement's two years, from the text of annual reports."""
    blocks = statement_pages(pages).groupBy("symbol", "statement_type").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("page_no", "text"))), lambda p: p["text"]), "\n").alias("text"))
    currency, scale = unit_of(F.col("text"))
    year = lambda k: F.regexp_extract("text", YEAR_PAIR, k).try_cast("int")
    # what a text says of itself is read in a step of its own: beside the lines' explode it would be read anew for each line
    blocks = blocks.select("symbol", "statement_type", currency.alias("currency"), scale.alias("scale"), year(1).alias("now"), year(2).alias("before"), F.split("text", r"\r\n|\r|\n").alias("lines")).where("now is not null")
    rows = blocks.select("symbol", "statement_type", "currency", "scale", "now", "before", F.posexplode_outer("lines").alias("ord", "line"))
    rows = rows.withColumn("line", strip(F.col("line"))).where(F.col("line").rlike(DATA_ROW))
    # one match a line: the numbers hold no mark, so what stands before their marks is the label
    parts = F.split(F.regexp_replace("line", DATA_ROW, "$1\x01$2\x01$3"), "\x01")
    rows = rows.withColumn("p", parts).select("symbol", "statement_type", "ord", "currency", "scale", "now", "before", F.array_join(F.slice("p", F.lit(1), F.size("p") - 2), "\x01").alias("label"), F.element_at("p", -2).alias("new"), F.element_at("p", -1).alias("old"))
    both = F.array(*(F.struct(F.col(y).alias("fiscal_year"), parse_signed(F.col(c)).alias("raw")) for y, c in (("now", "new"), ("before", "old"))))
    rows = rows.withColumn("account", row_label(F.col("label"))).where("account is not null").select("symbol", "statement_type", "ord", "account", "currency", "scale", F.explode(both).alias("v"))
    return rows.where("v.raw is not null").select("symbol", "v.fiscal_year", F.lit("FY").alias("fiscal_period"), "statement_type", "account", (F.col("v.raw") * F.col("scale")).alias("value"), "currency", F.format_string("%d-12-31", F.col("v.fiscal_year")).alias("period_end"))


