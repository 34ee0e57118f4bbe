"""Rows from disclosure feeds of the United States: tickers, filings, insiders, large holders, fund holdings, offerings, text hits.

Landed tables carry ``symbol`` and ``cik`` beside the ``payload`` where rows are
per company. Documents come as a table of ``url`` and ``content``, so that fetching
stays outside and every parser is a plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import days_between, html_lines, month_day_year, normalize_issuer, parse_money, strip, to_iso, zero_fill
from .landing import in_range, items, number, records

ARCHIVE = "https://www.sec.gov/Archives/edgar/data"
#: Names of exchanges, forms of large holders, forms that register an offering.
EXCHANGES = {"Nasdaq": "NASDAQ", "NYSE": "NYSE", "NYSE Arca": "NYSEARCA", "OTC": "OTC", "CBOE": "CBOE"}
HOLDER_FORMS = ("SC 13D", "SC 13D/A", "SC 13G", "SC 13G/A")
REGISTRATION_FORMS = ("S-1", "S-1/A", "F-1", "F-1/A")
INSIDER_LIMIT, HOLDER_LIMIT = 25, 15
BULK_LINK = r'href="([^"]*form-13f-data-sets/[^"]*_form13f\.zip)"'


def cik10(c: Column) -> Column:
    return zero_fill(c.try_cast("bigint").cast("string"), 10)


# -- companies ---------------------------------------------------------------------------


def ticker_map(df: DataFrame) -> DataFrame:
    """ticker, cik, title and exchange of a columnar list {fields, data}; of a map of objects where there are no fields. A ticker's last entry counts."""
    fields = F.from_json(F.get_json_object("payload", "$.fields"), "array<string>")
    rows = df.withColumn("f", fields)
    at = lambda name: F.get("v", F.array_position("f", F.lit(name)).cast("int") - 1)
    place = lambda name: F.array_position("f", name) > 0
    lists = rows.where("f is not null").select("f", F.posexplode(F.from_json(F.get_json_object("payload", "$.data"), "array<array<string>>")).alias("ord", "v"))
    lists = lists.select("ord", F.upper(at("ticker")).alias("ticker"), at("cik").alias("cik"), at("name").alias("title"), F.when(place(F.lit("exchange")), at("exchange")).alias("exchange"))
    maps = rows.where("f is null").select(F.posexplode(F.map_entries(F.from_json("payload", "map<string, struct<cik_str: string, ticker: string, title: string>>"))).alias("ord", "e"))
    maps = maps.select("ord", F.upper("e.value.ticker").alias("ticker"), F.col("e.value.cik_str").alias("cik"), F.col("e.value.title").alias("title"), F.lit(None).cast("string").alias("exchange"))
    both = lists.unionByName(maps).where("ticker is not null")
    return both.groupBy("ticker").agg(F.max_by(F.struct("cik", "title", "exchange"), "ord").alias("r")).select("ticker", "r.*")


def master(tickers: DataFrame, wanted: list[str] | None = None) -> DataFrame:
    names = F.create_map(*(F.lit(x) for kv in EXCHANGES.items() for x in kv))
    rows = tickers if wanted is None else tickers.where(F.col("ticker").isin(*(w.upper() for w in wanted)))
    exchange = F.coalesce(F.try_element_at(names, F.col("exchange")), F.col("exchange"))
    return rows.select(F.lit("US").alias("market"), F.col("ticker").alias("symbol"), F.col("title").alias("name"), F.lit("US").alias("country"), cik10(F.col("cik")).alias("cik"), F.lit("USD").alias("currency"), exchange.alias("exchange"), F.lit("COMMON").alias("security_type"))


# -- filings -----------------------------------------------------------------------------


def submissions(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Filings of the parallel arrays of a company's recent submissions, in order, with the URL of each; undated ones stay, short arrays give nulls."""
    schema = ", ".join(f"{c} array<string>" for c in ("accessionNumber", "filingDate", "form", "primaryDocument", "primaryDocDescription"))
    parsed = df.select("symbol", "cik", F.from_json(F.get_json_object("payload", "$.filings.recent"), schema).alias("p"))
    rows = parsed.select("symbol", "cik", F.posexplode(F.arrays_zip(*(F.coalesce(f"p.{c}", F.array().cast("array<string>")).alias(c) for c in ("accessionNumber", "filingDate", "form", "primaryDocument", "primaryDocDescription")))).alias("ord", "r"))
    rows = rows.where("r.accessionNumber is not null").withColumn("filed_date", to_iso(F.col("r.filingDate"))).where(in_range(F.col("filed_date"), start, end))
    folder = F.concat_ws("/", F.lit(ARCHIVE), F.col("cik").try_cast("bigint").cast("string"), F.replace("r.accessionNumber", F.lit("-"), F.lit("")))
    doc = F.coalesce("r.primaryDocument", F.lit(""))
    return rows.select("symbol", "ord", F.col("r.accessionNumber").alias("filing_id"), "filed_date", F.coalesce("r.form", F.lit("")).alias("filing_type"), F.col("r.primaryDocDescription").alias("title"), folder.alias("folder"), doc.alias("document"), F.concat_ws("/", folder, F.nullif(doc, F.lit(""))).alias("url"))


def first_of_each(rows: DataFrame, key: str, order: str, limit: int) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where(F.col("_n") <= limit).drop("_n")


def raw_xml_url(rows: DataFrame, listings: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``xml_url``: the document without its rendering folder if it is XML, else the first XML of the folder's listing (``folder``, ``payload``) that is no rendering."""
    direct = F.when(F.lower("document").endswith(".xml"), F.concat_ws("/", "folder", F.element_at(F.split("document", "/"), -1)))
    if listings is None:
        return rows.withColumn("xml_url", direct)
    names = F.transform(items(F.col("payload"), "$.directory.item"), lambda x: F.get_json_object(x, "$.name"))
    first = F.get(F.filter(names, lambda n: F.lower(n).endswith(".xml") & ~F.lower(n).startswith("xsl")), F.lit(0))
    known = listings.select("folder", first.alias("_name")).where("_name is not null").dropDuplicates(["folder"])
    joined = rows.join(known, "folder", "left")
    return joined.withColumn("xml_url", F.coalesce(direct, F.concat_ws("/", "folder", F.col("_name")), F.lit(None))).withColumn("xml_url", F.when(direct.isNotNull() | F.col("_name").isNotNull(), F.col("xml_url"))).drop("_name")


def insider_trades(filings: DataFrame, documents: DataFrame) -> DataFrame:
    """Transactions of the first INSIDER_LIMIT ownership forms of each symbol that have a document; a form without one is a single holding row.

    ``filings`` has ``xml_url``, ``documents`` url and content. A transaction that
    is neither acquired nor disposed keeps its code.
    """
    forms = filings.where((F.col("filing_type") == "4") & F.col("xml_url").isNotNull())
    forms = first_of_each(forms, "symbol", "ord", INSIDER_LIMIT).join(documents.withColumnRenamed("url", "xml_url"), "xml_url")
    doc = lambda path: F.get(F.xpath("content", F.lit(path)), F.lit(0))
    plain = F.regexp_replace("content", r"^\s*(<\?xml[^>]*\?>)?", "")
    # every path parses the document anew, so a tag is looked for where its name occurs at all
    text = lambda tag: F.when(F.contains("content", F.lit(tag)), strip(doc(f"//{tag}//text()[normalize-space()]")))
    yes = lambda tag: text(tag).isin("1", "true")
    rows = forms.withColumn("content", plain).withColumns({"insider": F.coalesce(text("rptOwnerName"), F.lit("unknown")), "_title": text("officerTitle")})
    relation = F.coalesce("_title", F.when(yes("isDirector"), "director").when(yes("isOfficer"), "officer"))
    rows = rows.withColumn("relation", relation).drop("_title")
    value = lambda i, tag: strip(F.nullif(F.regexp_replace(F.regexp_extract(i, rf"(?s)<{tag}\b[^>]*>(.*?)</{tag}>", 1), r"<[^>]*>", ""), F.lit("")))
    blocks = F.regexp_extract_all("content", F.lit(r"(?s)<nonDerivativeTransaction\b[^>]*>.*?</nonDerivativeTransaction>"), F.lit(0))
    rows = rows.select("symbol", "filed_date", "filing_id", "insider", "relation", F.posexplode_outer(blocks).alias("seq", "b"))
    code = value(F.col("b"), "transactionAcquiredDisposedCode")
    kind = F.when(F.col("b").isNull(), "hold").when(code == "A", "buy").when(code == "D", "sell").otherwise(F.coalesce(code, F.lit("hold")))
    return rows.select("symbol", F.coalesce("filed_date", F.lit("")).alias("filed_date"), "filing_id", "insider", "relation", kind.alias("txn_type"), F.coalesce("seq", F.lit(0)).alias("txn_seq"), number(value(F.col("b"), "transactionShares")).alias("shares"), number(value(F.col("b"), "transactionPricePerShare")).alias("price"))


# -- cover pages -------------------------------------------------------------------------

#: How cover pages word the share of the class, the amount held, the label before a name, and what stands between label and name.
PERCENT = (r"(?is)percent of class[\s\S]{0,140}?(\d{1,3}(?:\.\d+)?)\s*%", r"(?is)(\d{1,3}(?:\.\d+)?)\s*%\s*(?:of|of the)\s+(?:the\s+)?class")
AMOUNT = r"(?is)aggregate amount beneficially owned[\s\S]{0,180}?([1-9]\d{0,2}(?:,\d{3})+|\d{4,})"
NAME_LABEL = r"(?is)names?\s+of\s+reporting\s+persons?"
NOT_A_NAME = r"(?i)i\.?r\.?s\.?|identification|entities only|check the appropriate|member of a group|sec use only|^\(?[a-z0-9]\)?[.)]?$|^\(\d+\)|social security|of above person"


def cover_percent(text: Column) -> Column:
    """Percent of the class, 0 to 100; the first wording decides where both occur."""
    one = [F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in PERCENT]
    x = F.coalesce(*one).try_cast("double")
    return F.when(x.between(0, 100), x)


def cover_shares(text: Column) -> Column:
    return F.replace(F.regexp_extract(text, AMOUNT, 1), F.lit(","), F.lit("")).try_cast("double")


def cover_holder(text: Column) -> Column:
    """The first name in the ten lines after the label: no boilerplate, an employer number cut off, letters for a third of it."""
    tail = F.get(F.split(text, NAME_LABEL, 2), F.lit(1))
    trim = lambda c, chars: F.regexp_replace(F.regexp_replace(c, rf"^[{chars}]+", ""), rf"[{chars}]+$", "")
    lines = F.transform(F.slice(F.split(tail, "\n"), 1, 10), lambda x: trim(x, r" \t.:\-()"))
    some = F.filter(lines, lambda x: (F.length(x) >= 3) & ~x.rlike(NOT_A_NAME) & x.rlike("[A-Za-z]{2,}"))
    bare = F.transform(some, lambda x: trim(F.regexp_replace(x, r"\s*[-–]?\s*\d{2}-\d{7}\s*$", ""), r" \t.:\-"))
    enough = lambda x: F.length(F.regexp_replace(x, r"[^\p{L}]", "")) >= F.greatest(F.lit(3), F.floor(F.length(x) / 3))
    return F.substring(F.get(F.filter(bare, enough), F.lit(0)), 1, 200)


def large_holders(filings: DataFrame, documents: DataFrame) -> DataFrame:
    """Holder, shares and percent from the covers of large holders' forms: the first HOLDER_LIMIT a symbol that say a holder or a percent."""
    forms = filings.where(F.col("filing_type").isin(*HOLDER_FORMS) & (F.col("document") != "")).join(documents, "url")
    rows = forms.withColumn("_t", html_lines(F.col("content")))
    rows = rows.withColumns({"holder": cover_holder(F.col("_t")), "pct": cover_percent(F.col("_t")), "shares": cover_shares(F.col("_t"))}).where("holder is not null or pct is not null")
    rows = first_of_each(rows, "symbol", "ord", HOLDER_LIMIT)
    return rows.select("symbol", F.coalesce("filed_date", F.lit("")).alias("as_of_date"), F.coalesce("holder", F.lit("(unknown)")).alias("holder_name"), F.col("filing_type").alias("holder_type"), "shares", "pct")


# -- fund holdings -----------------------------------------------------------------------


def tab_table(spark, path: str) -> DataFrame:
    """A tab-separated file in Latin-1 with its header."""
    return spark.read.csv(path, sep="\t", header=True, encoding="ISO-8859-1", quote='"', escape='"')


def fund_holdings(companies: DataFrame, cover: DataFrame, info: DataFrame) -> DataFrame:
    """Funds' holdings of each company (``symbol``, ``title``) by its normalised name."""
    filers = cover.groupBy("ACCESSION_NUMBER").agg(F.max(F.struct("FILINGMANAGER_NAME", "REPORTCALENDARORQUARTER")).alias("f"))
    wanted = companies.select("symbol", normalize_issuer(F.col("title")).alias("_issuer"))
    held = info.select(normalize_issuer(F.col("NAMEOFISSUER")).alias("_issuer"), "ACCESSION_NUMBER", "VALUE", "SSHPRNAMT").join(wanted, "_issuer").join(filers, "ACCESSION_NUMBER")
    return held.select("symbol", F.col("f.REPORTCALENDARORQUARTER").alias("quarter"), F.col("f.FILINGMANAGER_NAME").alias("manager"), number("SSHPRNAMT").alias("shares"), number("VALUE").alias("value"))


def bulk_link(page: Column) -> Column:
    """The first link to a data set on a listing page, whole."""
    return F.concat(F.lit("https://www.sec.gov"), F.nullif(F.regexp_extract(page, BULK_LINK, 1), F.lit("")))


# -- offerings ---------------------------------------------------------------------------


def months_before(month: Column, n: int) -> Column:
    return F.date_format(F.add_months(F.try_to_date(F.concat(month, F.lit("-01"))), -n), "yyyy-MM")


def offerings(wanted: DataFrame, calendar: DataFrame, today: str, months: int = 24, look_back: int = 6) -> DataFrame:
    """The newest priced deal of each wanted symbol in the last ``months`` months, with the size it was filed at.

    ``calendar`` has ``month`` (YYYY-MM) and ``payload``. The filed size is that of
    the deal's entry in the nearest of the ``look_back`` months up to the priced one.
    """
    fields = "proposedTickerSymbol string, dollarValueOfSharesOffered string, dealID string, dealStatus string, pricedDate string, proposedSharePrice string, sharesOffered string"
    side = lambda kind: calendar.select("month", F.posexplode(items(F.col("payload"), f"$.data.{kind}.rows")).alias("ord", "item")).select("month", "ord", F.from_json("item", fields).alias("r")).select("month", "ord", "r.*")
    last = F.lit(today[:7])
    priced = side("priced").where((F.col("month") <= last) & (F.col("month") > months_before(last, months))).withColumn("_s", F.upper("proposedTickerSymbol"))
    newest = priced.groupBy("_s").agg(F.max_by(F.struct("month", "dealID", "dealStatus", "pricedDate", "proposedSharePrice", "sharesOffered", "dollarValueOfSharesOffered"), F.struct("month", -F.col("ord"))).alias("p")).select("_s", "p.*")
    filed = side("filed").groupBy("dealID", F.col("month").alias("_filed")).agg(F.min_by("dollarValueOfSharesOffered", "ord").alias("_size"))
    deals = wanted.select("symbol", F.upper("symbol").alias("_s")).join(newest, "_s")
    sizes = deals.select("symbol", "dealID", F.explode(F.array(*(F.struct(F.lit(-k).alias("near"), months_before(F.col("month"), k).alias("_filed")) for k in range(look_back)))).alias("m")).select("symbol", "dealID", "m.*")
    sizes = sizes.join(filed, ["dealID", "_filed"]).groupBy("symbol").agg(F.max_by("_size", "near").alias("_size"))
    return deals.join(sizes, "symbol", "left").select("symbol", F.coalesce(month_day_year(F.col("pricedDate")), F.lit(today)).alias("signal_date"), F.lit("nasdaq_calendar").alias("signal_type"), parse_money(F.col("_size")).alias("filed_amount"), parse_money(F.col("dollarValueOfSharesOffered")).alias("priced_amount"), parse_money(F.col("proposedSharePrice")).alias("price"), parse_money(F.col("sharesOffered")).alias("shares"), F.coalesce(F.nullif(F.col("dealStatus"), F.lit("")), F.lit("Priced")).alias("status"))


def text_hits(df: DataFrame, mention: str, signal_type: str, today: str, skip_underwriting: bool = False) -> DataFrame:
    """Hits of a text search as signals; landed rows carry ``symbol`` and ``ipo_date``. Hits without file or company go, exhibits of the underwriting too if asked."""
    schema = "_id string, _source struct<ciks: array<string>, form: string, file_type: string, file_description: string, file_date: string>"
    rows = df.select("symbol", "ipo_date", F.posexplode(items(F.col("payload"), "$.hits.hits")).alias("ord", "item")).select("symbol", "ipo_date", "ord", F.from_json("item", schema).alias("h"))
    s = lambda name: F.col(f"h._source.{name}")
    accession, file = F.substring_index("h._id", ":", 1), F.expr("substring(h._id, instr(h._id, ':') + 1)")
    cik = F.get(s("ciks"), F.lit(0))
    rows = rows.where(F.contains(F.col("h._id"), F.lit(":")) & (accession != "") & (file != "") & (cik != ""))
    exhibit = strip(F.coalesce(F.nullif(s("file_type"), F.lit("")), F.nullif(s("file_description"), F.lit("")), F.lit("")))
    if skip_underwriting:
        rows = rows.where(~exhibit.rlike(r"(?i)^EX-1\.\d+$"))
    day = F.coalesce(to_iso(s("file_date")), F.lit(today))
    off = days_between(F.col("ipo_date"), day)
    note = F.when(F.abs(off) <= 30, "IPO 확정일 대비").otherwise("IPO 확정일 대비 (별건일 가능성)")
    detail = F.concat(strip(F.concat_ws(" ", s("form"), F.coalesce(s("file_description"), F.lit("")))), F.lit(f' mentions "{mention}"'))
    detail = F.when(off.isNotNull(), F.concat(detail, F.lit(" ["), note, F.lit(" "), F.format_string("%+d", off), F.lit("일]"))).otherwise(detail)
    url = F.concat_ws("/", F.lit(ARCHIVE), cik.try_cast("bigint").cast("string"), F.replace(accession, F.lit("-"), F.lit("")), file)
    return rows.select("symbol", "ord", day.alias("signal_date"), F.lit(signal_type).alias("signal_type"), detail.alias("detail"), url.alias("url"))
