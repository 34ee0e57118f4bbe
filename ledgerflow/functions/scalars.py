"""Column functions for codes, dates, numbers and text. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as white space, in every script.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"
#: The same, one by one: cutting them off by the character costs a fraction of a pattern that is tried at every place of a text.
SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Days before the period end at which a reporting period's window opens.
PERIOD_DAYS = {"FY": 365, "H1": 183, "Q1": 92, "Q2": 92, "Q3": 92, "Q4": 92}
#: Words in a concept's name that mark a cash-flow item.
CASH_FLOW_HINTS = ("cashflow", "netcashprovided", "netcashused", "proceedsfrom", "paymentsto", "paymentsfor", "paymentsofdividends", "cashandcashequivalentsperiod")
#: Words for amounts.
MONEY_SCALE = {"million": 1_000_000.0, "billion": 1_000_000_000.0}


def strip(c: Column) -> Column:
    """White space of any kind off both ends."""
    return F.btrim(c, F.lit(SPACES))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def zero_fill(c: Column, width: int) -> Column:
    """Zeros in front up to ``width``; longer values stay whole."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def squeeze(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.btrim(F.regexp_replace(c, rf"{SPACE}+", " "), F.lit(" "))


# dates


def to_iso(c: Column) -> Column:
    s = blank_to_null(strip(c))
    dashed = F.concat_ws("-", F.substring(s, 1, 4), F.substring(s, 5, 2), F.substring(s, 7, 2))
    day = F.element_at(F.split(F.element_at(F.split(s, "T"), 1), " "), 1)
    return F.when(s.rlike("^[0-9]{8}$"), dashed).otherwise(F.substring(day, 1, 10))


def compact(c: Column) -> Column:
    return F.replace(c, F.lit("-"), F.lit(""))


def years_before(c: Column, years: int) -> Column:
    return F.date_format(F.add_months(F.try_to_date(c), -12 * years), "yyyy-MM-dd")


def window_start(period: Column, end: Column) -> Column:
    """First day of the period that ends at ``end``; unknown periods last a year."""
    days = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in PERIOD_DAYS.items() for x in kv)), period), F.lit(365))
    return F.date_format(F.date_sub(F.try_to_date(end), days), "yyyy-MM-dd")


def year_end(year: Column) -> Column:
    return F.format_string("%04d-12-31", year)


def days_between(a: Column, b: Column) -> Column:
    return F.datediff(F.try_to_date(b), F.try_to_date(a))


def epoch_date(seconds: Column) -> Column:
    """UTC day of an epoch second, whatever the session's zone."""
    return F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int")), "yyyy-MM-dd")


def month_day_year(c: Column) -> Column:
    return F.date_format(F.try_to_timestamp(c, F.lit("M/d/yyyy")).cast("date"), "yyyy-MM-dd")


def day_first(c: Column) -> Column:
    """dd/mm/yyyy with or without a time after it."""
    return F.date_format(F.try_to_timestamp(F.get(F.split(c, " "), F.lit(0)), F.lit("d/M/yyyy")).cast("date"), "yyyy-MM-dd")


def period_end(c: Column) -> Column:
    """The end of a dotted day or of a range of two."""
    return to_iso(F.translate(strip(F.element_at(F.split(strip(c), "~"), -1)), "./", "--"))


def range_or_default(start: str | None, end: str | None, today: str, years: int = 5) -> tuple[str, str]:
    """The bounds asked for; without a start so many years before today, without an end today. February 29 falls on 28."""
    year, rest = int(today[:4]) - years, today[4:]
    leap = year % 4 == 0 and (year % 100 != 0 or year % 400 == 0)
    return start or f"{year:04d}{'-02-28' if rest == '-02-29' and not leap else rest}", end or today


def quarter_of(c: Column) -> Column:
    """Calendar quarter of an ISO date, or Q if it has none."""
    return F.coalesce(F.concat(F.lit("Q"), F.quarter(F.try_to_date(c)).cast("string")), F.lit("Q"))


# codes


def normalize_symbol(market: Column, symbol: Column) -> Column:
    m, s = F.upper(F.coalesce(market, F.lit(""))), F.upper(strip(F.coalesce(symbol, F.lit(""))))
    kr = F.replace(F.replace(s, F.lit(".KS"), F.lit("")), F.lit(".KQ"), F.lit(""))
    hk = F.replace(s, F.lit(".HK"), F.lit(""))
    coded = lambda x, n: F.when(digits(x) != "", zero_fill(digits(x), n)).otherwise(x)
    return F.when(m == "KR", coded(kr, 6)).when(m == "HK", coded(hk, 5)).otherwise(s)


def hk_short(s: Column) -> Column:
    """Four digits or more, without further zeros in front."""
    return F.when(digits(s) != "", zero_fill(F.ltrim(digits(s), F.lit("0")), 4)).otherwise(s)


def yahoo_symbols(market: Column, symbol: Column) -> Column:
    """Candidate tickers in the order to try."""
    m, s = F.upper(market), F.upper(symbol)
    suffixed = s.endswith(".KS") | s.endswith(".KQ")
    kr = F.when(suffixed, F.array(s)).otherwise(F.array(F.concat(zero_fill(s, 6), F.lit(".KS")), F.concat(zero_fill(s, 6), F.lit(".KQ"))))
    hk = F.when(s.endswith(".HK"), F.array(s)).otherwise(F.array(F.concat(hk_short(s), F.lit(".HK"))))
    return F.when(m == "KR", kr).when(m == "HK", hk).otherwise(F.array(s))


def fmp_symbol(market: Column, symbol: Column) -> Column:
    m, s = F.upper(market), F.upper(symbol)
    kr = F.when(s.endswith(".KS") | s.endswith(".KQ"), s).otherwise(F.concat(zero_fill(s, 6), F.lit(".KS")))
    hk = F.when(s.endswith(".HK") | (digits(s) == ""), s).otherwise(F.concat(hk_short(s), F.lit(".HK")))
    return F.when(m == "KR", kr).when(m == "HK", hk).otherwise(s)


def pad_cik(c: Column) -> Column:
    """Ten digits; what is not a number stays."""
    return F.coalesce(zero_fill(c.try_cast("bigint").cast("string"), 10), c)


def normalize_issuer(c: Column) -> Column:
    return F.regexp_replace(F.upper(c), "[^A-Z0-9]+", "")


def statement_type(concept: Column, has_start: Column) -> Column:
    return F.when(~has_start, "BS").when(F.lower(concept).rlike("|".join(CASH_FLOW_HINTS)), "CF").otherwise("IS")


# numbers


def parse_money(c: Column) -> Column:
    return F.regexp_replace(c, "[$,]", "").try_cast("double")


def parse_signed(c: Column) -> Column:
    """Numbers with thousands separators; parentheses are a minus sign."""
    n = F.regexp_replace(F.btrim(c, F.lit("()")), ",", "").try_cast("double")
    return F.when(c.rlike(r"^\(.*\)$"), -n).otherwise(n)


def parse_scaled(number: Column, scale: Column) -> Column:
    n = F.regexp_replace(number, ",", "").try_cast("double")
    return n * F.when(F.lower(scale) == "million", MONEY_SCALE["million"]).when(F.lower(scale) == "billion", MONEY_SCALE["billion"]).otherwise(1.0)


def compact_number(c: Column) -> Column:
    """Billions and millions with a letter, two decimals; - for null."""
    two = lambda x: F.format_number(x, 2)
    return F.when(c.isNull(), "-").when(F.abs(c) >= 1e9, F.concat(two(c / 1e9), F.lit("B"))).when(F.abs(c) >= 1e6, F.concat(two(c / 1e6), F.lit("M"))).otherwise(two(c))


def inverse(c: Column) -> Column:
    return 1.0 / F.nullif(c, F.lit(0.0))


# text


def truncate(c: Column, width: int = 60) -> Column:
    return F.when(F.length(c) > width, F.concat(F.substring(c, 1, width - 1), F.lit("…"))).otherwise(c)


def split_csv(c: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), strip), lambda x: x != "")


def without_scripts(c: Column) -> Column:
    return F.regexp_replace(c, r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>", " ")


def strip_html(c: Column) -> Column:
    """Tags out, white space to single spaces; scripts and styles first."""
    return squeeze(F.regexp_replace(without_scripts(c), r"<[^>]*>", " "))


def unescape(c: Column) -> Column:
    """The common character references, the ampersand last."""
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#39", "'"), ("apos", "'"), ("nbsp", "\xa0"), ("amp", "&")):
        c = F.replace(c, F.lit(f"&{name};"), F.lit(char))
    return c


def html_lines(c: Column) -> Column:
    """The stretches of text between tags, one a line, none empty."""
    parts = F.transform(F.split(without_scripts(c), r"<[^>]*>"), lambda x: strip(unescape(x)))
    return F.array_join(F.filter(parts, lambda x: x != ""), "\n")


def line_key(c: Column) -> Column:
    """What running heads have in common from page to page: numbers as #, lower case."""
    return F.lower(squeeze(F.regexp_replace(c, r"\p{Nd}+", "#")))


#: Fixed value: lines that hold a page's number alone.
PAGE_NUMBER = r"(?iu)^[\s\p{Z}\-–—]*(?:page|p\.?|페이지|第)?[\s\p{Z}]*\p{Nd}+[\s\p{Z}]*(?:(?:of|/|–|—|-)[\s\p{Z}]*\p{Nd}+)?[\s\p{Z}]*(?:쪽|페이지|页)?[\s\p{Z}\-–—]*$"


def is_page_number(c: Column) -> Column:
    return c.rlike(PAGE_NUMBER)


#: Fixed value: a cell that holds a number.
NUMERIC_CELL = r"^\(?-?\p{Nd}[\p{Nd},.\s\p{Z}]*\)?%?$"


def is_numeric(c: Column) -> Column:
    return strip(c).rlike(NUMERIC_CELL)


def json_strings(c: Column) -> Column:
    """The texts of a JSON array; none where it is not one."""
    return F.coalesce(F.from_json(c, "array<string>"), F.array().cast("array<string>"))


def reply_json(c: Column, schema: str) -> Column:
    """The JSON object in a free reply: from its first brace to its last."""
    return F.from_json(F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit("")), schema)


def content_key(c: Column) -> Column:
    return F.substring(F.sha1(c), 1, 16)
