"""Signals in disclosure text: price ranges, final prices, anchor investors, confidential reviews.

Filings are rows (symbol, filing_id, filed_date, filing_type, url, text). A symbol's
documents are taken by day, those without one first, in the order of ``ord``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import parse_scaled, strip
from ..sources.disclosures import REGISTRATION_FORMS

#: How prospectuses word a price range, a final price and an indication of interest.
RANGE = r"(?i)offering\s+price[^$]{0,100}between\s*\$\s*(\d{1,4}\.\d{2})\s*and\s*\$\s*(\d{1,4}\.\d{2})"
FINAL = r"(?i)initial\s+public\s+offering\s+price\s+(?:is|of)\s*\$\s*(\d{1,4}\.\d{2})\s*per\s+share"
ANCHOR = re.compile(r"([A-Z][^.]{0,150}?)\s+(?:have|has)\s+indicated\s+an\s+interest\s+in\s+purchasing[^$]{0,80}\$\s*([\d,]+(?:\.\d+)?)\s*(million|billion)?", re.I)
#: Forms of confidential drafts.
DRAFT_FORMS = ("DRS", "DRS/A")
#: Characters of context beside a match.
RADIUS = 500


def change(final: Column, high: Column) -> Column:
    """The signed percentage of a final price against the top of its range, whole."""
    share = (final - high) / F.nullif(high, F.lit(0.0)) * 100
    return F.when(share.isNotNull(), F.format_string("%+.0f", F.rint(share)))


def price_band(df: DataFrame, text: str) -> DataFrame:
    """low, high, final and the change of every row by itself."""
    number = lambda pattern, k: F.regexp_extract(text, pattern, k).try_cast("double")
    out = df.withColumns({"low": number(RANGE, 1), "high": number(RANGE, 2), "final": number(FINAL, 1)})
    return out.withColumn("change", change(F.col("final"), F.col("high")))


def registrations(filings: DataFrame) -> DataFrame:
    return filings.where(F.col("filing_type").isin(*REGISTRATION_FORMS))


def prospectuses(filings: DataFrame) -> DataFrame:
    return filings.where(F.col("filing_type").startswith("424B"))


def _earliest(df: DataFrame, values: list[str]) -> DataFrame:
    """Of each symbol the first row by day and place."""
    order = F.struct(F.coalesce("filed_date", F.lit("")), "ord")
    return df.groupBy("symbol").agg(F.min_by(F.struct(*values), order).alias("r")).select("symbol", "r.*")


def price_band_signals(filings: DataFrame) -> DataFrame:
    """One row a symbol with a range in a registration or a final price in a prospectus: the earliest of each, and what they say together."""
    found = price_band(filings, "text")
    ranged = _earliest(registrations(found).where("low is not null"), ["low", "high", "filed_date"]).withColumnRenamed("filed_date", "range_date")
    priced = _earliest(prospectuses(found).where("final is not null"), ["final", "filed_date", "url"]).withColumnRenamed("filed_date", "final_date")
    w = Window.partitionBy("symbol").orderBy(F.desc(F.coalesce("filed_date", F.lit(""))), F.desc("ord"))
    last = registrations(found).withColumn("_n", F.row_number().over(w)).where("_n = 1").select("symbol", F.col("url").alias("_last"))
    both = ranged.join(priced, "symbol", "full_outer").join(last, "symbol", "left")
    money = lambda c: F.format_string("$%.2f", F.col(c))
    bounds = F.concat(F.lit("Initial range "), money("low"), F.lit("-"), money("high"), F.lit(" ("), F.coalesce("range_date", F.lit("None")), F.lit(")"))
    final = F.concat(F.lit("final "), money("final"), F.lit(" ("), F.coalesce("final_date", F.lit("None")), F.lit(")"))
    whole = F.concat(bounds, F.lit(" -> "), final, F.lit(", "), change(F.col("final"), F.col("high")), F.lit("% vs. range top"))
    alone = F.concat(F.lit("Final price "), F.substring(final, 7, 1000), F.lit("; no price range found in registration filings"))
    open_ = F.concat(bounds, F.lit("; no 424B priced yet"))
    detail = F.when(F.col("low").isNotNull() & F.col("final").isNotNull(), whole).when(F.col("final").isNotNull(), alone).otherwise(open_)
    return both.select("symbol", F.coalesce("final_date", "range_date").alias("signal_date"), F.lit("price_band").alias("signal_type"), F.col("final").alias("price"), detail.alias("detail"), F.coalesce("url", "_last").alias("url"))


def excerpt(text: str, start: int, end: int, radius: int = RADIUS) -> str:
    """A match with its surroundings, cut at a sentence on each side that the radius cuts."""
    lo, hi = max(0, start - radius), min(len(text), end + radius)
    if lo and (stop := text.find(". ", lo, start)) >= 0:
        lo = stop + 2
    if hi < len(text) and (stop := text.rfind(". ", end, hi)) >= 0:
        hi = stop + 1
    return text[lo:hi].strip()


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("name", "number", "scale", "excerpt")])))
def anchors(text: pd.Series) -> pd.Series:
    """All indications of interest in a text; places of matches are needed, which column functions do not give."""
    return text.map(lambda t: [{"name": m[1].strip(), "number": m[2], "scale": m[3], "excerpt": excerpt(t, *m.span())} for m in ANCHOR.finditer(t)] if t else [])


def anchor_signals(filings: DataFrame) -> DataFrame:
    """Every investor and amount once a symbol, from the earliest dated registration or prospectus that says it."""
    rows = registrations(filings).unionByName(prospectuses(filings)).where("filed_date <> ''")
    rows = rows.select("symbol", "ord", "filed_date", "filing_type", "url", F.posexplode(anchors("text")).alias("at", "a"))
    rows = rows.withColumn("amount", parse_scaled(F.col("a.number"), F.col("a.scale"))).where("amount is not null")
    first = first_occurrences(rows.withColumn("name", F.col("a.name")), ["symbol", F.lower("name"), F.format_string("%.2f", "amount")], ["filed_date", "ord", "at"])
    detail = F.concat("filing_type", F.lit(" ("), "filed_date", F.lit('): "'), F.col("a.excerpt"), F.lit('"'))
    return first.select("symbol", F.col("filed_date").alias("signal_date"), F.lit("anchor_investor").alias("signal_type"), F.col("name").alias("investor_name"), F.col("amount").alias("indicated_amount"), detail.alias("detail"), "url")


def first_occurrences(df: DataFrame, keys: list, order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def first_matches(df: DataFrame, keys: list[str], matches: Column, order: list[str]) -> DataFrame:
    """The earliest row of each key that matches."""
    return first_occurrences(df.where(matches), keys, order)


def review_gaps(df: DataFrame, key: str, kind: Column, day: Column, drafts: Sequence[str], public: Sequence[str]) -> DataFrame:
    """First draft, first public filing, days between and number of dated drafts of keys that have both, the draft no later."""
    there = lambda kinds: kind.isin(*kinds) & day.isNotNull() & (day != "")
    at = lambda kinds: F.min(F.when(there(kinds), day))
    rows = df.groupBy(key).agg(at(drafts).alias("first_draft"), at(public).alias("first_public"), F.count_if(there(drafts)).alias("drafts"))
    return rows.withColumn("gap_days", F.datediff(F.try_to_date("first_public"), F.try_to_date("first_draft"))).where("gap_days >= 0")


def confidential_reviews(filings: DataFrame) -> DataFrame:
    """A signal for each symbol whose first draft registration came before its first public one: how long the review took.

    Of public filings of one day the first by ``ord`` counts.
    """
    gaps = review_gaps(filings, "symbol", F.col("filing_type"), F.col("filed_date"), DRAFT_FORMS, REGISTRATION_FORMS)
    public = first_matches(filings, ["symbol"], F.col("filing_type").isin(*REGISTRATION_FORMS) & (F.col("filed_date") != ""), ["filed_date", "ord"])
    both = gaps.join(public.select("symbol", "filing_type", "url"), "symbol")
    detail = F.concat(F.lit("Confidential DRS review: first draft "), "first_draft", F.lit(" -> first public "), "filing_type", F.lit(" "), "first_public", F.lit(" ("), F.col("gap_days").cast("string"), F.lit(" days, "), F.col("drafts").cast("string"), F.lit(" draft submission(s) on file)"))
    return both.select("symbol", F.col("first_public").alias("signal_date"), F.lit("confidential_review").alias("signal_type"), detail.alias("detail"), "url")


def isolated(*branches: Callable[[], DataFrame]) -> tuple[DataFrame | None, list[Exception]]:
    """The union by name of the branches that can be built; the others' errors are returned."""
    built, failed = [], []
    for b in branches:
        try:
            built.append(b())
        except Exception as e:  # noqa: BLE001  one feed's failure must not take the others
            failed.append(e)
    out = built[0] if built else None
    for df in built[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out, failed


def type_filter(df: DataFrame, column: str, wanted: list[str]) -> DataFrame:
    """Rows whose type has any of the wanted words in it, in any case; an empty list keeps all, a null type nothing."""
    if not wanted:
        return df
    words = F.array(*(F.lit(w.lower()) for w in wanted))
    return df.where(F.coalesce(F.exists(words, lambda w: F.contains(F.lower(strip(F.col(column))), w)), F.lit(False)))
