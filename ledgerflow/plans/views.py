"""Views over the relational tables: latest prices, company overview, financials in USD, averages, comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import window_start, year_end
from ..operators.asof import asof_join


def latest_rows(df: DataFrame, key: str, date: str) -> DataFrame:
    """All rows of each key's last date: ties stay."""
    last = df.groupBy(key).agg(F.max(date).alias(date))
    return df.join(last, [key, date])


def to_usd(df: DataFrame, fx: DataFrame, amount: str, out: str, date: str = "trade_date") -> DataFrame:
    """``amount`` in USD at the nearest prior spot rate; a null currency has no USD value."""
    spot = fx.where("quote_ccy = 'USD' AND rate_type = 'spot'")
    rated = asof_join(df, spot, [("currency", "base_ccy")], date, "rate_date", "rate", "_rate", ["source"])
    return rated.withColumn(out, F.when(F.col("currency") == "USD", F.col(amount)).otherwise(F.col(amount) * F.col("_rate"))).drop("_rate")


def latest_price(securities: DataFrame, prices: DataFrame, fx: DataFrame) -> DataFrame:
    last = to_usd(latest_rows(prices, "security_id", "trade_date"), fx, "close", "close_usd")
    return securities.drop("currency").join(last, "security_id").withColumnRenamed("close", "close_local")


def company_overview(companies: DataFrame, securities: DataFrame) -> DataFrame:
    item = F.concat(F.col("market"), F.lit(":"), F.col("symbol"), F.lit("("), F.coalesce("security_type", F.lit("?")), F.lit(")"))
    listed = securities.select("company_id", F.struct("market", "symbol", item.alias("item")).alias("s")).groupBy("company_id").agg(F.sort_array(F.collect_list("s")).alias("s"))
    listed = listed.select("company_id", F.array_join(F.transform("s", lambda x: x["item"]), ",").alias("listings"))
    return companies.join(listed, "company_id", "left")


def financials_usd(financials: DataFrame, fx: DataFrame) -> DataFrame:
    """Flows at average rates, everything else at spot; undated rows at their year's end."""
    usd = fx.where("quote_ccy = 'USD'")
    keyed = financials.withColumns({"_type": F.when(F.coalesce("statement_type", F.lit("")).isin("IS", "CF"), "avg").otherwise("spot"), "_date": F.coalesce("period_end", year_end(F.col("fiscal_year")))})
    rated = asof_join(keyed, usd, [("currency", "base_ccy"), ("_type", "rate_type")], "_date", "rate_date", "rate", "_rate", ["source"])
    return rated.withColumn("value_usd", F.when(F.col("currency") == "USD", F.col("value")).otherwise(F.col("value") * F.col("_rate"))).drop("_rate", "_type", "_date")


def period_average_fx(financials: DataFrame, fx: DataFrame) -> DataFrame:
    """Mean spot rate of each currency over each reporting period that occurs; of periods that end alike the longest counts."""
    periods = financials.where("currency IS NOT NULL AND currency <> 'USD'").select(F.col("currency").alias("base_ccy"), "fiscal_period", F.coalesce("period_end", year_end(F.col("fiscal_year"))).alias("period_end")).distinct()
    periods = periods.withColumn("start", window_start(F.col("fiscal_period"), F.col("period_end")))
    periods = periods.groupBy("base_ccy", "period_end").agg(F.min("start").alias("start"))
    spot = fx.where("quote_ccy = 'USD' AND rate_type = 'spot'").groupBy("base_ccy", "rate_date").agg(F.min_by("rate", "source").alias("rate"))
    # running sums make the range average two nearest-prior lookups instead of one row per day and period
    w = Window.partitionBy("base_ccy").orderBy("rate_date")
    run = spot.select("base_ccy", "rate_date", F.struct(F.sum("rate").over(w).alias("s"), F.count("rate").over(w).alias("n")).alias("run"))
    upto = asof_join(periods, run, [("base_ccy", "base_ccy")], "period_end", "rate_date", "run", "hi")
    before = asof_join(upto, run, [("base_ccy", "base_ccy")], F.date_format(F.date_sub(F.to_date("start"), 1), "yyyy-MM-dd"), "rate_date", "run", "lo")
    total, n = F.col("hi.s") - F.coalesce("lo.s", F.lit(0.0)), F.col("hi.n") - F.coalesce("lo.n", F.lit(0))
    return before.where(n > 0).select(F.col("period_end").alias("rate_date"), "base_ccy", F.lit("USD").alias("quote_ccy"), F.lit("avg").alias("rate_type"), (total / n).alias("rate"))


def latest_metric(financials: DataFrame, accounts: list[str], out: str) -> DataFrame:
    """The newest consolidated annual value of any of ``accounts`` per company; of one year the account that comes first in the list."""
    rows = financials.where((F.col("fiscal_period") == "FY") & (F.col("fs_scope") == "CFS") & F.col("value").isNotNull() & F.col("account").isin(accounts))
    place = F.array_position(F.array(*map(F.lit, accounts)), F.col("account"))
    order = F.struct(F.col("fiscal_year"), (-place).alias("a"), F.col("statement_type"), F.col("value"))
    return rows.groupBy("company_id").agg(F.max_by("value", order).alias(out))


def pending_filings(filings: DataFrame, documents: DataFrame, securities: DataFrame) -> DataFrame:
    """Filings of listed companies with fewer documents than URLs (one at least)."""
    keys = ["company_id", "filing_id", "source"]
    have = documents.groupBy(*keys).agg(F.count(F.lit(1)).alias("have"))
    rows = filings.join(have, keys, "left").where(F.coalesce("have", F.lit(0)) < F.greatest(F.lit(1), F.col("n_urls")))
    return rows.join(securities.select("company_id"), "company_id", "left_semi")


def bucketed(df: DataFrame, path: str, keys: list[str], buckets: int = 64) -> DataFrame:
    """``df`` as a table bucketed and sorted by ``keys`` under ``path``: joins by them need not shuffle it again."""
    spark = df.sparkSession
    name = "bucketed_" + path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_")
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return spark.table(name)


def missing_documents(filings: DataFrame, documents: DataFrame, keys: list[str]) -> DataFrame:
    """The document numbers of ``filings`` (keys, seqs) that ``documents`` has not.

    With documents bucketed by keys and doc_seq only the filings asked for are shuffled, to the documents' buckets.
    """
    wanted = filings.select(*keys, F.explode(F.col("seqs").cast("array<int>")).alias("doc_seq"))
    return wanted.join(documents.hint("merge"), [*keys, "doc_seq"], "left_anti")
