"""Landed JSON payloads as tidy rows. Every parser takes a DataFrame with a ``payload`` column."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import epoch_date, statement_type
from .landing import market_currency

#: Annual and quarterly forms whose facts count.
FORMS = ("10-K", "10-Q", "20-F", "40-F")
_POINT = "start string, `end` string, val double, fy int, fp string, form string, filed string, frame string"


def chart_prices(df: DataFrame) -> DataFrame:
    """Daily prices of chart payloads by symbol, in the payload's currency or else the market's; days without a close go."""
    quote = ", ".join(f"{c}: array<double>" for c in ("open", "high", "low", "close")) + ", volume: array<bigint>"
    schema = f"struct<chart: struct<result: array<struct<meta: struct<currency: string>, timestamp: array<bigint>, indicators: struct<quote: array<struct<{quote}>>, adjclose: array<struct<adjclose: array<double>>>>>>>>"
    r = df.select("market", "symbol", F.explode(F.from_json("payload", schema)["chart"]["result"]).alias("r"))
    q, none = F.col("r.indicators.quote")[0], F.array().cast("array<double>")
    columns = [F.col("r.timestamp").alias("t"), *(F.coalesce(q[c], none).alias(c) for c in ("open", "high", "low", "close")), F.coalesce(q["volume"], none.cast("array<bigint>")).alias("volume"), F.coalesce(F.get("r.indicators.adjclose", F.lit(0))["adjclose"], none).alias("adj_close")]
    z = r.select("market", "symbol", F.coalesce("r.meta.currency", market_currency(F.col("market"))).alias("currency"), F.explode(F.arrays_zip(*columns)).alias("z"))
    number = lambda c: F.when(~F.isnan(f"z.{c}"), F.col(f"z.{c}")).alias(c)
    rows = z.select("market", "symbol", epoch_date(F.col("z.t")).alias("trade_date"), *map(number, ("open", "high", "low", "close", "adj_close")), F.col("z.volume").alias("volume"), "currency")
    return rows.where("close is not null")


def company_facts(df: DataFrame, since: int | None = None) -> DataFrame:
    """One best point per (year, period, statement, account, unit): framed first, then last filed, then last ended."""
    keep = [c for c in df.columns if c != "payload"]
    facts = df.select(*keep, F.from_json("payload", f"struct<facts:map<string,map<string,struct<units:map<string,array<struct<{_POINT.replace(' string', ':string').replace(' double', ':double').replace(' int', ':int')}>>>>>>>")["facts"].alias("f"))
    rows = facts.select(*keep, F.explode("f").alias("taxonomy", "concepts")).where(F.col("taxonomy").isin("us-gaap", "ifrs-full"))
    rows = rows.select(*keep, "taxonomy", F.explode("concepts").alias("account", "c")).select(*keep, "taxonomy", "account", F.explode("c.units").alias("unit", "points")).select(*keep, "taxonomy", "account", "unit", F.posexplode("points").alias("ord", "p"))
    rows = rows.where(F.col("p.form").isin(*FORMS) & F.col("p.fy").isNotNull())
    if since is not None:
        rows = rows.where(F.col("p.fy") >= since)
    rows = rows.select(*keep, "taxonomy", "account", "unit", "ord", F.col("p.fy").alias("fiscal_year"), F.col("p.fp").alias("fiscal_period"), F.col("p.form").alias("form"), F.col("p.end").alias("period_end"), F.col("p.val").alias("value"), F.col("p.filed").alias("filed"), F.col("p.frame").isNotNull().alias("framed"), statement_type(F.col("account"), F.col("p.start").isNotNull()).alias("statement_type"))
    key = [*keep, "fiscal_year", "fiscal_period", "statement_type", "account", "unit"]
    rest = [c for c in rows.columns if c not in key]
    order = F.struct("framed", F.coalesce("filed", F.lit("")), F.coalesce("period_end", F.lit("")), -F.col("ord"))
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("b")).select(*key, "b.*").drop("ord", "framed")


def corporate_actions(df: DataFrame) -> DataFrame:
    """Dividends and splits by symbol; a split without both parts, or with a zero, has no ratio."""
    keep = [c for c in df.columns if c != "payload"]
    side = lambda path, fields: df.select(*keep, F.explode(F.map_values(F.from_json(F.get_json_object("payload", path), f"map<string, struct<{fields}>>"))).alias("x"))
    row = lambda rows, kind, value: rows.select(*keep, epoch_date(F.col("x.date")).alias("ex_date"), F.lit(kind).alias("action_type"), value.alias("value"))
    ratio = F.nullif(F.col("x.numerator"), F.lit(0.0)) / F.nullif(F.col("x.denominator"), F.lit(0.0))
    return row(side("$.dividends", "date: bigint, amount: double"), "dividend", F.col("x.amount")).unionByName(row(side("$.splits", "date: bigint, numerator: double, denominator: double"), "split", ratio))
