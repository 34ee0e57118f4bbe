"""Landed JSON as rows. A landed table has a ``payload`` column of JSON text and columns that say what was asked for.

Parsers keep to one shape: a malformed payload gives no rows, an absent field a
null, and every number is cast with try_cast, since feeds mix text and numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The trading currency of each market.
MARKET_CURRENCY = {"KR": "KRW", "HK": "HKD", "US": "USD"}


def market_currency(market: Column) -> Column:
    """The market's currency; dollars for others."""
    known = F.create_map(*(F.lit(x) for kv in MARKET_CURRENCY.items() for x in kv))
    return F.coalesce(F.try_element_at(known, F.upper(market)), F.lit("USD"))


def items(payload: Column, *paths: str) -> Column:
    """The elements, as JSON text, of the first of ``paths`` that holds a list; of a single object there one element."""
    found = []
    for path in paths:
        text = payload if path == "$" else F.get_json_object(payload, path)
        listed, single = F.trim(text).startswith("["), F.trim(text).startswith("{")
        found.append(F.when(listed, F.from_json(text, "array<string>")))
        if path != "$":
            found.append(F.when(single, F.array(text)))
    return F.filter(F.coalesce(*found), lambda x: F.trim(x).startswith("{"))


def records(df: DataFrame, keep: Sequence[str], fields: Sequence[str], *paths: str) -> DataFrame:
    """A row for each element: the ``keep`` columns, its ``ord`` and its ``fields`` as text."""
    schema = ", ".join(f"`{f}` string" for f in fields)
    rows = df.select(*keep, F.posexplode(items(F.col("payload"), *(paths or ("$",)))).alias("ord", "item"))
    return rows.select(*keep, "ord", "item", F.from_json("item", schema).alias("r")).select(*keep, "ord", "item", "r.*")


def listed_fields(df: DataFrame, keep: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """The ``keep`` columns and, as ``r``, the ``fields`` as text of each object of payloads that are lists; without ``ord`` and ``item`` a list is parsed once.

    A list that holds anything else goes item by item. The outer explode, whose empty row goes, keeps Spark from parsing again for a filter on the size.
    """
    schema = ", ".join(f"`{f}` string" for f in fields)
    read = df.select(*keep, "payload", F.when(F.trim("payload").startswith("["), F.from_json("payload", f"array<struct<{schema}>>")).alias("_read"))
    each = F.transform(items(F.col("payload"), "$"), lambda x: F.from_json(x, schema))
    return read.select(*keep, F.explode_outer(F.when(F.forall("_read", lambda x: x.isNotNull()), F.col("_read")).otherwise(each)).alias("r")).where("r is not null")


def number(c: Column | str) -> Column:
    """A finite or infinite number; blanks, dashes and NaN are null."""
    x = (F.col(f"`{c}`") if isinstance(c, str) else c).try_cast("double")
    return F.nanvl(x, F.lit(None).cast("double"))


def whole(c: Column | str) -> Column:
    return F.floor(number(c)).cast("bigint") if isinstance(c, str) else F.floor(number(c)).cast("bigint")


def numeric_fields(df: DataFrame, keep: Sequence[str], skip: Sequence[str]) -> DataFrame:
    """Every numeric or boolean field of the JSON object ``item`` that is not in ``skip``, as (account, value) rows."""
    fields = F.try_variant_get(F.try_parse_json("item"), "$", "map<string, variant>")
    rows = df.select(*keep, F.explode(fields).alias("account", "v")).where(~F.col("account").isin(*skip))
    kind = F.schema_of_variant("v")
    rows = rows.where(kind.isin("BIGINT", "DOUBLE", "BOOLEAN", "FLOAT") | kind.startswith("DECIMAL"))
    truth = F.try_variant_get("v", "$", "boolean")
    return rows.select(*keep, "account", F.when(kind == "BOOLEAN", truth.cast("int").cast("double")).otherwise(F.try_variant_get("v", "$", "double")).alias("value"))


def in_range(day: Column, start: str | None, end: str | None) -> Column:
    """Within the bounds, both included; what has no day stays."""
    out = F.lit(True)
    if start is not None:
        out = out & (day >= start)
    if end is not None:
        out = out & (day <= end)
    return day.isNull() | out
