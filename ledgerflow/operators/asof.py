"""Nearest-prior joins by months.

The right side becomes validity intervals, and an interval one row for each month
it touches, up to the last month with a rate. The left side then meets, by equality
on key and month, only the rates of its own month, whatever the number of days on
record or of rows of one key. The month table is counted: a small one is broadcast
and the left side is not shuffled at all, a larger one is shuffled by key and month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The month table is broadcast up to this many bytes, at so many a row.
BROADCAST_BYTES, ROW_BYTES = 16 << 20, 96


def validity(rates: DataFrame, keys: Sequence[str], date: str, tie: Sequence[str] = ()) -> DataFrame:
    """One row per key and date (ties: the first by ``tie``) with the next date as ``valid_to``."""
    values = [c for c in rates.columns if c not in (*keys, date)]
    order = F.struct(*(F.col(c) for c in (tie or values)))
    once = rates.groupBy(*keys, date).agg(F.min_by(F.struct(*values), order).alias("_v")).select(*keys, date, "_v.*")
    return once.withColumn("valid_to", F.lead(date).over(Window.partitionBy(*keys).orderBy(date)))


def _month(day: Column) -> Column:
    return F.try_to_date(F.concat(F.substring(day, 1, 7), F.lit("-01")))


def asof_join(left: DataFrame, rates: DataFrame, on: Sequence[tuple[str, str]], left_date: Column | str, date: str, value: str, out: str, tie: Sequence[str] = (), broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``left`` with the newest ``value`` at or before its date as ``out``; null before the first, never stale.

    Dates are ISO days as text; other texts match nothing.
    """
    keys = [r for _, r in on]
    rates = rates.where(_month(F.col(date)).isNotNull())
    last, n = rates.agg(F.max(_month(F.col(date))), F.count(F.lit(1))).first()
    spans = validity(rates.select(*keys, date, value, *(t for t in tie if t not in (value, *keys))), keys, date, tie or [value])
    end = F.coalesce(_month(F.col("valid_to")), F.lit(last).cast("date"))
    months = F.explode(F.sequence(_month(F.col(date)), end, F.expr("interval 1 month")))
    spans = spans.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col(date).alias("_from"), F.col("valid_to").alias("_to"), F.col(value).alias(out), months.alias("_month"))
    if (n if n * ROW_BYTES > broadcast_bytes else spans.count()) * ROW_BYTES <= broadcast_bytes:
        spans = F.broadcast(spans)
    when = F.col(left_date) if isinstance(left_date, str) else left_date
    same = [F.col(a) == F.col(f"_k{i}") for i, (a, _) in enumerate(on)]
    own = left.withColumn("_when", when).withColumn("_at", F.least(_month(F.col("_when")), F.lit(last).cast("date")))
    joined = own.join(spans, [*same, F.col("_at") == F.col("_month"), F.col("_from") <= F.col("_when"), F.col("_to").isNull() | (F.col("_when") < F.col("_to"))], "left")
    return joined.drop("_when", "_at", "_month", "_from", "_to", *(f"_k{i}" for i in range(len(keys))))
