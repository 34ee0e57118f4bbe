"""Medians, modes, spans and islands that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_mode(df: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The most frequent value of each group, of equals the one seen first, and its share of the group's rows."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("seen"))
    return counts.groupBy(*keys).agg(F.max_by(F.struct(value, "n"), F.struct("n", -F.col("seen"))).alias("m"), F.sum("n").alias("all")).select(*keys, F.col(f"m.{value}").alias("mode"), (F.col("m.n") / F.col("all")).alias("share"))


def exact_median(c: Column) -> Column:
    return F.median(c)


def span(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """First and last day of each group; of all rows without keys."""
    return df.groupBy(*keys).agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def islands(df: DataFrame, keys: list[str], order: str, flag: Column) -> DataFrame:
    """Stretches of successive rows with the flag: their first and last place and length."""
    w = Window.partitionBy(*keys).orderBy(order)
    rows = df.withColumn("_flag", flag).withColumn("_all", F.row_number().over(w)).where("_flag")
    rows = rows.withColumn("_island", F.col("_all") - F.row_number().over(w))
    return rows.groupBy(*keys, "_island").agg(F.min(order).alias("first_at"), F.max(order).alias("last_at"), F.count(F.lit(1)).alias("length")).drop("_island")


def by_number(names: Column) -> Column:
    """Names in the order of the first number in their last part, then by name: section2 before section10."""
    key = lambda n: F.coalesce(F.regexp_extract(F.element_at(F.split(n, "/"), -1), r"(\d+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.transform(F.array_sort(F.transform(names, lambda n: F.struct(key(n).alias("k"), n.alias("n")))), lambda x: x["n"])


def stable_place(day: str, ordinal: str) -> Column:
    """The place of a row by day, those without one first, then as they came: to sort by, within a group or over all."""
    return F.struct(F.coalesce(F.col(day), F.lit("")).alias("day"), F.col(ordinal).alias(ordinal))


def stable_order(df: DataFrame, day: str, ordinal: str) -> DataFrame:
    return df.orderBy(stable_place(day, ordinal))
