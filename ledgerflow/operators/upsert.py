"""Keyed writes with conflict policies, as a union and one grouped aggregation.

``update`` keeps a row per key with each column by its rule, ``replace`` the last
whole row, ``ignore`` the first. What is written carries an explicit ordinal, never
arrival order; columns with the plain rule are picked together, as one row. A row
with a null in its key matches nothing and is always kept, as often as it is there.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import written

RULES = ("new", "coalesce_new_old", "coalesce_old_new", "keep")


def _column(name: str, rule: str, order: Column) -> Column:
    """The last or first value that is there; a filled value as a struct, so that order alone decides."""
    there = F.when(F.col(name).isNotNull(), order)
    pick = F.max_by if rule == "coalesce_new_old" else F.min_by
    return pick(F.struct(F.col(name).alias("v")), there)["v"].alias(name)


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], policy: str = "update", rules: dict[str, str] | None = None, ordinal: str = "_ord") -> DataFrame:
    """``new`` written into ``old``, a table with one row per key, in the order of ``ordinal``, which ``new`` must have."""
    if policy not in ("update", "replace", "ignore") or set((rules or {}).values()) - set(RULES):
        raise ValueError(f"{policy} {rules}")
    if ordinal not in new.columns:
        raise ValueError(f"the rows to write need their order as column {ordinal!r}")

    def side(df: DataFrame, k: int) -> DataFrame:
        at = F.col(ordinal).cast("long") if ordinal in df.columns else F.monotonically_increasing_id()
        return df.withColumn("_at", F.struct(F.lit(k).alias("side"), at.alias("ord"))).drop(ordinal)

    rows = side(old, 0).unionByName(side(new, 1))
    values = [c for c in rows.columns if c not in (*keys, "_at")]
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    # rows without a whole key are groups of their own, equal ones counted: one pass serves both kinds
    rows = rows.withColumn("_solo", F.when(~whole, F.struct("_at", *values)))
    rules = {c: (rules or {}).get(c, "new") for c in values} if policy == "update" else dict.fromkeys(values, "new" if policy == "replace" else "keep")
    last, first = ([c for c in values if rules[c] == r] for r in ("new", "keep"))
    agg = [_column(c, r, F.col("_at")) for c, r in rules.items() if r.startswith("coalesce")]
    agg += [pick(F.struct(F.lit(0).alias("_"), *names), F.col("_at")).alias(name) for pick, names, name in ((F.max_by, last, "_last"), (F.min_by, first, "_first")) if names]
    out = rows.groupBy(*keys, "_solo").agg(*agg, F.count(F.lit(1)).alias("_n"))
    out = out.withColumn("_n", F.explode(F.array_repeat(F.lit(0), F.when(F.col("_solo").isNull(), 1).otherwise(F.col("_n")).cast("int"))))
    return out.select(*keys, *((F.col(f"_last.{c}") if c in last else F.col(f"_first.{c}") if c in first else F.col(c)).alias(c) for c in values)).select([c for c in rows.columns if c not in ("_at", "_solo")])


def replace_partition(old: DataFrame, new: DataFrame, prefix: Sequence[str]) -> DataFrame:
    """Rows of ``old`` whose prefix ``new`` also has give way to ``new``."""
    return old.join(new.select(*prefix).distinct(), list(prefix), "left_anti").unionByName(new)


def with_ids(old: DataFrame, new: DataFrame, keys: Sequence[str], id_column: str, ordinal: str = "_ord") -> DataFrame:
    """``new`` with the id its key has in ``old``, or the next free ones in the order of first appearance; a null in a key gets none.

    Only the distinct new keys are numbered. They are sorted in range partitions and written
    once: ranges are drawn from samples, so two plans of them would not agree. From
    the written rows come both the sizes of the partitions and the places within.
    """
    known = old.select(*keys, F.col(id_column).alias("_known")).dropDuplicates(list(keys))
    joined = new.join(known, list(keys), "left")
    whole = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    fresh = joined.where(F.col("_known").isNull() & whole).groupBy(*keys).agg(F.min(ordinal).alias("_first"))
    ranged = fresh.repartitionByRange("_first", *keys).sortWithinPartitions("_first", *keys).withColumn("_m", F.monotonically_increasing_id())
    ranged = written(ranged.select(*keys, F.shiftright("_m", 33).alias("_part"), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row")), "new-keys")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # a row for each partition, not for each key
    offsets = sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_part", "_offset")
    top = old.agg(F.coalesce(F.max(id_column), F.lit(0)).cast("long").alias("_top"))
    numbered = ranged.join(F.broadcast(offsets), "_part").join(F.broadcast(top)).select(*keys, (F.col("_top") + F.col("_offset") + F.col("_row") + 1).alias("_new"))
    return joined.join(numbered, list(keys), "left").withColumn(id_column, F.coalesce("_known", "_new").cast("long")).drop("_known", "_new")
