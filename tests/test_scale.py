"""Numbering, pointers and resolution at sizes where partitions, chains and plans matter."""

import random
import time

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import entities as E
from ledgerflow.operators.storage import roots
from ledgerflow.operators.upsert import upsert, with_ids
from ledgerflow.plans import tables


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_million_new_keys(spark, adaptive):
    was = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        n = 1_000_000
        new = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.col("id").alias("_ord"))
        old = spark.createDataFrame([(5, 41), (7919, 40)], "k long, id long")
        got = with_ids(old, new, ["k"], "id")
        s = got.agg(F.count("id").alias("n"), F.countDistinct("id").alias("d"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
        assert (s["n"], s["d"], s["lo"], s["hi"]) == (n, n, 40, 41 + n - 2)
        first = got.where("id > 41").orderBy("id").limit(3).collect()
        assert [(r["_ord"], r["id"]) for r in first] == [(0, 42), (2, 43), (3, 44)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", was)


def test_ids_of_null_keys_and_none(spark):
    new = spark.createDataFrame([(None, 1), ("a", 2), ("a", 1)], "k string, _ord long")
    assert sorted((r["k"] or "", r["id"]) for r in with_ids(new.limit(0).selectExpr("k", "_ord as id"), new, ["k"], "id").collect()) == [("", None), ("a", 1), ("a", 1)]
    assert with_ids(new.limit(0).selectExpr("k", "_ord as id"), new.limit(0), ["k"], "id").count() == 0


def test_rows_without_a_key_stay(spark):
    new = spark.createDataFrame([(None, 1, "n", 3), (None, 1, "n", 3), (None, 2, "n", 3), ("a", 1, "n", 3)], "k string, v int, w string, _ord int")
    got = upsert(new.limit(0).drop("_ord"), new, ["k"])
    assert sorted((r["k"] or "", r["v"]) for r in got.collect()) == [("", 1), ("", 1), ("", 2), ("a", 1)]


def test_roots_of_long_chains(spark):
    n = 20_000
    chain = spark.range(n).select(F.col("id").alias("node"), F.when(F.col("id") % n > 0, F.col("id") - 1).alias("parent"))
    assert roots(chain).groupBy("root").count().collect()[0] == (0, n)
    circle = spark.createDataFrame([(1, 2), (2, 1)], "node long, parent long")
    with pytest.raises(RuntimeError):
        roots(circle, 8)


def test_a_component_of_many_records(spark):
    """Every record shares an identifier with the one before it; one company takes a third of all."""
    n = 200_000
    k = F.col("id")
    hot = k % 3 == 0
    rows = spark.range(n).select(
        F.lit("US").alias("market"), F.concat(F.lit("S"), k.cast("string")).alias("symbol"), F.concat(F.lit("Name "), k.cast("string")).alias("name"),
        F.when(hot, "L0").otherwise(F.concat(F.lit("L"), (k - k % 2).cast("string"))).alias("lei"), F.concat(F.lit("I"), ((k + 1) / 2).cast("long").cast("string")).alias("isin"), k.alias("_ord"),
    )
    empty = tables.create(spark, ["companies", "identifier_xref", "securities"])
    began = time.perf_counter()
    got, companies, _ = E.resolve(rows, empty["companies"], empty["identifier_xref"], empty["securities"])
    made = {r["_ord"]: r["company_id"] for r in got.collect()}
    assert time.perf_counter() - began < 240
    assert len(made) == n and None not in made.values() and max(made.values()) == len(set(made.values())) == companies.count()
    lei, isin, want, top = {}, {}, {}, 0
    for i in range(n):
        a, b = ("L0" if i % 3 == 0 else f"L{i - i % 2}"), f"I{(i + 1) // 2}"
        if (c := lei.get(a, isin.get(b))) is None:
            c = top = top + 1
        want[i] = c
        lei.setdefault(a, c)
        isin.setdefault(b, c)
    assert made == want


def test_links_chain_over_groups(spark):
    """Each group begins with the listing that the group before it ended with, so all take the first one's company."""
    n = 500
    members = [(f"g{i:04d}", "US", s, 2 * i + j) for i in range(n) for j, s in enumerate((f"S{i}", f"S{i + 1}"))]
    sec = spark.range(n + 1).select(F.col("id").alias("security_id"), F.lit("US").alias("market"), F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"), (F.col("id") + 10).alias("company_id"))
    rows = E.overrides_of(spark.createDataFrame(members, "group string, market string, symbol string, _ord long"))
    moved, _, links = E.apply_overrides(rows, sec, spark.createDataFrame([], "id_type string, id_value string, company_id long"))
    assert {r["company_id"] for r in moved.collect()} == {10} and links.count() == n + 1


def test_random_links_as_a_fold(spark):
    r = random.Random(7)
    members = [(f"g{r.randrange(40)}", "US", f"S{r.randrange(60)}", i) for i in range(150)]
    sec = {f"S{i}": i for i in range(50)}
    df = spark.createDataFrame([(i, "US", s, c) for i, (s, c) in enumerate(sec.items())], "security_id long, market string, symbol string, company_id long")
    moved, _, _ = E.apply_overrides(E.overrides_of(spark.createDataFrame(members, "group string, market string, symbol string, _ord long")), df, spark.createDataFrame([], "id_type string, id_value string, company_id long"))
    groups = {}
    for g, _, s, _ in members:
        groups.setdefault(g, []).append(s)
    for own in groups.values():
        if there := [s for s in own if s in sec]:
            sec |= dict.fromkeys(there, sec[there[0]])
    assert {x["symbol"]: x["company_id"] for x in moved.collect()} == sec
