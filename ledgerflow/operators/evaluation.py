"""Scores of extraction cases against gold tables and paragraphs, and their roll-up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import squeeze
from .metrics import grits_column, numeric_f1, teds_column

#: The files of a gold case.
DOCUMENT, EXPECTED = "doc.pdf", "expected.json"
MEASURES = ("teds", "grits", "numeric_em", "continuity")


def gold_cases(spark: SparkSession, folder: str) -> DataFrame:
    """name, category, content, paragraphs and gold tables of every subfolder that has both a document and what to expect of it.

    One scan lists both kinds of files, and one grouping by folder pairs them. A case
    without a category is one of its own; one whose expectations cannot be read has none.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    parts = F.split("path", "/")
    files = files.select(F.element_at(parts, -1).alias("file"), F.element_at(parts, -2).alias("name"), F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/").alias("at"), "content").where(F.col("file").isin(DOCUMENT, EXPECTED))
    pairs = files.groupBy("at", "name").agg(*(F.max(F.when(F.col("file") == f, F.struct("content"))).alias(c) for f, c in ((DOCUMENT, "doc"), (EXPECTED, "spec"))))
    spec = F.from_json(F.decode("spec.content", "UTF-8"), "category string, tables array<array<array<string>>>, paragraphs array<string>")
    rows = pairs.where("doc is not null and spec is not null").withColumn("s", spec)
    return rows.select("name", F.coalesce("s.category", "name").alias("category"), F.col("doc.content").alias("content"), F.coalesce("s.paragraphs", F.array().cast("array<string>")).alias("paragraphs"), F.coalesce("s.tables", F.array().cast("array<array<array<string>>>")).alias("gold"))


def read_cases(gold: DataFrame, read: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Gold cases with what an engine reads: ``read`` takes (name, content) and returns (name, text, tables)."""
    found = read(gold.select("name", "content")).select("name", "text", F.col("tables").alias("pred"))
    return gold.drop("content").join(found, "name", "left")


def continuity(text: Column, paragraphs: Column) -> Column:
    """Share of gold paragraphs that lie whole within one paragraph of the text; 1 without any, whatever the wraps and case."""
    flat = lambda c: F.lower(squeeze(c))
    mine = F.transform(F.split(F.coalesce(text, F.lit("")), r"\n[\s\p{Z}]*\n"), flat)
    hits = F.size(F.filter(F.transform(paragraphs, flat), lambda g: F.exists(mine, lambda p: F.contains(p, g))))
    return F.when(F.coalesce(F.size(paragraphs), F.lit(0)) <= 0, F.lit(1.0)).otherwise(hits / F.size(paragraphs))


def best_matches(cases: DataFrame) -> DataFrame:
    """For each gold table of a case (name, pred, gold) the predicted one of the highest tree similarity, the first of equals, and its scores.

    Gold tables do not compete; without a prediction an empty grid is scored.
    """
    gold = cases.select("name", "pred", F.posexplode("gold").alias("g", "gold"))
    pairs = gold.select("name", "g", "gold", F.posexplode_outer("pred").alias("p", "pred"))
    pairs = pairs.withColumn("pred", F.coalesce("pred", F.array().cast("array<array<string>>")))
    scored = pairs.withColumn("teds", teds_column("pred", "gold"))
    best = scored.groupBy("name", "g").agg(F.max_by(F.struct("pred", "gold", "teds"), F.struct("teds", -F.coalesce("p", F.lit(0)))).alias("b")).select("name", "g", "b.*")
    return best.withColumns({"grits": grits_column("pred", "gold"), "numeric_em": numeric_f1(F.col("pred"), F.col("gold"))})


def score_cases(cases: DataFrame) -> DataFrame:
    """Scores of each case (name, category, text, paragraphs, pred, gold): null where it has no gold of the kind."""
    tables = best_matches(cases).groupBy("name").agg(*(F.avg(m).alias(m) for m in ("teds", "grits", "numeric_em")))
    text = F.when(F.size("paragraphs") > 0, continuity(F.col("text"), F.col("paragraphs"))).alias("continuity")
    return cases.select("name", "category", text).join(tables, "name", "left").select("name", "category", *MEASURES)


def roll_up(scores: DataFrame) -> DataFrame:
    """Means of the scores by category, and over all cases as category ``overall``; nulls are left out."""
    means = [F.round(F.avg(m), 4).alias(m) for m in MEASURES] + [F.count(F.lit(1)).alias("n_cases")]
    return scores.groupBy("category").agg(*means).unionByName(scores.agg(*means).withColumn("category", F.lit("overall")))
