"""A corpus pipeline of five stages; each works on all rows its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.decontaminate import with_leaks
from ledgerflow.llm.line_dedup import kept_text, with_bitmaps
from ledgerflow.llm.near_join import near_components
from ledgerflow.llm.quality_classifier import THRESHOLD, with_quality
from ledgerflow.llm.queries import table, tokenizer_file
from ledgerflow.llm.sentencepieces import encode
from ledgerflow.llm.shared import attach, discard, folded, kept, row_key, saved, scratch, unfolded


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    own = ["doc_id", "text", "source"]
    scored = with_quality(folded(docs, own), table(spark, sf_dir, "labels"))
    return unfolded(scored.where(F.col("quality_score") >= THRESHOLD), docs.columns, own)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share, and with n_chars of what is left; what keeps no text goes."""
    own = ["doc_id", "text", "n_chars"]
    rows = with_bitmaps(folded(docs, own))
    text = F.when(F.col("kept").isNull(), F.col("text")).otherwise(kept_text())
    out = rows.withColumn("text", text).where("n_dropped is null or text <> ''")
    out = out.withColumn("n_chars", F.when(F.col("n_dropped").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long")))
    return unfolded(out, docs.columns, own)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the smallest id, and of its rows with one text one. Rows without an id or without words stay."""
    members, labels = near_components(docs)
    out = members.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("doc_id", F.coalesce("label", "rep").alias("first"))
    copies = saved(out.where("doc_id <> first").select("doc_id").distinct(), "copies")
    again = saved(members.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.max("n").alias("n")).where("rows > 1 and n > 0").select("doc_id"), "repeated")
    one = attach(docs, copies, ["doc_id"], "left_anti", 24).select(docs.columns)
    many = attach(one, again, ["doc_id"], "left_semi", 24).select(docs.columns)
    nth = F.row_number().over(Window.partitionBy("doc_id", row_key()).orderBy(F.xxhash64(*docs.columns)))
    return attach(one, again, ["doc_id"], "left_anti", 24).select(docs.columns).unionByName(many.withColumn("_nth", nth).where("_nth = 1").drop("_nth"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    own = ["doc_id", "text"]
    clean = with_leaks(folded(docs, own), table(spark, sf_dir, "benchmark")).where("item_ids is null")
    return unfolded(clean, docs.columns, own)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of each document."""
    return encode(docs, tokenizer_file("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("SentencePiece encoding", pieces),
]
#: Not expressible in SQL: the classifier, the links and the sampled segmentations.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again; what a stage saved on its way goes once its rows are written."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        with scratch(spark):
            rows = stage(spark, docs, sf_dir)
            with kept():
                docs = saved(rows, "stage-" + name.split()[0].lower())
        discard(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
