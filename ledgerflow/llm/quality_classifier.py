"""Quality classifier whose documents borrow strength from their sites.

A logistic model over text statistics gives each document its own evidence p.
Grouped aggregation sums the evidence of all documents by host and by path of a
host; each path's mean is shrunk to its host's, and each host's to the global
mean, by priors fitted to how much the groups differ, so that sparse sites stay
near the prior. A document's quality adds to the log odds of p those of its
site, itself left out, over the global ones; below ``threshold`` it is rejected.

The model is fitted on a documented sample: the SAMPLE_ROWS labels whose ids have
the smallest hashes, and at most twice as many documents by the hash of id and
text, should ids repeat; everything else covers all rows. Without labels of both kinds
p is the labels' mean, or 1 without labels. A site value is a host, or a URL whose first path
segment is the path. A null site is a site of its own. Null and empty texts have
statistics of 0. Repeated rows count each, and get equal scores. Empty tables give
no rows. ``with_quality`` passes other columns through; names that clash with its
own are the caller's to fold away, as the pipeline does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality_rules import base_counts, host_of
from .shared import BLANKS, Spans, attach, per_row, records, repeated, saved, slices, small_batches, texts, tidy, words

SAMPLE_ROWS = 20_000
THRESHOLD = 0.5
MAX_WEIGHT = 1e6


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER, _DIGIT, _MARK, _BAR, _STOP = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _class("0123456789"), _class("!?"), _class("|"), _class(".,;:")
_LETTER = _class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LETTER[128:] = True


def features(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Text statistics of each row."""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat = base_counts(raw, at)
    start, end, row = words(raw, at)
    _, again = repeated(Spans(raw, fold=True)(start, end), row)
    many, letters = np.maximum(n_words, 1), np.maximum(per_row(_LETTER[raw], at), 1)
    solid = np.maximum(per_row(~BLANKS[raw], at), 1)
    share = lambda table, over: per_row(table[raw], at) / over
    return np.column_stack([
        np.log1p(n_words), n_symbols / solid, np.sqrt(n_symbols / solid), share(_UPPER, letters), share(_MARK, many), share(_BAR, many), share(_DIGIT, solid), share(_STOP, many),
        np.bincount(row[again], minlength=len(n_words)) / many, n_repeat / many, n_dup_lines / np.maximum(per_row(raw == 10, at) + 1, 1), np.minimum(word_chars / many, 50),
    ])


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights[1:] + self.weights[0]
        return 1 / (1 + np.exp(-np.clip(z, -12, 12)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Logistic:
    """Ridge logistic regression by Newton's method on squares and values of standardised features."""
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    z = np.column_stack([np.ones(len(x)), np.clip((x - mean) / scale, -8, 8)])
    w = np.zeros(z.shape[1])
    penalty = np.r_[1e-3, np.full(x.shape[1], ridge)]
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty), z.T @ (y - p) - penalty * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Logistic(mean, scale, w)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = texts(batch.column("text"))
        for lo, hi in slices(at):
            x = features(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
            yield records(quality=batch.column("quality")[lo:hi], o=batch.column("o")[lo:hi], x=pa.array(x.tolist(), pa.list_(pa.float64())))


def _scored(batches: Iterator[pa.RecordBatch], model: Broadcast, names: list[str]) -> Iterator[pa.RecordBatch]:
    """The columns ``names`` of the batches, the last of which is the evidence."""
    logistic: Logistic = model.value
    for batch in batches:
        raw, at = texts(batch.column("text"))
        p = np.empty(len(at) - 1)
        for lo, hi in slices(at):
            p[lo:hi] = logistic(features(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]))
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(p)], names)


def learn(docs: DataFrame, labels: DataFrame) -> Logistic:
    rows = labels.where("quality is not null and doc_id is not null").select("doc_id", F.col("quality").cast("double").alias("quality"))
    order = [F.xxhash64("doc_id").alias("o"), "doc_id", "quality"]
    part = F.xxhash64("doc_id") / float(1 << 63) <= 2.0 * (1.25 * SAMPLE_ROWS / max(rows.count(), 1)) - 1.0
    sample = rows.where(part).select(*order).orderBy("o", "doc_id", "quality").limit(SAMPLE_ROWS)
    found = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "quality", F.xxhash64("doc_id", "text").alias("o"))
    found = found.mapInArrow(_statistics, "quality double, o long, x array<double>").orderBy("o", "quality").limit(2 * SAMPLE_ROWS).toArrow()
    y = found.column("quality").to_numpy()
    if len(np.unique(y > 0.5)) < 2:
        width = features(np.zeros(0, np.uint8), np.zeros(2, np.int64)).shape[1]
        p = np.clip(y.mean(), 1e-5, 1 - 1e-5) if len(y) else 1 - 1e-5
        return Logistic(np.zeros(width), np.ones(width), np.r_[np.log(p / (1 - p)), np.zeros(width)])
    x = np.array(found.column("x").to_pylist(), float)
    order = np.lexsort([*x.T, y])
    return fit_logistic(x[order], y[order])


def path_of(site: Column) -> Column:
    return F.regexp_extract(F.coalesce(site, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?[^/?#]*/([^/?#]*)/", 1)


def scored(docs: DataFrame, model: Broadcast, site: str, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` with the document's own evidence ``_p`` and its ``_host`` and ``_path``."""
    keyed = docs.withColumns({"_host": host_of(F.col(site)), "_path": path_of(F.col(site)), "text": F.col("text").cast("string")})
    schema = T.StructType([*(keyed.schema[c] for c in (*keep, "_host", "_path")), T.StructField("_p", T.DoubleType())])
    names = schema.names
    return keyed.mapInArrow(lambda batches: tidy(_scored(batches, model, names)), schema)


def _weight(squares: Column, mean: Column, n: Column, n2: Column, groups: Column) -> Column:
    """How many documents the prior counts as, from the squares between groups (moments)."""
    chance = mean * (1 - mean)
    spread = F.try_divide(squares - groups * chance, n - n2 - groups)
    return F.when(spread > 0, F.least(F.greatest(chance / spread - 1, F.lit(1.0)), F.lit(MAX_WEIGHT))).otherwise(F.lit(MAX_WEIGHT))


def site_table(evidence: DataFrame) -> DataFrame:
    """_host, _path, the path's and host's counts and sums, and the global mean and both weights."""
    paths = evidence.groupBy("_host", "_path").agg(F.count(F.lit(1)).alias("path_n"), F.sum("_p").alias("path_sum"))
    paths = saved(paths, "site-paths")
    hosts = paths.groupBy("_host").agg(F.sum("path_n").alias("host_n"), F.sum("path_sum").alias("host_sum"), F.count(F.lit(1)).alias("n_paths"), F.sum(F.col("path_n").cast("double") ** 2).alias("path_n2"), F.sum(F.col("path_sum") ** 2 / F.col("path_n")).alias("path_k2"))
    hosts = saved(hosts, "site-hosts")
    sums = hosts.agg(
        F.sum("host_n").alias("n"), F.sum("host_sum").alias("k"), F.count(F.lit(1)).alias("hosts"), F.sum(F.col("host_n").cast("double") ** 2).alias("host_n2"), F.sum(F.col("host_sum") ** 2 / F.col("host_n")).alias("host_k2"),
        F.sum("n_paths").alias("paths"), F.sum("path_k2").alias("path_k2"), F.sum(F.col("path_n2") / F.col("host_n")).alias("path_n2"),
    ).where("n > 0")
    mean = F.col("k") / F.col("n")
    priors = sums.select(
        mean.alias("mean"),
        _weight(F.col("host_k2") - F.col("k") * mean, mean, F.col("n"), F.try_divide(F.col("host_n2"), F.col("n")), F.col("hosts") - 1).alias("host_weight"),
        _weight(F.col("path_k2") - F.col("host_k2"), mean, F.col("n"), F.col("path_n2"), F.col("paths") - F.col("hosts")).alias("path_weight"),
    )
    return attach(paths, hosts.select("_host", "host_n", "host_sum"), ["_host"], "inner", 64).join(F.broadcast(priors))


def with_quality(docs: DataFrame, labels: DataFrame, site: str = "source", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``docs`` (all) with p_doc, p_site and quality_score. Texts are scored once and the rows written with their evidence."""
    spark = docs.sparkSession
    small_batches(spark)
    keep = keep or docs.columns
    model = spark.sparkContext.broadcast(learn(docs, labels))
    rows = saved(scored(docs, model, site, keep), "evidence")
    sites = saved(site_table(rows.select("_host", "_path", "_p")), "sites")
    rows = attach(rows, sites, ["_host", "_path"], "left", 128)
    host = (F.col("host_sum") - F.col("_p") + F.col("host_weight") * F.col("mean")) / (F.col("host_n") - 1 + F.col("host_weight"))
    path = (F.col("path_sum") - F.col("_p") + F.col("path_weight") * host) / (F.col("path_n") - 1 + F.col("path_weight"))
    odds = lambda p: F.ln(F.greatest(p, F.lit(1e-6)) / F.greatest(1 - p, F.lit(1e-6)))
    both = odds(F.col("_p")) + odds(path) - odds(F.col("mean"))
    return rows.select(*keep, F.col("_p").alias("p_doc"), path.alias("p_site"), (1 / (1 + F.exp(-both))).alias("quality_score"))


def quality_classifier(docs: DataFrame, labels: DataFrame, site: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the site, p_doc, p_site, quality_score and kept of every document."""
    rows = with_quality(docs.select(F.col("doc_id").cast("long"), "text", site), labels, site, ["doc_id", site])
    return rows.withColumn("kept", F.col("quality_score") >= threshold)
