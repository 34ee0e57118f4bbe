"""Quality rules judged by host.

Each document's failure of the base rules is counted by host, the domain of its
source where that is a URL; the host's rate is shrunk towards all hosts by a beta prior fitted to their rates (moments), and a
host whose shrunken rate exceeds ``max_rate`` takes all its documents with it.

Null and empty texts have no words and fail. A null host is a host of its own.
Repeated rows count each. Columns other than doc_id, text and the host's are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BLANKS, Spans, attach, per_row, records, repeated, saved, slices, small_batches, texts, windows, words

WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT, MAX_RATE = 5, 10, 20, 0.5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def base_counts(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each row."""
    n, spans = len(at) - 1, Spans(raw, fold=False)
    start, end, row = words(raw, at)
    solid = ~BLANKS[raw]
    x, first = windows(spans(start, end), row, WINDOW)
    twice, _ = repeated(x, row[first])
    edge = np.zeros(len(start) + 1, np.int64)
    np.add.at(edge, first[twice], 1)
    np.add.at(edge, first[twice] + WINDOW, -1)
    covered = np.cumsum(edge)[:-1] > 0
    breaks = np.flatnonzero(raw == 10)
    left = np.sort(np.concatenate([at[:-1], breaks + 1]))
    right = np.sort(np.concatenate([breaks, at[1:]]))
    filled = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(solid, out=filled[1:])
    full = filled[right] > filled[left]
    left, right = left[full], right[full]
    line_row = np.searchsorted(at, left, "right") - 1
    _, again = repeated(spans(left, right), line_row)
    return (
        np.bincount(row, minlength=n),
        per_row(solid & ((raw & 0xC0) != 0x80), at),
        per_row(SYMBOLS[raw], at),
        np.bincount(line_row[again], minlength=n),
        np.bincount(row[covered], minlength=n),
    )


def host_of(site: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(site, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?(?:[^/@]*@)?([^/?#]*)", 1))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, at = texts(batch.column("text"))
        for lo, hi in slices(at):
            counts = base_counts(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
            yield records(doc_id=batch.column("doc_id")[lo:hi], host=batch.column("host")[lo:hi], **{k: pa.array(v.astype(np.int64)) for k, v in zip(NAMES, counts, strict=True)})


def base_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """The base counts of every document and whether it fails."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.when(F.col(host).isNotNull(), host_of(F.col(host).cast("string"))).alias("host"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_count, "doc_id long, host string, " + ", ".join(f"{k} long" for k in NAMES))
    return counted.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def host_rates(failed: DataFrame) -> DataFrame:
    """host, n_docs, n_failed and the rate shrunk by the beta prior that the hosts' own rates suggest.

    The prior's mean is the rate over all documents. Its weight comes from the
    variance of the rates between hosts beyond what chance gives, and lies in 1 to 1e6.
    """
    hosts = failed.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    all_ = hosts.agg(F.sum("n_docs").alias("n"), F.sum("n_failed").alias("k"), F.count(F.lit(1)).alias("hosts"), F.sum(F.col("n_docs").cast("double") ** 2).alias("n2"), F.sum(F.col("n_failed").cast("double") ** 2 / F.col("n_docs")).alias("k2"))
    mean = F.try_divide(F.col("k").cast("double"), F.col("n"))
    between = F.col("k2") - F.col("n") * mean * mean  # weighted squares of the hosts' rates about the mean
    spread = F.try_divide(between - (F.col("hosts") - 1) * mean * (1 - mean), F.col("n") - F.try_divide(F.col("n2"), F.col("n")) - (F.col("hosts") - 1))
    weight = F.when(spread > 0, F.least(F.greatest(mean * (1 - mean) / spread - 1, F.lit(1.0)), F.lit(1e6))).otherwise(F.lit(1e6))
    prior = all_.where("n > 0").select(mean.alias("mean"), weight.alias("weight"))
    return hosts.join(F.broadcast(prior)).select("host", "n_docs", "n_failed", ((F.col("n_failed") + F.col("mean") * F.col("weight")) / (F.col("n_docs") + F.col("weight"))).alias("host_rate"))


def quality_rules(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """Every document with its base counts, base_failed, the host's shrunken rate and kept."""
    base = saved(base_rules(docs, host), "quality-base").withColumn("_host", F.coalesce(F.concat(F.lit("h"), "host"), F.lit("")))
    rates = host_rates(base).select(F.coalesce(F.concat(F.lit("h"), "host"), F.lit("")).alias("_host"), "host_rate")
    judged = attach(base, rates, ["_host"], "left", 64).drop("_host")
    return judged.withColumn("kept", ~F.col("base_failed") & ~(F.coalesce("host_rate", F.lit(0.0)) > max_rate))
