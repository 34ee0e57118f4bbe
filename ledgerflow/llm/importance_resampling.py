"""Resampling of documents towards a target's distribution by importance weights.

Features are the runs of one and two words, hashed into BUCKETS buckets. One pass
counts the buckets of all documents and of the target, a task at a time; the
gains of the buckets are an array of that fixed size, which scores each document in a
second pass. Weight and Gumbel noise are whole numbers, so a histogram of scores is
exact and has as many rows as scores have values, however many documents there are: its
suffix sums give how many documents are ahead of each score, and where the draw
ends. Only documents of drawn scores are ranked, each within its own score.

Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased. Null
and empty texts have no features, weight 0 and are never drawn; texts of any length
are read whole, in slices. Rows that repeat a doc_id count and are drawn each by
themselves; ties go to the smaller doc_id, a null one before all. Empty tables
count nothing: all gains are then those of the other table's counts alone. Only doc_id and text are read, so other
columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import SLICE_BYTES, attach, records, saved, slices, small_batches, texts, tidy

BUCKETS = 10_000
PERCENT, MIN_WORDS, SEED = 25, 20, 7
#: Words with more bytes are hashed one by one.
LONG_WORD = 64


# -- features ------------------------------------------------------------------


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & np.uint32(1), (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[97:123] = _IN_WORD[128:] = True


def crc_on(state: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans of ``raw``, each going on from its own CRC-32 in ``state``."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    size, at = size[order], start[order]
    state = state[order]
    long = int(np.searchsorted(-size, -LONG_WORD, "left"))
    for k in range(long):
        state[k] = zlib.crc32(raw[at[k] : at[k] + size[k]].tobytes(), int(state[k]))
    c, at, size = ~state[long:], at[long:], -size[long:]
    for j in range(-int(size[0]) if len(size) else 0):
        k = int(np.searchsorted(size, -j, "left"))
        c[:k] = _CRC[(c[:k] ^ raw[at[:k] + j]) & np.uint32(255)] ^ (c[:k] >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = np.concatenate([state[:long], ~c])
    return out


class Features:
    """The buckets of the one- and two-word runs of a slice, and the row of each."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, cut: bool = False, seen: int = 0):
        """``cut``: the text goes on after ``raw``; ``seen``: so many of its first words were counted before, but not their runs with the next."""
        solid = _IN_WORD[raw]
        bound = np.zeros(len(raw) + 1, bool)
        bound[at] = True
        before, after = np.ones(len(raw), bool), np.ones(len(raw), bool)
        before[1:] = ~solid[:-1] | bound[1:-1]
        after[:-1] = ~solid[1:] | bound[1:-1]
        start, end = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
        if cut and len(end) and end[-1] == len(raw):
            start, end = start[:-1], end[:-1]
        #: Where the next slice of a cut text begins: its last whole word opens one more run.
        self.next = int(start[-1]) if len(start) > seen else None
        row = np.searchsorted(at, start, "right") - 1
        one = crc_on(np.zeros(len(start), np.uint32), raw, start, end)
        follows = np.flatnonzero(row[1:] == row[:-1])
        c = ~one[follows]
        spaced = ~(_CRC[(c ^ np.uint32(32)) & np.uint32(255)] ^ (c >> np.uint32(8)))
        two = crc_on(spaced, raw, start[follows + 1], end[follows + 1])
        self.words = np.bincount(row[seen:], minlength=len(at) - 1)
        self.bucket = (np.concatenate([one[seen:], two]) % np.uint32(BUCKETS)).astype(np.int64)
        self.row = np.concatenate([row[seen:], row[follows]])


def features(column: pa.Array) -> Iterator[tuple[int, Features]]:
    """Features of slices of the rows, each with the number of its first row; a long text's slices follow each other."""
    raw, at = texts(column)
    raw = _LOWER[raw]
    for lo, hi in slices(at, SLICE_BYTES):
        own = raw[at[lo] : at[hi]]
        if len(own) <= 2 * SLICE_BYTES:
            yield lo, Features(own, at[lo : hi + 1] - at[lo])
            continue
        p, size, seen = 0, SLICE_BYTES, 0
        while p < len(own):
            part = own[p : p + size]
            last = p + size >= len(own)
            f = Features(part, np.array([0, len(part)]), not last, seen)
            if last or f.next is not None:
                yield lo, f
            if last:
                break
            if f.next is None and not f.words.any():  # no second whole word yet: one is very long, or blanks are
                size *= 2
            else:
                p, size, seen = p + f.next, SLICE_BYTES, 1


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many features of a task's texts each bucket has."""
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for _, f in features(batch.column("text")):
            counts += np.bincount(f.bucket, minlength=BUCKETS)
    there = np.flatnonzero(counts)
    yield records(bucket=there.astype(np.int32), n=counts[there])


def score_batches(batches: Iterator[pa.RecordBatch], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Number of words and features, and the floored mean of the features' gains, for each text."""
    for batch in batches:
        n = batch.num_rows
        words, found, total = (np.zeros(n, np.int64) for _ in range(3))
        for lo, f in features(batch.column("text")):
            at = slice(lo, lo + len(f.words))
            words[at] += f.words
            found[at] += np.bincount(f.row, minlength=len(f.words))
            total[at] += np.bincount(f.row, weights=gains[f.bucket], minlength=len(f.words)).astype(np.int64)
        yield records(doc_id=batch.column("doc_id"), n_words=words, n_features=found, weight=np.where(found > 0, total // np.maximum(found, 1), 0))


# -- the plan ------------------------------------------------------------------


def bucket_counts(texts_: DataFrame, name: str) -> DataFrame:
    rows = texts_.select(F.col("text").cast("string").alias("text")).where("text <> ''")
    return rows.mapInArrow(lambda b: tidy(count_batches(b)), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias(name))


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of every bucket, an array of BUCKETS whole numbers."""
    both = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket")).join(bucket_counts(docs, "s"), "bucket", "left").join(bucket_counts(target, "t"), "bucket", "left").na.fill(0)
    rows = both.select("bucket", F.col("s").cast("double").alias("s"), F.col("t").cast("double").alias("t"))
    whole = F.sum("s").over(Window.partitionBy()), F.sum("t").over(Window.partitionBy())
    gain = F.floor(1000 * F.ln((F.col("t") + 1) * (whole[0] + BUCKETS) / ((F.col("s") + 1) * (whole[1] + BUCKETS))))
    out = np.zeros(BUCKETS, np.int64)
    for r in rows.select("bucket", gain.alias("gain")).collect():  # BUCKETS rows, whatever the input
        out[r["bucket"]] = r["gain"]
    return out


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, floored, from the id alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def importance_resampling(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is null for those not drawn."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    gains = bucket_gains(rows, target)
    scored = rows.mapInArrow(lambda b: tidy(score_batches(b, gains)), "doc_id long, n_words long, n_features long, weight long")
    scored = saved(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "scores")
    able = F.col("n_words") >= min_words
    # as many rows as scores have values: gains and noise are bounded, whatever the input
    histogram = scored.where(able).groupBy("score").agg(F.count(F.lit(1)).alias("n"))
    down = Window.orderBy(F.desc("score"))
    ahead = histogram.select("score", (F.sum("n").over(down) - F.col("n")).alias("ahead"), F.sum("n").over(Window.partitionBy()).alias("all"))
    offsets = saved(ahead.withColumn("drawn", F.expr(f"`all` * {int(percent)} div 100")).where("ahead < drawn").select("score", "ahead", "drawn"), "drawn-scores")
    marked = attach(scored, offsets, ["score"], "left", 32)
    mine = able & F.col("ahead").isNotNull()
    nth = F.col("ahead") + F.row_number().over(Window.partitionBy("score").orderBy("doc_id"))
    top = marked.where(mine).withColumn("rank", nth).withColumn("rank", F.when(F.col("rank") <= F.col("drawn"), F.col("rank")))
    rest = marked.where(~mine).withColumn("rank", F.lit(None).cast("long"))
    return top.unionByName(rest).select("doc_id", "n_features", "weight", "score", F.col("rank").cast("long").alias("rank"))


#: The same rows in DuckDB SQL over documents and benchmark. A CRC-32 goes bit by bit: each byte, then eight shifts (-1).
IMPORTANCE_RESAMPLING_SQL = r"""
WITH t AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
), w AS (
  SELECT side, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS l FROM t
), f AS (
  SELECT side, r, unnest(l || [l[i] || ' ' || l[i + 1] for i in range(1, len(l))]) AS feature FROM w
), c AS (
  SELECT side, r, feature, count(*) AS n FROM f GROUP BY ALL
), h AS (
  SELECT feature, hex(encode(feature)) AS x FROM (SELECT DISTINCT feature FROM c)
), b AS (
  SELECT feature, xor(list_reduce([4294967295] || flatten([[('0x' || x[2 * i + 1:2 * i + 2])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] for i in range(0, len(x) // 2)]),
    lambda s, o: CASE WHEN o >= 0 THEN xor(s, o) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END), 4294967295) % 10000 AS bucket FROM h
), k AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (side = 'b'), 0)::DOUBLE AS t FROM c JOIN b USING (feature) GROUP BY bucket
), g AS (
  SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM k
), d AS (
  SELECT r, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight FROM c JOIN b USING (feature) JOIN g USING (bucket) WHERE side = 'd' GROUP BY r
), z AS (
  SELECT doc_id, len(l) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN d USING (r) WHERE side = 'd'
), o AS (
  SELECT *, n_words >= 20 AS able, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place, count(*) FILTER (n_words >= 20) OVER () AS n FROM z
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= 25 * n // 100 THEN place END AS rank FROM o
"""
