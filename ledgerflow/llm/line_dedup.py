"""Line deduplication across documents, in DataFrame operations only.

Lines become 128-bit hashes with document and position. The hashes are
range-partitioned with the document, so that one line's rows may fill many
partitions, sorted within a partition by document and position, and streamed: of
each run of a line in a document the first occurrence goes on, by its place in the
sort. Counting documents per line combines on the map side. What
comes back is one compressed keep bitmap per document that loses lines, as runs
of kept positions; no text is moved for it.

A line's key is the line without blanks at both ends, A-Z lower-cased. Null and
empty texts are one empty line. Rows with a null doc_id keep all lines and are
not counted; rows that repeat a doc_id count as one document, each with its own
bitmap. Ties cannot occur: the surviving document is the largest (or smallest) id.
An empty table has no lines; other columns pass through ``with_bitmaps``, whose
callers fold away names that clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import BLANK, ascii_lower, attach, discard, row_key, saved

MIN_CHARS, MIN_DOCS = 40, 5


def lines_of(text: str = "text") -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, row key, position and two hashes of every line whose key has ``min_chars`` code points."""
    exploded = docs.where("doc_id is not null and text is not null").select("doc_id", row_key().alias("row_key"), F.posexplode(lines_of()).alias("position", "line"))
    keyed = exploded.select("doc_id", "row_key", "position", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select("doc_id", "row_key", "position", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"))


def first_occurrences(found: DataFrame) -> DataFrame:
    """The first occurrence of each line in each document, in one stream over range partitions.

    The window's keys are the ranges' own, so it needs no shuffle beyond theirs; its
    sort is the secondary sort, and the rank limit lets no second row of a run pass.
    """
    run = Window.partitionBy("h1", "h2", "doc_id").orderBy("position", "row_key")
    ranged = found.repartitionByRange("h1", "h2", "doc_id")
    return ranged.withColumn("nth", F.row_number().over(run)).where("nth = 1").drop("nth")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, keep: str = "last") -> DataFrame:
    """doc_id, row_key, n_dropped and ``dropped`` positions of each document that loses lines, with ``kept`` runs (start, length)."""
    found = saved(line_hashes(docs, min_chars), "lines")
    once = first_occurrences(found)
    survivor = (F.max if keep == "last" else F.min)("doc_id").alias("survivor")
    common = once.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), survivor).where(F.col("n_docs") >= min_docs)
    common = saved(common.select("h1", "h2", "survivor"), "common-lines")
    lost = attach(found, common, ["h1", "h2"], "inner", 48).where("doc_id <> survivor")
    dropped = lost.groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_set("position")).alias("dropped"))
    starts = F.concat(F.array(F.lit(0)), F.transform("dropped", lambda p: p + 1))
    # the last run is open: its length is cut where the text ends
    ends = F.concat("dropped", F.array(F.lit(2_147_483_647)))
    runs = F.filter(F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("start"), (b - a).alias("length"))), lambda r: r["length"] > 0)
    out = dropped.select("doc_id", "row_key", F.size("dropped").cast("long").alias("n_dropped"), runs.alias("kept"))
    out = saved(out, "bitmaps")
    discard(found, common)
    return out


def kept_text(text: str = "text") -> Column:
    """The lines of the kept runs, or the whole text where there is no bitmap."""
    lines = lines_of(text)
    return F.when(F.col("kept").isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(F.flatten(F.transform("kept", lambda r: F.slice(lines, r["start"] + 1, r["length"]))), "\n"))


def with_bitmaps(docs: DataFrame, **options) -> DataFrame:
    """All rows of ``docs`` with n_dropped and kept, null where nothing is lost."""
    bitmaps = keep_bitmaps(docs, **options)
    keyed = docs.withColumn("row_key", row_key())
    runs = bitmaps.agg(F.coalesce(F.sum(F.size("kept")), F.lit(0))).first()[0]
    n = max(1, bitmaps.count())
    return attach(keyed, bitmaps, ["doc_id", "row_key"], "left", 64 + 24 * runs // n)


def line_dedup(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the kept text of every document."""
    rows = with_bitmaps(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")), **options)
    return rows.select("doc_id", F.size(lines_of()).cast("long").alias("n_lines"), F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"), F.sha2(kept_text().cast("binary"), 256).alias("kept_sha256"))


#: The same rows in DuckDB SQL over documents.
LINE_DEDUP_SQL = """
WITH ls AS (
  SELECT doc_id, generate_subscripts(l, 1) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), k AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM ls
), c AS (
  SELECT key, max(doc_id) AS survivor FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), j AS (
  SELECT k.doc_id, pos, line, coalesce(c.survivor <> k.doc_id, false) AS dropped FROM k LEFT JOIN c USING (key)
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""
