"""Language identification by prediction by partial matching.

For each language a tree of byte contexts of order 0 to ORDER holds how often
each byte followed; a byte that never followed a context costs that context's
escape (method C) and is predicted by the next shorter one, without the bytes
already excluded there, down to the uniform order -1. A context of the longest
order is in the tree only if it occurred MIN_COUNT times, and of those the
CONTEXTS most frequent: the trees are of variable order. The statistics are frozen
after the fit, so every context has a fixed code length for every byte and a
text's exact code length under a language is a sum over its bytes.

Languages share no table: each contributes, for its contexts, the escape's length
and, for the bytes it saw there, what they cost less than that escape and the
shorter context together. So the model grows with what the languages saw, not with
their number times all contexts. A worker keeps the summed lengths of the byte
runs it has met, CACHE_BYTES at most, and scores a text by one lookup per byte.

The fit reads a documented sample: of each language the SAMPLE_ROWS training rows
with the smallest hashes, of each at most SAMPLE_CHARS successive characters from a
place chosen by the hash. Every non-null language is learned. Scoring covers every
text whole, capitals lower-cased. A text that is null or has no letter is ``und``
with score 0. Equal code lengths go to the first language in order of names. With
no training rows every text is ``und``. Repeated rows are scored each, alike; an
empty table gives no rows; columns besides doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import Table, mixed, records, slices, small_batches, texts

ORDER = 3
SAMPLE_ROWS, SAMPLE_CHARS = 300, 4096
CONTEXTS, MIN_COUNT = 1 << 14, 4
CACHE_BYTES, SCORE_BYTES, BLOCK = 48 << 20, 1 << 18, 16
UNKNOWN = "und"


@dataclass
class Sparse:
    """By key (of ``keys``, ascending) the languages that have it and a length for each."""

    keys: np.ndarray
    bound: np.ndarray
    lang: np.ndarray
    bits: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple[np.ndarray, np.ndarray]]) -> Sparse:
        """From the keys and lengths of each language."""
        key = np.concatenate([np.zeros(0, np.int64), *(k for k, _ in parts)])
        lang = np.repeat(np.arange(len(parts)), [len(k) for k, _ in parts])
        bits = np.concatenate([np.zeros(0), *(x for _, x in parts)])
        order = np.argsort(key, kind="stable")
        keys, first = np.unique(key[order], return_index=True)
        return cls(keys, np.append(first, len(key)), lang[order].astype(np.int32), bits[order])

    def add(self, out: np.ndarray, keys: np.ndarray) -> None:
        """Add the lengths of each row's key to its languages."""
        if not len(self.keys):
            return
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        row = np.flatnonzero(self.keys[at] == keys)
        at = at[row]
        size = self.bound[at + 1] - self.bound[at]
        end = np.cumsum(size)
        place = np.repeat(self.bound[at] - end + size, size) + np.arange(size.sum())
        out[np.repeat(row, size), self.lang[place]] += self.bits[place]


@dataclass
class ContextTrees:
    """langs; code length of each byte by order 0; for the orders above the escapes by context and the savings by context and byte."""

    langs: list[str]
    base: np.ndarray
    escapes: list[Sparse]
    savings: list[Sparse]
    cache: tuple[Table, np.ndarray] | None = field(default=None, repr=False)

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """Code lengths under each language of the last byte of runs of ORDER + 1 bytes."""
        out = self.base[codes & 255]
        for m, (escape, saving) in enumerate(zip(self.escapes, self.savings, strict=True), 1):
            escape.add(out, codes >> 8 & (1 << 8 * m) - 1)
            saving.add(out, codes & (1 << 8 * m + 8) - 1)
        return out

    def rows(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each run of bytes a row of the table of lengths, and that table."""
        room = max(CACHE_BYTES // (4 * max(len(self.langs), 1)), 1)
        table, bits = self.cache or (Table(), np.zeros((0, len(self.langs)), np.float32))
        if table.n > room:
            table, bits = Table(), np.zeros((0, len(self.langs)), np.float32)
        key = mixed(codes.astype(np.uint64) + np.uint64(1))
        at = table(key)
        new = np.flatnonzero(at < 0)
        if len(new):
            own, where, back = np.unique(key[new], return_index=True, return_inverse=True)
            first = table.n
            if first + len(own) > len(bits):
                wider = np.zeros((2 * (first + len(own)), bits.shape[1]), np.float32)
                wider[:first] = bits[:first]
                bits = wider
            bits[first : first + len(own)] = self.lengths(codes[new[where]])
            table.store(own, first + np.arange(len(own)))
            at[new] = first + back
        self.cache = table, bits
        return at, bits


def _codes(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The run of ORDER + 1 bytes that ends at each byte; a text starts after blanks."""
    codes = np.zeros(len(raw), np.int64)
    place = np.arange(len(raw)) - np.repeat(at[:-1], np.diff(at))
    for d in range(ORDER + 1):
        byte = np.full(len(raw), 32, np.int64)
        byte[d:] = raw[: len(raw) - d]
        codes |= np.where(place >= d, byte, 32) << 8 * d
    return codes


def _tree(codes: np.ndarray, contexts: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]], list[tuple[np.ndarray, np.ndarray]]]:
    """Order 0 lengths of all bytes, and for each order above the escapes of the contexts and the savings of the bytes seen in them."""
    count = np.bincount(codes & 255, minlength=256)
    kinds = (count > 0).sum()
    full = np.where(count > 0, count, kinds / max(256 - kinds, 1)) / (count.sum() + kinds * (kinds < 256))
    base = -np.log2(np.maximum(full, 1e-300))
    below, below_bits = np.arange(256), base
    escapes, savings = [], []
    for m in range(1, ORDER + 1):
        seen, n = np.unique(codes & (1 << 8 * m + 8) - 1, return_counts=True)
        context, first, kinds = np.unique(seen >> 8, return_index=True, return_counts=True)
        total = np.add.reduceat(n, first) if len(first) else n
        low = below_bits[np.searchsorted(below, seen & (1 << 8 * m) - 1)]
        left = 1.0 - (np.add.reduceat(np.exp2(-low), first) if len(first) else low)
        keep = np.ones(len(context), bool)
        if m == ORDER:
            rank = np.empty(len(context), np.int64)
            rank[np.lexsort((context, -total))] = np.arange(len(context))
            keep = (total >= MIN_COUNT) & (rank < contexts)
        spare = left > 1e-9  # else every byte has followed, and nothing escapes
        mass = np.where(spare, total + kinds, total)
        escape = np.where(spare, np.log2(mass / kinds) + np.log2(np.maximum(left, 1e-9)), 0.0)
        own = np.log2(np.repeat(mass, kinds) / n)
        of = np.repeat(keep, kinds)
        escapes.append((context[keep], escape[keep]))
        savings.append((seen[of], (own - np.repeat(escape, kinds) - low)[of]))
        below, below_bits = seen, np.where(of, own, low)
    return base, escapes, savings


def fit(samples: dict[str, list[str]], contexts: int = CONTEXTS) -> ContextTrees:
    """Context trees of the given texts by language."""
    langs = sorted(samples)
    trees = []
    for k in langs:
        own = [x.lower().encode() for x in samples[k]]
        at = np.concatenate([[0], np.cumsum([len(x) for x in own], dtype=np.int64)])
        trees.append(_tree(_codes(np.frombuffer(b"".join(own), np.uint8), at), contexts))
    base = np.column_stack([t[0] for t in trees]) if trees else np.zeros((256, 0))
    return ContextTrees(langs, base, *([Sparse.of([t[i][m] for t in trees]) for m in range(ORDER)] for i in (1, 2)))


def code_lengths(trees: ContextTrees, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code length in bits of each row under each language."""
    out = np.zeros((len(at) - 1, len(trees.langs)))
    some = np.flatnonzero(np.diff(at))
    if len(some):
        row, bits = trees.rows(_codes(raw, at))
        for j in range(0, len(trees.langs), BLOCK):
            out[some, j : j + BLOCK] = np.add.reduceat(bits[:, j : j + BLOCK][row], at[:-1][some], axis=0, dtype=np.float64)
    return out


def _predict(batches: Iterator[pa.RecordBatch], model: Broadcast) -> Iterator[pa.RecordBatch]:
    trees: ContextTrees = model.value
    for batch in batches:
        column = pc.fill_null(batch.column("text"), "")
        letters = pc.match_substring_regex(column, r"\p{L}").to_numpy(zero_copy_only=False).astype(bool)
        raw, at = texts(pc.utf8_lower(column))
        names, scores = np.full(len(column), UNKNOWN, object), np.zeros(len(column))
        for lo, hi in slices(at, SCORE_BYTES) if trees.langs else ():
            bits = code_lengths(trees, raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])
            best = bits.argmin(1)
            share = 1 / np.exp2(np.maximum(bits.min(1)[:, None] - bits, -1000)).sum(1)
            names[lo:hi] = np.array(trees.langs, object)[best]
            scores[lo:hi] = share
        names[~letters], scores[~letters] = UNKNOWN, 0.0
        yield records(doc_id=batch.column("doc_id"), lang_pred=pa.array(names.tolist(), pa.string()), score=pa.array(scores))


def held_out(doc_id: str = "doc_id") -> Column:
    """The rows that are never learned from: crc32 of the id as text leaves 1 modulo 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame) -> ContextTrees:
    """Fit on the documented sample of the rows that are not held out."""
    rows = docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return fit({})
    # most rows are passed over by their hash alone; the rank then is exact
    share = F.create_map(*(x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, (2 * SAMPLE_ROWS + 100) / r["count"])))))
    near = rows.withColumn("o", F.xxhash64("doc_id", "text")).where(F.col("o") / float(1 << 63) <= 2.0 * share[F.col("lang")] - 1.0)
    begin = F.pmod(F.col("o"), F.greatest(F.length("text") - SAMPLE_CHARS + 1, F.lit(1))).cast("int") + 1
    near = near.select("lang", "o", F.substring(F.col("text"), begin, F.lit(SAMPLE_CHARS)).alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("o", "text"))
    found: dict[str, list[str]] = {}
    for r in sorted(near.withColumn("nth", nth).where(F.col("nth") <= SAMPLE_ROWS).collect(), key=lambda r: (r["lang"], r["nth"])):
        found.setdefault(r["lang"], []).append(r["text"])
    return fit(found)


def language_id(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    spark = docs.sparkSession
    small_batches(spark)
    model = spark.sparkContext.broadcast(learn(docs))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(lambda batches: _predict(batches, model), "doc_id long, lang_pred string, score double")
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
