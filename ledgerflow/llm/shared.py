"""Helpers the operators of this subpackage share: the folder for intermediate
tables, joins that broadcast only what has been measured, and vectorised
scanning of Arrow text columns.
"""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words and that are stripped from lines.
BLANK = " \t\n\x0b\x0c\r"
#: A joined table is broadcast up to this many estimated bytes, and shuffled beyond.
BROADCAST_BYTES = 16 << 20
#: Bytes of text that are scanned at once; a longer text is a slice of its own.
SLICE_BYTES = 2 << 20
_MASK = (1 << 64) - 1
_GOLD, _MIX1, _MIX2 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


# -- tables -------------------------------------------------------------------


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, from spark.checkpoint.dir.

    Where it is unset a local session gets a temporary folder; on a cluster that
    would scatter the rows over the hosts' own disks, so it is an error there.
    """
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            at = known.get()
        elif re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            at = "file://" + tempfile.mkdtemp(prefix="ledgerflow-")
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


_scratch: list[list[str]] = []


def saved(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    if _scratch:
        _scratch[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*frames: DataFrame) -> None:
    """Delete ``saved`` tables that nothing unwritten reads any more."""
    for df in frames:
        _delete(df.sparkSession, df._saved_at)


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables saved inside are deleted at the end, but for those saved under ``kept``."""
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            _delete(spark, path)


@contextlib.contextmanager
def kept() -> Iterator[None]:
    """Tables saved inside outlive the ``scratch`` around them."""
    outer, _scratch[:] = _scratch[:], []
    try:
        yield
    finally:
        _scratch[:] = outer


def clear(spark: SparkSession) -> None:
    """Delete all tables that this application has saved; results of operators that have not been written yet become unreadable."""
    _delete(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")


def attach(left: DataFrame, right: DataFrame, on: list[str], how: str, row_bytes: int) -> DataFrame:
    """Join, broadcasting ``right`` only if its counted rows times ``row_bytes`` stay under BROADCAST_BYTES.

    Beyond that both sides are shuffled and sorted, which spills where memory is
    short, and adaptive execution splits hot keys of ``left``.
    """
    return left.join(F.broadcast(right) if right.count() * row_bytes <= BROADCAST_BYTES else right.hint("merge"), on, how)


def folded(docs: DataFrame, own: list[str]) -> DataFrame:
    """``own`` columns and all others in one struct, so that no name of theirs meets one an operator adds."""
    return docs.select(*own, F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns if c not in own)).alias("_rest"))


def unfolded(df: DataFrame, columns: list[str], own: list[str]) -> DataFrame:
    """The columns that ``folded`` put away, in their order."""
    return df.select(*((F.col(c) if c in own else F.col("_rest")[c]).alias(c) for c in columns))


def row_key(text: str = "text") -> Column:
    """Tells rows apart that repeat a doc_id with another text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased and nothing else."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, upper, upper.lower()))


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Arrow batches of few rows, since texts can be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; then a worker gives freed pages back to the system, as it waits for its next task."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):
            ctypes.CDLL(None).malloc_trim(0)


def records(**columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


# -- text buffers ---------------------------------------------------------------


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column (null: empty), and where each row starts and ends."""
    column = pc.fill_null(column, "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw[:0], at - at[0]


def slices(at: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose texts have about ``limit`` bytes together."""
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, hi
        lo = hi


def mixed(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def _table(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _table(20_240_117)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_BASE = 0xD6E8FEB86659FD93
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
BLANKS = np.zeros(256, bool)
BLANKS[[ord(c) for c in BLANK]] = True


def _power(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64; those of a slice are kept, more for one long text are not."""
    if len(_powers[0]) >= n:
        return _powers
    if n <= SLICE_BYTES + 1:
        n = min(1 << n.bit_length(), SLICE_BYTES + 1)
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        x = np.full(n, np.uint64(base & _MASK))
        x[0] = 1
        out.append(np.cumprod(x, dtype=np.uint64, out=x))
    if n <= SLICE_BYTES + 1:
        _powers[:] = out
    return out


class Spans:
    """Hashes of spans of one buffer, each in constant time from running sums."""

    def __init__(self, raw: np.ndarray, fold: bool):
        self.up, self.down = _power(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((_FOLDED if fold else _BYTE)[raw] * self.up[: len(raw)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * _GOLD)


class Table:
    """A hash table of 64-bit keys (not 0) and small numbers, in arrays."""

    def __init__(self):
        self.keys, self.values, self.n = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32), 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(65 - len(self.keys).bit_length())).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The stored numbers of the keys, -1 where there is none."""
        at = self._slot(keys)
        have = self.keys[at]
        out = np.where(have == keys, self.values[at], -1).astype(np.int64)
        todo = np.flatnonzero((have != keys) & (have != 0))
        at = at[todo]
        while len(todo):
            at = (at + 1) & (len(self.keys) - 1)
            have = self.keys[at]
            hit = have == keys[todo]
            out[todo[hit]] = self.values[at[hit]]
            more = ~hit & (have != 0)
            todo, at = todo[more], at[more]
        return out

    def store(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Store distinct keys that are not there yet."""
        self.n += len(keys)
        if 2 * self.n > len(self.keys):
            full = self.keys != 0
            keys, values = np.concatenate([self.keys[full], keys]), np.concatenate([self.values[full], values])
            size = 1 << int(4 * self.n).bit_length()
            self.keys, self.values = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[todo[free]]  # of several for one slot the last stays
            own = self.keys[at] == keys[todo]
            self.values[at[own]] = values[todo[own]]
            todo, at = todo[~own], (at[~own] + 1) & (len(self.keys) - 1)


def words(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of the words ``[^\\x20\\x09-\\x0D]+`` of the rows bounded by ``at``."""
    solid = ~BLANKS[raw]
    cut = np.zeros(len(raw) + 1, bool)
    cut[at] = True
    before, after = np.ones(len(raw), bool), np.ones(len(raw), bool)
    before[1:] = ~solid[:-1] | cut[1:-1]
    after[:-1] = ~solid[1:] | cut[1:-1]
    start, end = np.flatnonzero(solid & before), np.flatnonzero(solid & after) + 1
    return start, end, np.searchsorted(at, start, "right") - 1


def windows(hashes: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within a row, and the index of the first word of each."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    x = np.zeros(n, np.uint64)
    for j in range(size):
        x = x * _GOLD + hashes[j : j + n]
    first = np.flatnonzero(row[:n] == row[size - 1 :])
    return mixed(x[first]), first


def per_row(flag: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums of ``flag`` over each row."""
    sums = np.zeros(len(flag) + 1, np.int64)
    np.cumsum(flag, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def repeated(values: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values occur more than once in their row, and which of them are not the first."""
    key = mixed(values + row.astype(np.uint64) * _MIX2)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    again, any_ = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order[1:][same]] = True
    any_[order[1:][same]] = True
    any_[order[:-1][same]] = True
    return any_, again
