"""N-gram Jaccard self-join by adaptive multi-match prefixes, and its components.

Documents are sets of word shingles (64-bit hashes). All shingles have one
global order, rare before frequent, by counts over all documents in a sketch of
fixed size. A document's prefix holds so many first shingles that two documents
that link must share at least ``need`` of them; ``need`` is 1 for most documents
and grows to MAX_NEED with the estimated number of candidates the prefix would
meet, the prefix growing by as many shingles.

Documents with equal sets are one class with the smallest doc_id as its
representative. Two rounds find the links between classes without pairing all
members of a group: first each class is verified against one leader of the
prefix shingles it shares, the cleanest member; then, by the components so far,
only members of different components that share a prefix shingle and pass the
exact length and position bounds are counted, and those that share ``need`` are
verified. Long lists of a shingle are joined by bands of set sizes, and a pair
whose parity sketches differ in more bits than the sets may differ in shingles is
dropped in the join: sets that differ in d shingles differ in at most d such bits. Links inside a component cannot change it and are not looked for.

Null texts and texts without words have empty sets and link with nothing; fewer
words than a shingle are one shingle. Rows with a null doc_id take no part and
have a null component. A repeated doc_id is one document that has all its rows' texts.
Ties of leaders go to the smallest id and change no component. An empty table gives
no rows; columns besides doc_id and text are not read, so their names cannot clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .shared import Spans, attach, discard, mixed, records, saved, slices, small_batches, texts, tidy, windows, words

SIZE, PERCENT = 5, 80
MAX_NEED = 4
SKETCH_BITS, BLOCK_BITS = 20, 14
FILTER_BITS = 23
#: Pairs of whole sets in a batch: both sets of a pair can be large.
PAIR_ROWS = 64
#: Longs of a parity sketch; lists of a shingle beyond this length are joined by bands.
SKETCH_LONGS, BAND_FROM = 8, 32


# -- shingles --------------------------------------------------------------------


def shingles(raw: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of the rows, and where each row's begin (len(at) bounds)."""
    start, end, row = words(raw, at)
    own = Spans(raw, fold=True)(start, end)
    x, first = windows(own, row, size)
    x_row = row[first]
    count = np.bincount(row, minlength=len(at) - 1)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        begin = np.searchsorted(row, short)
        whole = np.zeros(len(short), np.uint64)
        for j in range(size - 1):
            here = count[short] > j
            whole[here] = mixed(whole[here] + own[begin[here] + j] + np.uint64(j + 1))
        order = np.argsort(np.concatenate([x_row, short]), kind="stable")
        x, x_row = np.concatenate([x, whole])[order], np.concatenate([x_row, short])[order]
    return x, np.searchsorted(x_row, np.arange(len(at)))


def row_sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    raw, at = texts(column)
    for lo, hi in slices(at):
        x, bound = shingles(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], size)
        for i in range(hi - lo):
            own = np.sort(x[bound[i] : bound[i + 1]])
            yield own[np.r_[True, own[1:] != own[:-1]]] if len(own) else own


# -- how frequent shingles are ------------------------------------------------------


def _sketch(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << SKETCH_BITS, np.uint32)
    for batch in batches:
        raw, at = texts(batch.column("text"))
        for lo, hi in slices(at):
            x, _ = shingles(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo], size)
            counts += np.bincount((x >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS).astype(np.uint32)
    blocks = counts.reshape(-1, 1 << BLOCK_BITS)
    used = np.flatnonzero(blocks.any(1))
    if len(used):
        yield records(block=pa.array(used, pa.int32()), counts=pa.array([zlib.compress(blocks[i].tobytes(), 1) for i in used], pa.binary()))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            new = np.frombuffer(zlib.decompress(data), np.uint32)
            sums[block] = np.minimum(sums.get(block, np.uint64(0)) + new.astype(np.uint64), np.uint64(0xFFFFFFFF))
    if sums:
        yield records(block=pa.array(list(sums), pa.int32()), counts=pa.array([v.astype(np.uint32).tobytes() for v in sums.values()], pa.binary()))


def shingle_counts(docs: DataFrame, size: int) -> np.ndarray:
    """Counts over all documents of shingles by the first bits of their hashes: 4 MB at any size of the input."""
    parts = docs.select("text").mapInArrow(lambda b: tidy(_sketch(b, size)), "block int, counts binary")
    found = parts.repartition(1 << (SKETCH_BITS - BLOCK_BITS), "block").mapInArrow(_summed, "block int, counts binary").collect()
    counts = np.zeros((1 << (SKETCH_BITS - BLOCK_BITS), 1 << BLOCK_BITS), np.uint32)
    for r in found:
        counts[r["block"]] = np.frombuffer(r["counts"], np.uint32)
    return counts.reshape(-1)


# -- prefixes -----------------------------------------------------------------------


def least_overlap(n: int, percent: int) -> int:
    """The fewest shingles that a set of ``n`` shares with any it links with."""
    return -(-percent * n // 100)


def prefix_of(own: np.ndarray, counts: np.ndarray, usual: float, percent: int) -> tuple[np.ndarray, int]:
    """The prefix of a set, in the global order, and how many of its shingles must be shared."""
    n = len(own)
    least = least_overlap(n, percent)
    base = n - least + 1
    often = counts[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    length = min(n, base + MAX_NEED - 1)
    if length < n:
        first = np.argpartition(often, length - 1)[:length]
        own = own[often <= often[first].max()]
        often = counts[(own >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    order = np.lexsort((own, often))[:length]
    excess = float(np.maximum(often[order[:base]] - usual, 0).sum())
    need = 1 + int(np.log2(1 + excess / (base * (1 + usual))))
    need = max(1, min(need, MAX_NEED, least))
    return own[order[: base + need - 1]], need


def _prefixes(batches: Iterator[pa.RecordBatch], counts: Broadcast, size: int, percent: int) -> Iterator[pa.RecordBatch]:
    table = counts.value
    usual = float(table.mean())
    for batch in batches:
        n, need, s1, s2, prefix, bound, sketch = [], [], [], [], [], [0], []
        for own in row_sets(batch.column("text"), size):
            n.append(len(own))
            mix = mixed(own)
            s1.append(int(mix.sum(dtype=np.uint64).astype(np.int64)))
            s2.append(int(mixed(mix ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)))
            head, least = prefix_of(own, table, usual, percent) if len(own) else (own, 0)
            need.append(least)
            prefix.append(head)
            odd = np.bincount((mix >> np.uint64(1)).astype(np.int64) % (64 * SKETCH_LONGS), minlength=64 * SKETCH_LONGS) & 1
            sketch.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            bound.append(bound[-1] + len(head))
        flat = np.concatenate(prefix) if prefix else np.zeros(0, np.uint64)
        yield records(doc_id=batch.column("doc_id"), n=pa.array(n, pa.int64()), need=pa.array(need, pa.int32()), s1=pa.array(s1, pa.int64()), s2=pa.array(s2, pa.int64()), prefix=pa.ListArray.from_arrays(pa.array(bound, pa.int32()), pa.array(flat.view(np.int64))), sketch=pa.ListArray.from_arrays(pa.array(np.arange(0, SKETCH_LONGS * len(n) + 1, SKETCH_LONGS), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *sketch]))))


# -- verification ----------------------------------------------------------------------


def _some_sets(batches: Iterator[pa.RecordBatch], wanted: Broadcast, size: int) -> Iterator[pa.RecordBatch]:
    bits = np.frombuffer(wanted.value, np.uint8)
    for batch in batches:
        at = batch.column("slot").to_numpy()
        rows = np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1)
        if len(rows):
            some = batch.take(pa.array(rows))
            yield records(doc_id=some.column("doc_id"), own=pa.array([x.tobytes() for x in row_sets(some.column("text"), size)], pa.binary()))


def _overlaps(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for a, b in zip(batch.column("own_x").to_pylist(), batch.column("own_y").to_pylist(), strict=True):
            x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            if len(x) > len(y):
                x, y = y, x
            if not len(x) or 100 * len(x) < percent * len(y):
                keep.append(False)
                continue
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            shared = int((y[at] == x).sum())
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
        mask = pa.array(keep, pa.bool_())
        yield records(x=batch.column("x").filter(mask), y=batch.column("y").filter(mask))


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (x, y) of doc_ids whose sets link, from the whole sets.

    Documents are picked by a bitmap of the ids' hashes, of 1 MB at any size, so
    that only sets that some pair needs are shuffled; the join then is exact.
    """
    spark = docs.sparkSession
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << FILTER_BITS)) + 1  # noqa: E731  bitmap functions count from 1
    ids = pairs.select(F.explode(F.array("x", "y")).alias("id")).select(slot(F.col("id")).alias("slot"))
    parts = ids.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits")).collect()
    bits = bytearray((1 << FILTER_BITS) // 8)
    for r in parts:
        at = (r["bucket"] - 1) * len(r["bits"])
        bits[at : at + len(r["bits"])] = r["bits"]
    wanted = spark.sparkContext.broadcast(bytes(bits))
    near = docs.select("doc_id", "text", (slot(F.col("doc_id")) - 1).alias("slot"))
    sets = saved(near.mapInArrow(lambda b: tidy(_some_sets(b, wanted, size)), "doc_id long, own binary"), "sets")
    small_batches(spark, PAIR_ROWS)
    both = pairs.join(sets.select(F.col("doc_id").alias("x"), F.col("own").alias("own_x")), "x").join(sets.select(F.col("doc_id").alias("y"), F.col("own").alias("own_y")), "y")
    links = saved(both.select("x", "y", "own_x", "own_y").mapInArrow(lambda b: tidy(_overlaps(b, percent)), "x long, y long").distinct(), "links")
    small_batches(spark)
    discard(sets)
    return links


# -- the join -----------------------------------------------------------------------------


def _required(percent: int, nx: str, ny: str) -> Column:
    """The overlap that sets of these sizes need, exactly."""
    return -F.floor(-(F.col(nx) + F.col(ny)) * percent / (100.0 + percent) + 1e-9)


def _may_link(percent: int, need: Column) -> Column:
    """Length and position bounds of a shared prefix shingle at pos_x and pos_y (from 1)."""
    o = _required(percent, "nx", "ny")
    small, large = F.least("nx", "ny"), F.greatest("nx", "ny")
    return (100 * small >= percent * large) & (F.col("px") <= F.col("nx") - o + need) & (F.col("py") <= F.col("ny") - o + need)


def _sketches_allow(percent: int, x: str, y: str) -> Column:
    """Whether sets with these parity sketches can differ in as few shingles as a link allows."""
    bits = reduce(add, (F.bit_count(F.get(x, F.lit(i)).bitwiseXOR(F.get(y, F.lit(i)))) for i in range(SKETCH_LONGS)))
    return bits <= F.col("nx") + F.col("ny") - 2 * _required(percent, "nx", "ny")


def _sketches(heads: DataFrame, ids: DataFrame) -> DataFrame:
    """id and parity sketch of each of ``ids`` that has one set (a repeated id can have several)."""
    some = attach(heads.where("n > 0").select(F.col("doc_id").alias("id"), "s1", "s2", "sketch"), saved(ids, "open-ids"), ["id"], "left_semi", 24)
    one = some.groupBy("id").agg(F.first("sketch").alias("sketch"), F.min("s1").alias("a"), F.max("s1").alias("b"), F.min("s2").alias("c"), F.max("s2").alias("d"))
    return saved(one.where("a = b and c = d").select("id", "sketch"), "sketches")


def _banded(rows: DataFrame, percent: int, near: bool) -> DataFrame:
    """Rows with a ``band`` of set sizes where their list is long; with ``near`` one row for each band whose sets can link."""
    own = F.floor(F.ln("n") / F.ln(F.lit(100.0 / percent))).cast("long")
    if near:
        return rows.withColumn("band", F.explode(F.when(F.col("m") > BAND_FROM, F.array(own - 1, own, own + 1)).otherwise(F.array(F.lit(0).cast("long")))))
    return rows.withColumn("band", F.when(F.col("m") > BAND_FROM, own).otherwise(F.lit(0).cast("long")))


def near_components(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, n, rep) of the classes of equal sets, and labels (id, label) of the representatives that link."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = spark.sparkContext.broadcast(shingle_counts(rows, size))
    heads = saved(rows.mapInArrow(lambda b: tidy(_prefixes(b, counts, size, percent)), "doc_id long, n long, need int, s1 long, s2 long, prefix array<long>, sketch array<long>"), "prefixes")
    sized = heads.select("doc_id", "n", "s1", "s2")
    classes = saved(sized.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("rep")), "classes")
    members = saved(sized.join(classes, ["n", "s1", "s2"], "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep")), "members")
    # equal sets have equal prefixes: one row per class goes on, combined before the shuffle
    firsts = heads.where("n > 0").groupBy("n", "s1", "s2").agg(F.min_by(F.struct("doc_id", "need", "prefix"), "doc_id").alias("f"))
    tokens = firsts.select(F.col("f.doc_id").alias("id"), "n", F.col("f.need").alias("need"), F.posexplode("f.prefix").alias("at", "token"))
    tokens = tokens.select("token", "id", "n", "need", (F.col("at") + 1).alias("pos"))
    by_token = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min(F.struct((F.col("pos") / F.col("n")).alias("rank"), "id", "n", "pos", "need")).alias("lead")).where("m > 1")
    by_token = saved(by_token.select("token", F.col("lead.id").alias("lead"), F.col("lead.n").alias("ny"), F.col("lead.pos").alias("py"), F.col("lead.need").alias("lead_need")), "lists")
    lists = saved(tokens.join(by_token.select("token", "lead", "ny", "py", "lead_need"), "token"), "postings")
    discard(by_token, classes)
    led = lists.where("id <> lead").withColumnsRenamed({"n": "nx", "pos": "px"}).where(_may_link(percent, F.least("need", "lead_need")))
    shared = led.groupBy("id", "lead").agg(F.count(F.lit(1)).alias("shared"))
    best = shared.groupBy("id").agg(F.max(F.struct("shared", (-F.col("lead")).alias("o"), "lead")).alias("best"))
    first = saved(best.select(F.least("id", "best.lead").alias("x"), F.greatest("id", "best.lead").alias("y")).distinct(), "leaders")
    links = verified(first, rows, size, percent)
    labels = connected_components(links)
    now = lists.join(labels.withColumnRenamed("label", "c"), "id", "left").select("token", "id", F.col("n"), "need", "pos", F.coalesce("c", "id").alias("c"))
    now = saved(now, "labelled")
    discard(lists)
    open_ = now.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("n").alias("least"), F.count(F.lit(1)).alias("m")).where("lo < hi").select("token", "least", "m")
    left = now.join(open_, "token")
    # a shingle too far back for even the smallest partner in its list is left out
    small = F.greatest("least", F.ceil(F.col("n") * percent / 100.0))
    left = saved(left.where(F.col("pos") <= F.col("n") + F.floor(-(F.col("n") + small) * percent / (100.0 + percent) + 1e-9) + F.col("need")).drop("least"), "open")
    left = attach(left, _sketches(heads, left.select("id").distinct()), ["id"], "left", 128)
    x = _banded(left, percent, False).select("token", "band", F.col("id").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px"), F.col("need").alias("need_x"), F.col("c").alias("cx"), F.col("sketch").alias("sx"))
    y = _banded(left, percent, True).select("token", "band", F.col("id").alias("y"), F.col("n").alias("ny"), F.col("pos").alias("py"), F.col("need").alias("need_y"), F.col("c").alias("cy"), F.col("sketch").alias("sy"))
    need = F.least("need_x", "need_y")
    may = (F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy")) & _may_link(percent, need) & F.coalesce(_sketches_allow(percent, "sx", "sy"), F.lit(True))
    pairs = x.join(y, ["token", "band"]).where(may)
    pairs = pairs.groupBy("x", "y").agg(F.count(F.lit(1)).alias("k"), F.first(need).alias("need")).where("k >= need").select("x", "y")
    pairs = saved(pairs.join(first, ["x", "y"], "left_anti"), "candidates")
    discard(heads, now, first)
    more = verified(pairs, rows, size, percent)
    labels = saved(connected_components(links.unionByName(more)), "labels")
    discard(pairs, links, more)
    return members, labels


def near_join(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    members, labels = near_components(docs, size, percent)
    out = members.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("label", "rep").alias("component_id"))
    lost = docs.where("doc_id is null").select(F.col("doc_id").cast("long"), F.lit(0).cast("long").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"))
    return out.unionByName(lost)
