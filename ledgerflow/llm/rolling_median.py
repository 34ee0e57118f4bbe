"""Exact medians and median absolute deviations over the last hour of a series.

Clicks of one kind are a series. Each click enters its window at its own time and
leaves it just after ``minutes``; these two events, the two time pointers, are
range-partitioned by series and time and cut into chunks of at most CHUNK_EVENTS. A chunk's
halo is what it needs from others: how often each number of cents is in the window as
its part begins, from running sums of what each part adds and takes away, and
how often each is among clicks of its last moment that lie in later chunks. So
however many clicks one kind, hour or moment has, a task holds one chunk and the
distinct cents of a window at once.

Within a chunk cents are compressed to ranks and a Fenwick tree counts them. A
descent finds the middle two, bisection of the radius with range counts the middle
deviations. Chunks are cut into lanes that are stepped through together, each with
a tree of its own, so that numpy works on many clicks at once.

Clicks without ts go. Of rows that repeat a click_id the first by ts, kind and cents
counts (nulls last); rows without click_id count as one click. A value that is no number or beyond
2**50 cents has no cents, like a null one. Ties of time share their window; ties
of cents are all counted. Empty tables give no rows; only click_id, ts, kind and
value are read, so other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import attach, saved, small_batches, tidy

#: Events of a chunk, a power of two, and of a part (a range partition) of chunks.
CHUNK_EVENTS, PART_EVENTS = 1 << 17, 1 << 18
_CHUNK_BITS, _PART_BITS = 17, 33 - 17  # monotonically_increasing_id has 33 bits of row number
MOST_CENTS = 1 << 50
#: Cells of the trees of all lanes together, lanes at most, and events of a lane at least.
CELLS, LANES, LANE_EVENTS = 1 << 21, 1024, 64
HALO, CLICK, ASKS, LEAVES = 0, 1, 2, 3
RESULT = "click_id long, series string, n long, median2 long, mad4 long, far boolean"


# -- the trees of a chunk ---------------------------------------------------------


class Trees:
    """Fenwick trees over the ranks of cents in each lane."""

    def __init__(self, cents: np.ndarray, lane: np.ndarray, count: np.ndarray, lanes: int):
        """Counts of cents at the start of each lane; a count of 0 names cents that come later."""
        self.low = int(cents.min()) if len(cents) else 0
        self.span = (int(cents.max()) if len(cents) else 0) - self.low + 3
        key, at = np.unique(lane * self.span + (cents - self.low), return_inverse=True)
        self.keys, self.cents = key, key % self.span + self.low
        own = key // self.span
        self.first = np.searchsorted(own, np.arange(lanes + 1))
        width = max(1, int(np.diff(self.first).max(initial=0)))
        self.levels = int(width).bit_length()
        size = 1 << self.levels
        self.stride = size + 1
        begun = np.zeros((lanes, size), np.int64)
        np.add.at(begun, (lane, at - self.first[lane]), count)
        sums = np.zeros((lanes, size + 1), np.int64)
        np.cumsum(begun, axis=1, out=sums[:, 1:])
        i = np.arange(1, size + 1)
        tree = np.zeros((lanes, self.stride), np.int64)
        tree[:, 1:] = sums[:, 1:] - sums[:, i - (i & -i)]
        self.tree, self.size = tree.reshape(-1), size

    def rank(self, lane: np.ndarray, cents: np.ndarray) -> np.ndarray:
        """How many distinct cents of the lane are at most ``cents``."""
        return np.searchsorted(self.keys, lane * self.span + np.clip(cents - self.low, -1, self.span - 2), "right") - self.first[lane]

    def add(self, lane: np.ndarray, rank: np.ndarray, delta: np.ndarray) -> None:
        """Add to one cell of each of these lanes, which are distinct."""
        base, i = lane * self.stride, rank + 1
        while len(i):
            self.tree[base + i] += delta
            i = i + (i & -i)
            if (over := i > self.size).any():
                stay = ~over
                base, i, delta = base[stay], i[stay], delta[stay]

    def upto(self, lane: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """Counts of the first ``rank`` cents; cell 0 of a tree is 0, so lanes that are done add nothing."""
        base, i = lane * self.stride, rank
        out = self.tree.take(base + i)
        i = i & (i - 1)
        while i.any():
            out += self.tree.take(base + i)
            i = i & (i - 1)
        return out

    def nth(self, lane: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The cents that ``n`` others precede."""
        base, left = lane * self.stride, n
        at = base
        for b in range(self.levels - 1, -1, -1):
            there = self.tree.take(at + (1 << b))
            go = there <= left
            at = at + (go << b)
            left = left - there * go
        return self.cents.take(np.minimum(self.first[lane] + (at - base), len(self.cents) - 1))


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return x[: len(x) // 2], x[len(x) // 2 :]


def medians(trees: Trees, lane: np.ndarray, n: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The doubled median and the doubled median of doubled deviations of lanes with ``n`` >= 1 cents, and the radius found.

    ``near`` is a guess of each radius, the lane's last one, from which the range of the bisection follows.
    """
    two = np.concatenate([lane, lane])
    k1, k2 = (n - 1) >> 1, n >> 1
    m1, m2 = halves(trees.nth(two, np.concatenate([k1, k2])))
    median2 = m1 + m2
    odd = median2 & 1

    def counts(r: np.ndarray, lane2: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many cents are below, and how many not above the range of radius ``r``."""
        return halves(trees.upto(lane2, trees.rank(lane2, np.concatenate([(m - r - 1) >> 1, (m + r) >> 1]))))

    # Deviations have the median's parity. The guess holds ``extra`` cents more than are asked for; so many
    # can go from either end, or as many must come from one, which bounds the radius on both sides.
    guess = near - ((near ^ odd) & 1)
    guess = np.where(guess < 0, guess + 2, guess)
    below, upto = counts(guess, two, median2)
    extra = upto - below - (k1 + 1)
    left, right = halves(trees.nth(two, np.concatenate([np.maximum(below + extra, 0), np.minimum(upto - 1 - extra, n - 1)])))
    left, right = median2 - 2 * left, 2 * right - median2
    wide = extra >= 0
    low = np.where(wide, np.maximum(np.maximum(left, right), odd), guess + 2)
    high = np.where(wide, guess, np.minimum(left, right))
    high = np.where(extra == 0, low, high)
    low = np.where(extra == -1, high, low)
    low, high = (low - odd) >> 1, (high - odd) >> 1
    todo = np.flatnonzero(low < high)
    while len(todo):
        mid = (low[todo] + high[todo]) >> 1
        b, u = counts(2 * mid + odd[todo], np.concatenate([lane[todo], lane[todo]]), median2[todo])
        enough = u - b > k1[todo]
        high[todo] = np.where(enough, mid, high[todo])
        low[todo] = np.where(enough, low[todo], mid + 1)
        todo = todo[low[todo] < high[todo]]
    radius = 2 * high + odd
    second = radius.copy()
    if len(even := np.flatnonzero(k1 != k2)):
        m = median2[even]
        b, u = counts(radius[even], np.concatenate([lane[even], lane[even]]), m)
        if len(more := np.flatnonzero(u - b <= k2[even])):
            b, u, who = b[more], u[more], even[more]
            down, up = halves(trees.nth(np.concatenate([lane[who], lane[who]]), np.concatenate([np.maximum(b - 1, 0), np.minimum(u, n[who] - 1)])))
            none = np.iinfo(np.int64).max
            second[who] = np.minimum(np.where(b > 0, median2[who] - 2 * down, none), np.where(u < n[who], 2 * up - median2[who], none))
    return median2, radius + second, radius


def expanded(cents: np.ndarray, lane: np.ndarray, delta: np.ndarray, lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What each lane holds as it begins, from changes of the counts by lane (lane -1: before all)."""
    order = np.lexsort((lane, cents))
    cents, lane, delta = cents[order], lane[order], delta[order]
    new = np.ones(len(cents), bool)
    new[1:] = cents[1:] != cents[:-1]
    sums = np.cumsum(delta)
    first = np.flatnonzero(new)
    sums -= np.repeat(np.append(0, sums)[first], np.diff(np.append(first, len(cents))))
    ends = np.full(len(cents), lanes - 1)
    ends[:-1] = np.where(new[1:], lanes - 1, lane[1:])
    times = np.where(sums > 0, np.maximum(ends - lane, 0), 0)
    which = np.repeat(np.arange(len(cents)), times)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    return cents[which], lane[which] + 1 + nth, sums[which]


def summed(cents: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct cents and the sums of their counts that are not 0."""
    u, at = np.unique(cents, return_inverse=True)
    sums = np.zeros(len(u), np.int64)
    np.add.at(sums, at, count)
    return u[sums != 0], sums[sums != 0]


def chunk_medians(at: np.ndarray, what: np.ndarray, cents: np.ndarray, has: np.ndarray, count: np.ndarray, held: tuple[np.ndarray, np.ndarray]):
    """For each event n, median2 and mad4 of its moment (valid on clicks), and the cents held after the chunk.

    Events come in order of time, arrivals first; ``count`` is what an event adds.
    """
    m = len(at)
    count = np.where(has, count, 0)
    here = np.append(0, np.cumsum(count)) + int(held[1].sum())
    # a moment is asked once, after the last of its events that is no leaving
    stays = what < LEAVES
    last = np.ones(m, bool)
    last[:-1] = (at[1:] != at[:-1]) | ~stays[1:]
    last &= stays
    moment = np.searchsorted(np.flatnonzero(last), np.arange(m))
    asked = last.copy()
    clicks = np.bincount(moment[(what == CLICK) | (what == ASKS)], minlength=int(last.sum()))
    asked[np.flatnonzero(last)[clicks[: int(last.sum())] == 0]] = False
    n = here[1:]
    asked &= n >= 2

    most = min(int(here.max()), len(held[0]) + m)
    lanes = int(np.clip(min(CELLS // (most + LANE_EVENTS), -(-m // LANE_EVENTS)), 1, LANES))
    steps = -(-m // lanes)
    lane = np.arange(m) // steps
    lanes = int(lane[-1]) + 1
    e_cents, e_lane, e_count = cents[has], lane[has], count[has]
    c0, l0, n0 = expanded(np.append(held[0], e_cents), np.append(np.full(len(held[0]), -1), e_lane), np.append(held[1], e_count), lanes)
    trees = Trees(np.append(c0, e_cents), np.append(l0, e_lane), np.append(n0, np.zeros_like(e_count)), lanes)
    rank = np.zeros(m, np.int64)
    rank[has] = trees.rank(e_lane, e_cents) - 1
    median2, mad4, near = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(lanes, np.int64)
    for s in range(steps):
        event = np.arange(s, m, steps)
        if len(moved := event[count[event] != 0]):
            trees.add(lane[moved], rank[moved], count[moved])
        if len(ask := event[asked[event]]):
            own = lane[ask]
            median2[ask], mad4[ask], near[own] = medians(trees, own, n[ask], near[own])
    # every event gets its moment's answer; leaving events get none that is used
    answer = np.append(np.flatnonzero(last), m - 1)[moment]
    return n[answer], median2[answer], mad4[answer], summed(np.append(held[0], e_cents), np.append(held[1], e_count))


def stepped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Answers of the clicks of parts, whose rows come sorted by part, series, chunk (the halo first), time and kind of event."""
    state: dict = {"key": None, "held": None, "chunk": None, "rows": []}

    def flush() -> Iterator[pa.RecordBatch]:
        rows, state["rows"] = state["rows"], []
        if not rows:
            return
        t = pa.Table.from_batches(rows).combine_chunks()
        values = lambda c, fill=0: pc.fill_null(t.column(c), fill).to_numpy()
        cents, has = values("cents"), pc.is_valid(t.column("cents")).to_numpy()
        tie = values("tie")
        if state["chunk"] is None:
            state["held"] = summed(cents[has], tie[has])
            return
        what = values("what")
        count = np.select([what == HALO, what == CLICK, what == LEAVES], [tie, 1, -1], 0)
        at = pc.cast(t.column("at"), pa.int64()).to_numpy()
        n, median2, mad4, state["held"] = chunk_medians(at, what, cents, has, count, state["held"])
        own = (what == CLICK) | (what == ASKS)
        n, median2, mad4, cents, has = n[own], median2[own], mad4[own], cents[own], has[own]
        few = n < 2
        far = 2 * np.abs(2 * cents - median2) > 3 * mad4
        ids = t.column("tie").filter(pa.array(own)).combine_chunks()
        yield pa.RecordBatch.from_pydict({"click_id": ids, "series": pa.array([state["key"][1]], pa.string()).take(pa.array(np.zeros(len(n), np.int32))), "n": n, "median2": pa.array(median2, mask=few), "mad4": pa.array(mad4, mask=few), "far": pa.array(far, mask=few | ~has)})

    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for name in ("part", "series", "chunk"):
            c = batch.column(name)
            c = pc.fill_null(c, -1) if name == "chunk" else c
            new[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
        starts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for lo, hi in zip(starts, starts[1:], strict=False):
            key, chunk = (batch.column("part")[lo].as_py(), batch.column("series")[lo].as_py()), batch.column("chunk")[lo].as_py()
            if (key, chunk) != (state["key"], state["chunk"]):
                yield from flush()
                if key != state["key"]:
                    state["held"] = (np.zeros(0, np.int64), np.zeros(0, np.int64))
                state["key"], state["chunk"] = key, chunk
            state["rows"].append(batch.slice(lo, hi - lo))
    yield from flush()


# -- the plan ---------------------------------------------------------------------


def clicks_once(clicks: DataFrame) -> DataFrame:
    """click_id, series (a string that is never null), at and cents of every click, once."""
    value = F.col("value").cast("double")
    cents = F.floor(100 * value + 0.5)
    there = ~F.isnan(value) & (F.abs(100 * value) < float(MOST_CENTS))
    rows = clicks.where("ts is not null").select(F.col("click_id").cast("long").alias("click_id"), F.coalesce(F.concat(F.lit("k"), F.col("kind").cast("string")), F.lit("")).alias("series"), F.col("ts").cast("timestamp_ntz").alias("at"), F.when(there, cents).cast("long").alias("cents"))
    first = Window.partitionBy("click_id").orderBy("at", F.col("series") == "", "series", F.col("cents").asc_nulls_last())
    return rows.withColumn("nth", F.row_number().over(first)).where("nth = 1").drop("nth")


def _event(what: int, at: Column, tie: Column) -> Column:
    return F.struct(F.lit(what).cast("byte").alias("what"), at.alias("at"), tie.alias("tie"), F.col("cents"))


def chunked_events(clicks: DataFrame, minutes: int, parts: int) -> DataFrame:
    """Arrivals and leavings in order of series and time, with the number of their chunk, written once so that it stays the same."""
    leaves = F.when(F.col("cents").isNotNull(), _event(LEAVES, F.col("at") + F.expr(f"INTERVAL '{minutes}' MINUTE"), F.pmod("click_id", F.lit(1024)).cast("long")))
    events = clicks_once(clicks).select("series", F.explode(F.array(_event(CLICK, F.col("at"), F.col("click_id")), leaves)).alias("e")).where("e is not null").select("series", "e.*")
    order = ["series", "at", "what", "tie"]
    ranged = events.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return saved(ranged.withColumn("chunk", F.shiftright(F.monotonically_increasing_id(), _CHUNK_BITS)), "events")


def split_moments(events: DataFrame) -> DataFrame:
    """series, at and first chunk of the moments whose clicks lie in several chunks."""
    ends = events.where(f"what = {CLICK}").groupBy("series", "chunk").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    ends = ends.select("series", "chunk", F.explode(F.array_distinct(F.array("lo", "hi"))).alias("at"))
    return ends.groupBy("series", "at").agg(F.count(F.lit(1)).alias("chunks"), F.min("chunk").alias("lead")).where("chunks > 1").drop("chunks")


def part_of(chunk: Column) -> Column:
    return F.shiftright(chunk, _PART_BITS).cast("int")


def halo(events: DataFrame) -> DataFrame:
    """How often each number of cents is in the window as each part begins."""
    where = part_of(F.coalesce("lead", "chunk")).alias("part")
    delta = F.when(F.col("what") == LEAVES, -1).otherwise(1)
    net = events.where("cents is not null").groupBy("series", "cents", where).agg(F.sum(delta).alias("net"))
    run = Window.partitionBy("series", "cents").orderBy("part")
    held = net.select("series", "cents", "part", F.sum("net").over(run).alias("tie"), F.lead("part").over(run).alias("until")).where("tie > 0 and until is not null")
    return held.select(F.explode(F.sequence(F.col("part") + 1, "until")).alias("part"), "series", "cents", "tie")


def rolling_median(clicks: DataFrame, minutes: int = 60) -> DataFrame:
    """click_id, kind, n, median2, mad4 and far of every click that has a ts."""
    spark = clicks.sparkSession
    small_batches(spark, 10_000)
    parts = max(1, -(-2 * clicks.count() // PART_EVENTS))
    events = chunked_events(clicks, minutes, parts)
    split = saved(split_moments(events), "split-moments")
    if split.isEmpty():
        events, late = events.withColumn("lead", F.lit(None).cast("long")), None
    else:
        lead = F.when((F.col("what") == CLICK) & (F.col("lead") < F.col("chunk")), F.col("lead"))
        events = attach(events, split, ["series", "at"], "left", 64).withColumn("lead", lead)
        late = events.where("lead is not null and cents is not null").groupBy("series", "lead", "at", "cents").agg(F.count(F.lit(1)).alias("tie"))
        late = late.select("series", F.col("lead").alias("chunk"), "at", F.lit(HALO).cast("byte").alias("what"), "tie", "cents")
    own = events.select("series", "chunk", "at", F.when(F.col("lead").isNotNull(), F.lit(ASKS)).otherwise(F.col("what")).cast("byte").alias("what"), "tie", "cents")
    own = own if late is None else own.unionByName(late)
    begin = halo(events).select("part", "series", F.lit(None).cast("long").alias("chunk"), F.lit(None).cast("timestamp_ntz").alias("at"), F.lit(HALO).cast("byte").alias("what"), "tie", "cents")
    rows = own.withColumn("part", part_of(F.col("chunk"))).unionByName(begin)
    n = events.agg(F.coalesce(F.max(part_of(F.col("chunk"))), F.lit(0)) + 1).first()[0]
    dealt = rows.repartitionById(n, F.col("part")).sortWithinPartitions("part", "series", "chunk", "at", "what")
    out = dealt.mapInArrow(lambda batches: tidy(stepped(batches)), RESULT)
    return out.select("click_id", F.when(F.col("series") != "", F.substring("series", 2, 1 << 30)).alias("kind"), "n", "median2", "mad4", "far")


#: The same rows in DuckDB SQL over clicks.
ROLLING_MEDIAN_SQL = """
WITH once AS (
  SELECT click_id, kind, ts, CASE WHEN NOT isnan(value) AND abs(100 * value) < 1125899906842624 THEN floor(100 * value + 0.5)::BIGINT END AS cents
  FROM clicks WHERE ts IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY click_id ORDER BY ts, kind NULLS LAST, cents NULLS LAST) = 1
), w AS (
  SELECT click_id, kind, cents, list_sort(coalesce(list(cents) FILTER (cents IS NOT NULL) OVER (PARTITION BY kind ORDER BY ts RANGE BETWEEN INTERVAL 60 MINUTE PRECEDING AND CURRENT ROW), [])) AS l FROM once
), m AS (
  SELECT *, len(l)::BIGINT AS n, CASE WHEN len(l) >= 2 THEN l[(len(l) + 1) // 2] + l[len(l) // 2 + 1] END AS median2 FROM w
), d AS (
  SELECT *, list_sort([abs(2 * x - median2) for x in l]) AS dev FROM m
), a AS (
  SELECT *, CASE WHEN n >= 2 THEN dev[(n + 1) // 2] + dev[n // 2 + 1] END AS mad4 FROM d
)
SELECT click_id, kind, n, median2, mad4, 2 * abs(2 * cents - median2) > 3 * mad4 AS far FROM a
"""
