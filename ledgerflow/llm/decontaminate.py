"""Benchmark decontamination by spaced seeds, in DataFrame operations only.

A mask over up to seven tokens ignores some positions, so a substituted token
under an ignored position does not hide a match. Every window of the benchmark
and of the documents is hashed under each mask; equal hashes are hits. A mask's first two places go first:
only windows whose pair of tokens some benchmark window has are hashed whole. Around a
hit the item's tokens are laid over the document on the hit's diagonal and the
equal tokens counted, so substitutions are tolerated. Hits are counted on each
diagonal first, and only those with as many as an overlap must have are laid over; texts join them once, so that no
token array is copied for a window or a hit. An item leaked if one
diagonal covers ``min_cover`` of it; or if all diagonals with DENSE_LEAST equal
tokens of DENSE in a row cover that much together; or if one has a stretch of
STRETCH tokens of which at most STRETCH_LESS are replaced, however long the item.

With ``min_cover`` of a half the masks miss nothing of this: they are all choices
of three of six successive tokens, and a row of tokens of which at least half are
equal has such three, unless it is shorter than five or is the one pattern
11000011, for which there is a mask of span seven.

Tokens are the lower-cased runs of letters and digits. An overlap has three equal
tokens at least; items of one or two must occur whole, items without tokens match
nothing. Null and empty texts are never contaminated. Rows that repeat a doc_id,
or have none, are judged each by their own text; equal rows alike, ties of items
are all reported. Empty tables give no leaks; columns of ``docs`` other than
doc_id and text pass through ``with_leaks`` (the pipeline folds them away first). The benchmark's seeds are
broadcast in blocks of at most BROADCAST_BYTES, one pass over the documents each.
"""

from __future__ import annotations

from functools import cache, reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_BYTES, attach, row_key, saved

#: Positions that count: any three of six in a row, and the ends of 11000011.
MASKS = (*("".join("1" if i in (0, a, b) else "0" for i in range(b + 1)) for b in range(2, 6) for a in range(1, b)), "1100001")
WEIGHT = 3
DENSE, DENSE_LEAST = 10, 7
MIN_COVER = 0.5
STRETCH, STRETCH_LESS = 13, 2
SEED_BYTES, PAIR_BYTES = 64, 32
#: What tells documents apart; a null id is a flag, as any number may be an id.
KEYS = ["no_id", "doc_key", "row_key"]


def token_hashes(text: str = "text") -> Column:
    tokens = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", -1), "")
    return F.transform(tokens, lambda t: F.xxhash64(t))


def _places() -> dict[int, list[int]]:
    """The third places of the masks by their second place; the first place is 0."""
    out: dict[int, list[int]] = {}
    for m in MASKS:
        _, a, b = (i for i, c in enumerate(m) if c == "1")
        out.setdefault(a, []).append(b)
    return out


def _exploded(rows: DataFrame, name: str, choices: list[Column]) -> DataFrame:
    """A row for each choice that is not null."""
    return rows.select("*", F.explode(F.array(*choices)).alias(name)).where(F.col(name).isNotNull())


def paired(rows: DataFrame) -> DataFrame:
    """A row for each position ``at`` of ``h`` and second place: ``t``, the place ``a`` and the hash ``pair`` of both tokens."""
    placed = rows.select("*", F.posexplode("h").alias("at", "t"))
    pair = lambda a: F.when(F.col("at") + a < F.size("h"), F.struct(F.lit(a).alias("a"), F.xxhash64(F.lit(a), "t", F.get("h", F.col("at") + a)).alias("pair")))
    return _exploded(placed, "p", [pair(a) for a in _places()]).select("*", "p.*").drop("p")


def tripled(rows: DataFrame) -> DataFrame:
    """``paired`` rows by third place, without the tokens: ``key`` is the hash under one mask."""
    places = _places()
    third = lambda b: F.when(F.col("a").isin(*(a for a in places if b in places[a])) & (F.col("at") + b < F.size("h")), F.xxhash64(F.lit(b), "pair", F.get("h", F.col("at") + b)))
    return _exploded(rows, "key", [third(b) for b in sorted({b for x in places.values() for b in x})]).drop("pair", "a", "t", "h")


def whole_keys(rows: DataFrame, short: list[int]) -> DataFrame:
    """A row for each run of so few tokens as whole short items have, without the tokens."""
    placed = rows.select("*", F.posexplode("h").alias("at", "t"))
    run = lambda n: F.when(F.col("at") + n <= F.size("h"), F.xxhash64(F.lit(-n), *(F.get("h", F.col("at") + i) for i in range(n))))
    return _exploded(placed, "key", [run(n) for n in short]).drop("t", "h")


def fewest_hits(length: int, equal: int) -> int:
    """The least number of windows under the masks that ``equal`` of ``length`` successive tokens can give."""
    spans = [tuple(i for i, c in enumerate(m) if c == "1") for m in MASKS]
    windows = [sum(1 << (at + i) for i in m) for m in spans for at in range(length - m[-1])]
    return min(sum(p & w == w for w in windows) for p in (sum(1 << i for i in c) for c in combinations(range(length), equal)))


@cache
def _bounds() -> tuple[int, int]:
    """Hits of a dense run or stretch at least; and whether each block of ten adds a hit for every equal token beyond four."""
    return min(fewest_hits(DENSE, DENSE_LEAST), fewest_hits(STRETCH, STRETCH - STRETCH_LESS)), all(fewest_hits(10, k) >= k - 4 for k in range(5, 11))


def hits_needed(n: Column, min_cover: float) -> Column:
    """How many hits a diagonal has at least if its item of ``n`` tokens leaks by it.

    A dense run or stretch has the number found by trying all patterns. Else ``min_cover``
    of the item is equal: of its blocks of ten each gives a hit for every
    equal token beyond four, so the blocks together one for each beyond four times their number.
    """
    run, each = _bounds()
    blocks = F.floor(n / 10)
    cover = F.ceil(n * min_cover) - (n - 10 * blocks) - 4 * blocks if each else F.lit(1)
    return F.greatest(F.lit(1), F.least(F.lit(run), cover))


def dense(equal: Column, tokens: int, least: int) -> Column:
    """Whether some run of ``tokens`` positions has at least ``least`` of the ascending positions in ``equal``."""
    return F.exists(F.sequence(F.lit(0), F.size(equal)), lambda i: F.coalesce(F.get(equal, i + (least - 1)) - F.get(equal, i) < tokens, F.lit(False)))


def find_leaks(docs: DataFrame, benchmark: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    """The keys of ``docs``, item_id and the share of the item's tokens found, for each leaked item; a long stretch counts whatever that share."""
    items = benchmark.where("item_id is not null").select("item_id", token_hashes().alias("h")).where(F.size("h") > 0).distinct()
    items = saved(items.withColumn("item_row", F.xxhash64("item_id", "h")), "benchmark-items")
    item_bytes = 64 + 8 * (items.agg(F.coalesce(F.max(F.size("h")), F.lit(0))).first()[0])
    long = paired(items.where(F.size("h") >= WEIGHT).select("item_row", "h"))
    seeds = tripled(long).select("key", "item_row", F.col("at").alias("item_at"))
    short = sorted(r[0] for r in items.where(F.size("h") < WEIGHT).select(F.size("h")).distinct().collect())
    for n in short:
        own = whole_keys(items.where(F.size("h") == n).select("item_row", "h"), [n])
        seeds = seeds.unionByName(own.select("key", "item_row", F.col("at").alias("item_at")))
    seeds = saved(seeds.distinct(), "benchmark-seeds")
    blocks = max(1, -(-seeds.count() * SEED_BYTES // BROADCAST_BYTES))
    pairs = saved(long.select("pair").distinct(), "benchmark-pairs")
    rows = docs.select(*KEYS, token_hashes().alias("h"))
    begun = paired(rows)
    if pairs.count() * PAIR_BYTES <= BROADCAST_BYTES:
        begun = begun.join(F.broadcast(pairs), "pair", "left_semi")
    windows = tripled(begun)
    if short:
        windows = windows.unionByName(whole_keys(rows, short))
    shift = F.col("at") - F.col("item_at")
    found = []
    for b in range(blocks):
        mine = (F.pmod("item_row", F.lit(blocks)) == b) if blocks > 1 else F.lit(True)
        hits = windows.join(F.broadcast(seeds.where(mine)), "key")
        found.append(hits.groupBy(*KEYS, "item_row", shift.alias("shift")).agg(F.count(F.lit(1)).alias("hits")))
    sizes = items.select("item_row", hits_needed(F.size("h"), min_cover).alias("needed"))
    likely = attach(reduce(DataFrame.unionByName, found), sizes, ["item_row"], "inner", 24).where("hits >= needed")
    likely = likely.groupBy(*KEYS, "item_row").agg(F.collect_list("shift").alias("shifts")).groupBy(*KEYS).agg(F.collect_list(F.struct("item_row", "shifts")).alias("on"))
    likely = saved(likely, "diagonals")
    # most documents of plain language have some diagonal, so this is a merge join at any size
    texts = docs.select(*KEYS, "text").join(likely.hint("merge"), KEYS)
    on = texts.select(*KEYS, token_hashes().alias("h"), "on").select(*KEYS, "h", F.explode("on").alias("o")).select(*KEYS, "h", "o.item_row", "o.shifts")
    on_item = attach(on, items.select("item_row", "item_id", F.col("h").alias("item_h")), ["item_row"], "inner", item_bytes).select("*", F.explode("shifts").alias("shift"))
    equal = F.filter(F.sequence(F.lit(0), F.size("item_h") - 1), lambda t: (t + F.col("shift") >= 0) & F.coalesce(F.get(F.col("h"), t + F.col("shift")) == F.get(F.col("item_h"), t), F.lit(False)))
    # the generator is a barrier: the tokens are compared once a diagonal, not once a use of the result
    hits = on_item.select(*KEYS, "item_row", "item_id", F.size("item_h").alias("n"), "shift", F.explode(F.array(equal)).alias("equal"))
    own = F.size("equal") / F.col("n")
    alone = (own >= min_cover) | dense(F.col("equal"), STRETCH, STRETCH - STRETCH_LESS)
    hits = hits.withColumns({"own": own, "alone": alone, "dense": dense(F.col("equal"), DENSE, DENSE_LEAST)}).where("alone or dense")
    diagonals = hits.groupBy(*KEYS, "item_row", "shift").agg(*(F.first(c).alias(c) for c in ("item_id", "n", "equal", "own", "alone", "dense")))
    together = F.size(F.array_distinct(F.flatten(F.collect_list(F.when(F.col("dense"), F.col("equal")))))) / F.first("n")
    cover = diagonals.groupBy(*KEYS, "item_row").agg(F.first("item_id").alias("item_id"), F.greatest(together, F.max("own")).alias("cover"), F.bool_or("alone").alias("alone"))
    return cover.where((F.col("cover") >= min_cover) | F.col("alone")).drop("item_row", "alone")


def with_leaks(docs: DataFrame, benchmark: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    """All rows of ``docs`` with item_ids and cover, null where nothing leaked."""
    keyed = docs.withColumns({"no_id": F.col("doc_id").isNull(), "doc_key": F.coalesce("doc_id", F.lit(0)).cast("long"), "row_key": row_key()})
    leaks = find_leaks(keyed, benchmark, min_cover)
    by_row = saved(leaks.groupBy(*KEYS).agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"), F.max("cover").alias("cover")), "leaks")
    return attach(keyed, by_row, KEYS, "left", 96)


def decontaminate(docs: DataFrame, benchmark: DataFrame, min_cover: float = MIN_COVER) -> DataFrame:
    """doc_id, contaminated, kept, the leaked item_ids and the largest cover of every document."""
    rows = with_leaks(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")), benchmark, min_cover)
    leaked = F.col("item_ids").isNotNull()
    return rows.select("doc_id", leaked.alias("contaminated"), (~leaked).alias("kept"), F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), F.coalesce("cover", F.lit(0.0)).alias("cover"))
