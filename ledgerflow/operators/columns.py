"""Tables without rules and pages set in columns, from the places of words, as jobs over words.

``words`` are rows: the columns that name a page (``keys``), ``ord`` (the word's place in the
source), text, x0, x1, top and bottom, in points. Medians are grouped by page; baselines are a
fold over a page's words in order; cells, grids and gutters are windows and running sums over rows
and bins. A page is one group of each step, and no step leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import is_numeric, strip
from .geometry import LINE, TABLE
from .storage import written

#: The least words, rows and columns of a table; edges agree within X_TOL; so many rows hold numbers; so far up go headings.
MIN_WORDS, MIN_ROWS, MIN_COLS, X_TOL, NUMERIC_SHARE, LOOK_BACK = 10, 3, 2, 8.0, 0.5, 4
#: A gap between cells in characters, and the least one; rows agree within half a word's height, and the least tolerance; a character's width where none has ink.
GAP_CHARS, MIN_GAP, ROW_SHARE, MIN_ROW_TOL, CHAR = 2.2, 5.0, 0.5, 1.5, 3.0
#: Pages in columns: the least words, bin width, share of rows that may cross a gutter, its least share of the width, the least share of words beside it, where it may lie.
COLUMN_WORDS, BIN, CROSSING, GUTTER, SIDE, MIDDLE = 20, 2.0, 0.15, 0.04, 0.15, (0.2, 0.8)
#: Running text: words a row, and the share of rows that may be all numbers.
PROSE_WORDS, PROSE_NUMERIC = 4.0, 0.5


def exploded_words(pages: DataFrame, keys: list[str], words: str = "words") -> DataFrame:
    """The words of pages that hold them as an array."""
    rows = pages.select(*keys, F.posexplode(words).alias("ord", "w"))
    return rows.select(*keys, "ord", F.coalesce("w.text", F.lit("")).alias("text"), *(F.col(f"w.{c}").cast("double").alias(c) for c in ("x0", "x1", "top", "bottom")))


# -- rows and cells -----------------------------------------------------------------


def rows_of_words(words: DataFrame, keys: list[str]) -> DataFrame:
    """Words with ``row``, their baseline's number, ``place`` within the page, and the page's ``gap`` and ``n_words``.

    A row takes the words within a tolerance of its first word's top.
    """
    inked = strip(F.col("text")) != ""
    width = F.when(inked, (F.col("x1") - F.col("x0")) / F.length("text"))
    word = F.struct(F.bround("top", 1).alias("level"), "x0", "ord", "top", "x1", "bottom", "text")
    page = words.groupBy(*keys).agg(F.median(F.col("bottom") - F.col("top")).alias("h"), F.median(width).alias("cw"), F.count(F.lit(1)).alias("n_words"), F.array_sort(F.collect_list(word)).alias("ws"))
    tolerance = F.greatest(F.lit(MIN_ROW_TOL), F.col("h") * ROW_SHARE)
    begin = F.struct(F.lit(None).cast("double").alias("base"), F.lit(0).alias("n"), F.array().cast("array<int>").alias("rows"))

    def step(a: Column, w: Column) -> Column:
        fresh = F.coalesce(F.abs(w["top"] - a["base"]) > tolerance, F.lit(False))
        n = a["n"] + fresh.cast("int")
        return F.struct(F.when(a["base"].isNull() | fresh, w["top"]).otherwise(a["base"]).alias("base"), n.alias("n"), F.concat(a["rows"], F.array(n)).alias("rows"))

    rows = F.aggregate("ws", begin, step, lambda a: a["rows"])
    gap = F.greatest(F.lit(MIN_GAP), F.coalesce("cw", F.lit(CHAR)) * GAP_CHARS)
    placed = page.select(*keys, "n_words", gap.alias("gap"), F.posexplode(F.arrays_zip(F.col("ws").alias("w"), rows.alias("row"))).alias("place", "z"))
    return placed.select(*keys, "n_words", "gap", "place", F.col("z.row").alias("row"), *(F.col(f"z.w.{c}").alias(c) for c in ("text", "x0", "x1", "top", "bottom")))


def _line(order: list[str]) -> list[Column]:
    """Words joined to one stretch of text with its box."""
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "text"))), lambda w: w["text"]), " ")
    return [text.alias("text"), F.min("x0").alias("x0"), F.max("x1").alias("x1"), F.min("top").alias("top"), F.max("bottom").alias("bottom")]


def cells_of_rows(placed: DataFrame, keys: list[str]) -> DataFrame:
    """A row for each baseline: ``row``, ``n_words`` and ``cells`` from left to right; words nearer than the gap are one cell."""
    along = Window.partitionBy(*keys, "row").orderBy("x0", "place")
    apart = F.coalesce(F.col("x0") - F.lag("x1").over(along) > F.col("gap"), F.lit(False))
    words = placed.withColumn("apart", apart).withColumn("cell", F.sum(F.col("apart").cast("int")).over(along))
    cells = words.groupBy(*keys, "row", "cell").agg(F.first("n_words").alias("n_words"), *_line(["x0", "place"]))
    cell = F.struct("cell", "text", "x0", "x1", "top", "bottom")
    return cells.groupBy(*keys, "row").agg(F.first("n_words").alias("n_words"), F.array_sort(F.collect_list(cell)).alias("cells"))


def aligned(a: Column, b: Column, tolerance: float = X_TOL) -> Column:
    """Whether all but one of the cells, and two at least, share a left or a right edge."""
    near = lambda x, y: F.abs(x - y) <= tolerance
    hits = F.size(F.filter(b, lambda c: F.exists(a, lambda o: near(c["x0"], o["x0"]) | near(c["x1"], o["x1"]))))
    return F.coalesce(hits >= F.greatest(F.lit(2), F.least(F.size(a), F.size(b)) - 1), F.lit(False))


# -- tables ---------------------------------------------------------------------------


def grid_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with ``wide``, ``numeric`` (a number beyond the first cell) and ``run``: successive wide rows on one grid share a run."""
    down = Window.partitionBy(*keys).orderBy("row")
    wide = F.size("cells") >= MIN_COLS
    rows = rows.withColumns({"wide": wide, "before": F.lag("cells").over(down)})
    goes_on = F.col("wide") & F.coalesce(F.size("before") >= MIN_COLS, F.lit(False)) & aligned(F.col("before"), F.col("cells"))
    rows = rows.withColumn("fresh", (F.col("wide") & ~goes_on).cast("int")).withColumn("run", F.sum("fresh").over(down))
    numeric = F.exists(F.slice("cells", 2, F.greatest(F.size("cells") - 1, F.lit(1))), lambda c: is_numeric(c["text"]))
    return rows.withColumn("numeric", F.coalesce(numeric, F.lit(False))).drop("before", "fresh")


def accepted_runs(grid: DataFrame, keys: list[str]) -> DataFrame:
    """keys, run, first row and confidence of the runs that are tables: long enough, on pages with enough words, half of their rows with numbers."""
    sizes = grid.where("wide").groupBy(*keys, "run", F.size("cells").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.count_if("numeric").alias("numbers"), F.min("row").alias("start"), F.max("n_words").alias("n_words"))
    runs = sizes.groupBy(*keys, "run").agg(F.sum("n").alias("rows"), F.sum("numbers").alias("numbers"), F.min("start").alias("start"), F.max("n").alias("usual"), F.max("n_words").alias("n_words"))
    runs = runs.where((F.col("rows") >= MIN_ROWS) & (F.col("n_words") >= MIN_WORDS) & (F.col("numbers") >= NUMERIC_SHARE * F.col("rows")))
    return runs.select(*keys, "run", "start", (F.col("usual") / F.col("rows")).alias("structure_confidence"))


def heading_rows(grid: DataFrame, runs: DataFrame, keys: list[str]) -> DataFrame:
    """Rows above a table that line up with it, LOOK_BACK at most: narrow ones are stepped over, another table's or a misaligned one ends the search."""
    taken = grid.where("wide").join(runs.select(*keys, "run"), [*keys, "run"]).select(*keys, "row", F.lit(True).alias("taken"))
    starts = runs.join(grid.select(*keys, F.col("row").alias("start"), F.col("cells").alias("first")), [*keys, "start"])
    above = starts.select(*keys, "run", "first", F.col("start"), F.explode(F.sequence(F.lit(1), F.lit(LOOK_BACK))).alias("up")).withColumn("row", F.col("start") - F.col("up"))
    seen = above.join(grid.select(*keys, "row", "cells", "wide"), [*keys, "row"]).join(taken, [*keys, "row"], "left")
    ends = F.coalesce("taken", F.lit(False)) | (F.col("wide") & ~aligned(F.col("first"), F.col("cells")))
    upwards = Window.partitionBy(*keys, "run").orderBy("up")
    return seen.withColumn("ended", F.max(ends).over(upwards)).where("wide and not ended").select(*keys, "run", "row", "cells")


def column_tables(words: DataFrame, keys: list[str]) -> DataFrame:
    """keys and ``tables`` of the pages that have tables whose columns are made by white space alone."""
    grid = grid_rows(cells_of_rows(rows_of_words(words, keys), keys), keys)
    runs = accepted_runs(grid, keys)
    body = grid.where("wide").join(runs.select(*keys, "run"), [*keys, "run"]).select(*keys, "run", "row", "cells")
    rows = body.unionByName(heading_rows(grid, runs, keys))
    box = lambda f, pick, side: pick(F.transform("cells", lambda c: c[side]))
    found = rows.groupBy(*keys, "run").agg(F.array_sort(F.collect_list(F.struct("row", "cells"))).alias("rs"), *(f(box(f, pick, side)).alias(name) for name, f, pick, side in (("b0", F.min, F.array_min, "x0"), ("b1", F.min, F.array_min, "top"), ("b2", F.max, F.array_max, "x1"), ("b3", F.max, F.array_max, "bottom"))))
    table = F.struct(F.array("b0", "b1", "b2", "b3").alias("bbox"), F.transform(F.get("rs", F.lit(0))["cells"], lambda c: c["x0"]).alias("col_x"), F.transform("rs", lambda r: F.transform(r["cells"], lambda c: c["text"])).alias("rows"), F.lit("column-geometry").alias("source_engine"), "structure_confidence")
    whole = found.join(runs, [*keys, "run"]).select(*keys, F.struct("run", table.cast(TABLE).alias("t")).alias("t"))
    return whole.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list("t")), lambda x: x["t"]).alias("tables"))


# -- pages in columns --------------------------------------------------------------------


def _times(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def gutters(placed: DataFrame, keys: list[str]) -> DataFrame:
    """The words of the pages in columns with ``middle``: the middle of the widest band near the page's middle that few rows cross, if it parts the words."""
    page = Window.partitionBy(*keys)
    words = placed.where(F.col("n_words") >= COLUMN_WORDS).withColumns({"left": F.min("x0").over(page), "right": F.max("x1").over(page), "rows": F.max("row").over(page) + 1})
    words = words.withColumn("span", F.greatest(F.col("right"), F.lit(0.0) + F.col("left")) - F.col("left")).where("span > 0").withColumn("bins", F.greatest(F.lit(1), F.floor(F.col("span") / BIN).cast("int")))
    bin_of = lambda x: F.least(F.greatest(F.floor((F.col(x) - F.col("left")) / F.col("span") * F.col("bins")).cast("int"), F.lit(0)), F.col("bins") - 1)
    # a row's words as stretches of bins that do not touch: each begins one and ends it, or neither if those before it reach as far
    stretch = Window.partitionBy(*keys, "row").orderBy("from", "to", "place")
    words = words.withColumns({"from": bin_of("x0"), "to": F.greatest(bin_of("x0"), bin_of("x1"))})
    reach = F.max("to").over(stretch.rowsBetween(Window.unboundedPreceding, -1))
    words = words.withColumn("from", F.greatest(F.col("from"), F.coalesce(reach + 1, F.lit(0)))).withColumn("ink", (F.col("from") <= F.col("to")).cast("int"))
    edges = F.array(F.struct(F.col("from").alias("at"), F.col("ink").alias("d"), F.lit(True).alias("begins")), F.struct((F.col("to") + 1).alias("at"), (-F.col("ink")).alias("d"), F.lit(False).alias("begins")))
    steps = words.select(*keys, "n_words", "left", "span", "bins", "rows", "row", "place", "text", "x0", "x1", "top", "bottom", F.inline(edges))
    # the bins from an edge to the next are crossed alike; of those that are free, the last near the middle has the widest band before it
    across = Window.partitionBy(*keys).orderBy("at", "place", "begins")
    so_far = across.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    steps = steps.withColumns({"crossed": F.sum("d").over(so_far), "next": F.coalesce(F.lead("at").over(across), F.col("bins"))})
    blocked = F.col("crossed") > F.greatest(F.lit(1.0), F.col("rows") * CROSSING)
    steps = steps.withColumn("shut", F.coalesce(F.max(F.when(blocked & (F.col("at") < F.col("next")), F.col("next") - 1)).over(so_far), F.lit(-1)))
    lo, hi = (F.floor(F.col("bins") * s).cast("int") for s in MIDDLE)
    last = F.least(F.col("next") - 1, hi)
    band = F.when(last >= F.greatest(F.col("at"), lo), F.struct((last - F.col("shut")).alias("free"), (-last).alias("before")))
    best = steps.withColumn("band", F.max(band).over(page)).where("begins").withColumns({"free": F.col("band.free"), "at": -F.col("band.before")})
    best = best.where((F.col("free") > 0) & (F.col("free") * BIN >= F.col("span") * GUTTER))
    best = best.withColumn("middle", F.col("left") + (F.col("at") - F.col("free") / 2 + 0.5) / F.col("bins") * F.col("span"))
    sides = best.withColumns({"a": _times(F.col("x1") <= F.col("middle")).over(page), "b": _times(F.col("x0") > F.col("middle")).over(page)})
    return sides.where(F.least("a", "b") >= F.col("n_words") * SIDE).select(*keys, "middle", "row", "place", "text", "x0", "x1", "top", "bottom")


def prose_pages(words: DataFrame, keys: list[str]) -> DataFrame:
    """The words, with ``crossed`` of their rows, of the pages both of whose sides carry running text, unlike a table's labels and figures."""
    page, row = Window.partitionBy(*keys), Window.partitionBy(*keys, "row")
    words = words.withColumn("side", F.when(F.col("x1") <= F.col("middle"), 0).when(F.col("x0") > F.col("middle"), 1))
    words = words.withColumns({"first": F.row_number().over(row.orderBy("place")) == 1, "crossed": F.max((F.col("x0") < F.col("middle")) & (F.col("x1") > F.col("middle"))).over(row)})
    both = F.lit(True)
    for side in (0, 1):
        on = F.col("side") == side
        words = words.withColumns({f"n{side}": _times(on).over(row), f"numbers{side}": _times(on & is_numeric(F.col("text"))).over(row)})
        n, speaks = F.col(f"n{side}"), F.col("first") & (F.col(f"n{side}") > 0)  # a row's first word speaks for it
        numbers = (n == F.col(f"numbers{side}")).cast("double")
        both &= (F.avg(F.when(speaks, n)).over(page) >= PROSE_WORDS) & (F.avg(F.when(speaks, numbers)).over(page) <= PROSE_NUMERIC)
    return words.withColumn("prose", both).where("prose").select(*keys, "middle", "row", "place", "crossed", "text", "x0", "x1", "top", "bottom")


def column_lines(words: DataFrame, keys: list[str]) -> DataFrame:
    """keys and ``lines`` of the pages in two columns: the left before the right, between rows that cross the gutter.

    A page's words stay together from step to step and no step is joined to them: words take few
    bytes as Parquet, so the planner would send them all through the driver as the small side.
    """
    placed = written(rows_of_words(words, keys), "placed")
    on = prose_pages(gutters(placed, keys), keys)
    side = F.when(F.col("crossed") | (F.col("x1") <= F.col("middle")), 0).when(F.col("x0") > F.col("middle"), 1)
    lines = on.withColumn("side", side).where("side is not null").groupBy(*keys, "row", "crossed", "side").agg(*_line(["x0", "place"]))
    # rows between two that cross are one block, whose left side is read first; a crossing row is one line, and a block of its own
    down = Window.partitionBy(*keys).orderBy("row", "side")
    block = 2 * F.coalesce(F.sum(F.col("crossed").cast("int")).over(down.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("crossed").cast("int")
    line = F.struct(F.struct("block", "side", "row").alias("at"), F.struct(*LINE.names).cast(LINE).alias("line"))
    return lines.withColumn("block", block).groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["line"]).alias("lines"))


def nearest_column(x: Column, starts: Column) -> Column:
    """The place of the column whose left edge is nearest; the first of equals."""
    far = F.transform(starts, lambda s: F.abs(s - x))
    return F.array_position(far, F.array_min(far)).cast("int") - 1


def parsed_pages(pages: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Pages with their ruled tables, or else those of their words, and with lines by column where a page has no table."""
    keys = keys or ["doc_id", "page_no"]
    ruled = F.coalesce(F.size("tables"), F.lit(0)) > 0
    words = exploded_words(pages.where(~ruled), keys)
    found = column_tables(words, keys).withColumnRenamed("tables", "_t")
    set_ = column_lines(words, keys).withColumnRenamed("lines", "_l")
    out = pages.join(found, keys, "left").join(set_, keys, "left")
    none = F.array().cast(T.ArrayType(TABLE))
    out = out.withColumn("tables", F.when(ruled, F.col("tables")).otherwise(F.coalesce("_t", none)))
    return out.withColumn("lines", F.when(F.size("tables") == 0, F.coalesce("_l", "lines")).otherwise(F.col("lines"))).drop("_t", "_l")


def filled_tables(pages: DataFrame, others: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Pages without tables with those another engine found for them (doc, page_no, tables)."""
    rows = pages.join(others.withColumnRenamed("tables", "_o"), [doc, "page_no"], "left")
    return rows.withColumn("tables", F.when(F.size("tables") > 0, F.col("tables")).otherwise(F.coalesce("_o", "tables"))).drop("_o")
