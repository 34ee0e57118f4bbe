"""A detected grid of rows and columns filled with the page's own words.

A model says where rows and columns lie; the text comes from the text layer, so that
numbers stay as filed. ``words`` are rows (doc, page_no, ord, text, x0, x1, top, bottom),
``tables`` rows (doc, page_no, table_no, box, rows, cols, scale): boxes are [x0, y0, x1, y1]
of the model's image, those of rows and columns from the table's corner, and ``scale``
is the image's against the page.

A page's words meet its tables by one equality of pages, and all that follows stays where
that join put it: words and tables are shuffled once, whatever their size. A table carries
its rows by bands of the page's height, in order: a row is in each band it touches, a word
in one, and a word's band is found by halving, so no page's words meet all its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Height of a band in points.
BAND = 24.0
KEYS = ["doc_id", "page_no", "table_no"]


def nearest_span(x: Column, spans: Column) -> Column:
    """The place of the span that holds ``x``, or else of the nearest; the first of equals.

    Detected columns lie a little inside the ink; holding alone would lose first words and narrow columns.
    """
    far = F.transform(spans, lambda s: F.greatest(s[0] - x, x - s[1], F.lit(0.0)))
    return (F.array_position(far, F.array_min(far)) - 1).cast("int")


def _side(box: Column, corner: Column, i: int) -> Column:
    return (F.get(corner, F.lit(i % 2)) + F.get(box, F.lit(i))) / F.col("scale")


def _last(bands: Column, steps: Column, fits) -> Column:
    """The place of the last of the ascending ``bands`` that ``fits``, or -1; ``steps`` are the powers of two up to their number, falling."""
    return F.aggregate(steps, F.lit(-1), lambda at, step: F.when(fits(F.get(bands, at + step)), at + step).otherwise(at))


def _banded(tables: DataFrame, at) -> DataFrame:
    """KEYS, n_cols, spans of the columns, and the rows as ``held``, once for each band they touch and in the bands' order, with ``bands`` and ``steps`` to find them by."""
    spans = F.transform("cols", lambda c: F.array(_side(c, F.col("box"), 0), _side(c, F.col("box"), 2)))
    rows = F.transform("rows", lambda r, i: F.struct(_side(r, F.col("box"), 1).alias("above"), _side(r, F.col("box"), 3).alias("below"), i.alias("row_at")))
    touched = lambda r: F.transform(F.sequence(at(r["above"]), at(r["below"])), lambda b: F.struct(b.alias("band"), r["above"].alias("above"), r["below"].alias("below"), r["row_at"].alias("row_at")))
    held = F.sort_array(F.flatten(F.transform(F.filter(rows, lambda r: r["above"] <= r["below"]), touched)))
    out = tables.where((F.size("cols") > 0) & F.col("rows").isNotNull()).select(*KEYS, F.size("cols").alias("n_cols"), spans.alias("spans"), held.alias("held"))
    powers = F.transform(F.sequence(F.length(F.bin(F.size("held"))) - 1, F.lit(0), F.lit(-1)), lambda i: F.pow(F.lit(2), i).cast("int"))
    return out.select("*", F.transform("held", lambda h: h["band"]).alias("bands"), powers.alias("steps"))


def placed_words(words: DataFrame, tables: DataFrame, band: float = BAND) -> DataFrame:
    """doc_id, page_no, table_no, n_cols, row_at, col_at, ord and text of every word whose middle lies in a row, in the nearest column."""
    at = lambda y: F.floor(y / band)
    inked = words.select("doc_id", "page_no", "ord", "text", ((F.col("x0") + F.col("x1")) / 2).alias("x"), ((F.col("top") + F.col("bottom")) / 2).alias("y"))
    met = inked.join(_banded(tables, at), ["doc_id", "page_no"])
    before, last = (_last(F.col("bands"), F.col("steps"), fits) for fits in (lambda b: b < at(F.col("y")), lambda b: b <= at(F.col("y"))))
    met = met.select(*KEYS, "n_cols", "spans", "held", "x", "y", "ord", "text", before.alias("before"), last.alias("last"))
    holding = F.filter(F.slice("held", F.col("before") + 2, F.col("last") - F.col("before")), lambda h: F.col("y").between(h["above"], h["below"]))
    # outer, then what is null left out: an inner one is planned with a filter that searches a second time
    placed = met.select(*KEYS, "n_cols", "spans", "x", "ord", "text", F.explode_outer(F.transform(holding, lambda h: h["row_at"])).alias("row_at")).where("row_at is not null")
    return placed.select(*KEYS, "n_cols", "row_at", nearest_span(F.col("x"), F.col("spans")).alias("col_at"), "ord", "text")


def filled_grids(words: DataFrame, tables: DataFrame, band: float = BAND) -> DataFrame:
    """doc_id, page_no, table_no, row_idx and cells, an array with a text for every column; rows without ink are left out."""
    rows = placed_words(words, tables, band).groupBy(*KEYS, "n_cols", "row_at").agg(F.array_sort(F.collect_list(F.struct("col_at", "ord", "text"))).alias("ws")).where(F.exists("ws", lambda w: F.trim(w["text"]) != ""))
    cell = lambda i: F.array_join(F.transform(F.filter("ws", lambda w: w["col_at"] == i), lambda w: w["text"]), " ")
    cells = rows.select(*KEYS, "row_at", F.transform(F.sequence(F.lit(0), F.col("n_cols") - 1), cell).alias("cells"))
    nth = F.row_number().over(Window.partitionBy(*KEYS).orderBy("row_at")) - 1
    return cells.select(*KEYS, nth.alias("row_idx"), "cells")
