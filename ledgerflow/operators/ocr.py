"""Text of pages that carry none, recognised by an engine and put back as lines.

Pages are those of ``geometry``; a page without lines has no text layer. The engine is
a parameter, a job over the pages it is given, so that it may run anywhere Spark does: it takes
pages (doc, page_no and whatever else they have, an image for example) and returns (doc, page_no, text).
"""

from __future__ import annotations

import importlib.util
import logging
from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import strip
from .geometry import LINE

log = logging.getLogger(__name__)
#: Fixed value: so many pages of a document are recognised, the first in page order.
MOST_PAGES = 50
Engine = Callable[[DataFrame], DataFrame]


@cache
def engine_there(*modules: str) -> bool:
    """Whether an engine's modules can be imported here; said once if not."""
    missing = [m for m in modules if importlib.util.find_spec(m) is None]
    if missing:
        log.warning("pages without text stay empty: %s cannot be imported", ", ".join(missing))
    return not missing


def without_text(pages: DataFrame, doc: str = "doc_id", most: int = MOST_PAGES) -> DataFrame:
    """The pages to recognise: those without lines, the first ``most`` of each document.

    The limit by rank is taken before the shuffle as well as after, so a long document sends few rows.
    """
    empty = pages.where(F.coalesce(F.size("lines"), F.lit(0)) <= 0)
    nth = F.row_number().over(Window.partitionBy(doc).orderBy("page_no"))
    return empty.withColumn("_nth", nth).where(F.col("_nth") <= most).drop("_nth")


def spread_lines(text: Column, width: Column, height: Column) -> Column:
    """Recognised text as lines of the page's full width, evenly down its height: never taken for a column, in the order read."""
    rows = F.filter(F.transform(F.split(text, r"\R"), strip), lambda r: r != "")
    size = lambda c: F.coalesce(F.nullif(c.cast("double"), F.lit(0.0)), F.lit(1.0))
    step = size(height) / F.greatest(F.size(rows), F.lit(1))
    return F.transform(rows, lambda r, i: F.struct(r.alias("text"), F.lit(0.0).alias("x0"), size(width).alias("x1"), (i * step).alias("top"), ((i + 1) * step).alias("bottom")))


def recognised(pages: DataFrame, engine: Engine | None, doc: str = "doc_id", most: int = MOST_PAGES) -> DataFrame:
    """``pages`` with the lines that ``engine`` finds on pages without text, all others as they are.

    Without an engine, and where it finds nothing, pages stay empty. Reflow comes after, so
    that recognised pages take part in paragraphs and running heads like those around them.
    """
    if engine is None:
        return pages
    found = engine(without_text(pages, doc, most)).select(doc, "page_no", F.col("text").alias("_text"))
    out = pages.join(found, [doc, "page_no"], "left")
    width = F.col("width") if "width" in pages.columns else F.lit(None)
    lines = F.when((F.coalesce(F.size("lines"), F.lit(0)) <= 0) & F.col("_text").isNotNull(), spread_lines(F.col("_text"), width, F.col("height")))
    kept = F.coalesce(F.transform("lines", lambda x: F.struct(*(x[n].cast("string" if n == "text" else "double").alias(n) for n in LINE.names))), F.array().cast("array<struct<text:string,x0:double,x1:double,top:double,bottom:double>>"))
    return out.withColumn("lines", F.coalesce(lines, kept)).drop("_text").select(pages.columns)
