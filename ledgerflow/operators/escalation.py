"""Which tables are read again by a paid engine, and what it says.

Nothing leaves the machine unless three settings agree, asked in this order: escalation is
on, it is not confined to the machine, a key is there. An engine is asked for the least sure
tables first while a document's budget lasts, a batch of prompts at a time. A reply
that is no table changes nothing.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import reply_json
from .geometry import ground_numbers

log = logging.getLogger(__name__)
#: The least confidence, characters of a page's text in a prompt, dollars a page.
THRESHOLD, CONTEXT_CHARS, PAGE_COST = 0.66, 20_000, 0.02
Ask = Callable[[list[str]], list[str | None]]


def permitted(ask: Ask | None, enabled: bool = False, local_only: bool = True, key: str | None = None) -> Ask | None:
    """``ask`` if all settings allow it, else None, which changes no table."""
    if not enabled:
        return None
    if local_only:
        log.info("escalation is on, but confined to this machine")
        return None
    if not key:
        log.warning("escalation is on, but has no key")
        return None
    return ask


def chosen(tables: DataFrame, threshold: float = THRESHOLD, page_cost: float = PAGE_COST, budget: float | None = None, doc: str = "doc_id") -> DataFrame:
    """``tables`` with ``cost``, that of its pages where its confidence is below the threshold, and ``chosen``.

    With a budget a document's tables are chosen in order of confidence, then place, as long as
    their costs together stay within it; a null confidence is 0.
    """
    sure = F.coalesce("confidence", F.lit(0.0))
    low = sure < threshold
    out = tables.withColumns({"cost": F.when(low, page_cost * (F.col("page_end") - F.col("page_start") + 1)).otherwise(0.0), "chosen": low})
    if budget is None:
        return out
    order = Window.partitionBy(doc).orderBy(sure, "table_seq")
    spent = F.sum("cost").over(order.rowsBetween(Window.unboundedPreceding, 0))
    return out.withColumn("chosen", low & (F.round(spent, 6) <= budget))


def prompt(rows: Column, context: Column, columns: Column) -> Column:
    """What an engine is told: the page's text, cut at CONTEXT_CHARS, and the doubtful rows."""
    return F.concat(F.lit("The rows below were read from a page and may be wrong. By the page's text, give the table as JSON {\"rows\": [[...], ...]} with "), columns.cast("string"), F.lit(" cells a row and nothing else; numbers only from the text.\n\nTEXT\n"), F.substring(F.coalesce(context, F.lit("")), 1, CONTEXT_CHARS), F.lit("\n\nROWS\n"), F.to_json(rows))


def reply_rows(reply: Column) -> Column:
    """The rows of a reply, fences and prose around them left aside; null if there are none."""
    rows = reply_json(reply, "rows array<array<string>>")["rows"]
    return F.when(F.size(rows) > 0, F.transform(rows, lambda r: F.transform(r, lambda c: F.coalesce(c, F.lit("")))))


def asked(ask: Ask) -> Callable[[Column], Column]:
    """A column of replies to a column of prompts: one call for the prompts of each Arrow batch."""

    @F.pandas_udf("string")
    def replies(prompts: pd.Series) -> pd.Series:
        there = prompts.notna()
        out = pd.Series([None] * len(prompts), dtype=object)
        if there.any():
            try:
                out[there.to_numpy()] = ask(prompts[there].tolist())
            except Exception as e:  # noqa: BLE001  a failed call leaves its tables as they are
                log.warning("escalation failed: %s", e)
        return out

    return replies


def read_again(tables: DataFrame, ask: Ask | None, raw: str = "raw", context: str = "context", name: str = "text-llm", threshold: float = THRESHOLD) -> DataFrame:
    """Chosen tables with the rows the engine gives, grounded anew in the raw text; all with needs_review.

    ``tables`` have rows, confidence, chosen, cost and source_engine besides their raw text and context.
    """
    if ask is None:
        return tables.withColumns({"escalated": F.lit(False), "est_cost": F.lit(0.0), "needs_review": F.coalesce("confidence", F.lit(0.0)) < threshold})
    widest = F.coalesce(F.array_max(F.transform("rows", lambda r: F.size(r))), F.lit(0))
    text = F.when(F.col("chosen"), prompt(F.col("rows"), F.col(context), widest))
    new = tables.withColumn("_new", reply_rows(asked(ask)(text)))
    took = F.col("_new").isNotNull()
    sure = F.when(took, ground_numbers(F.col("_new"), F.col(raw))).otherwise(F.coalesce("confidence", F.lit(0.0)))
    new = new.withColumns({"_sure": sure, "escalated": F.col("chosen"), "est_cost": F.when(F.col("chosen"), F.col("cost")).otherwise(0.0)})
    return new.withColumns({"rows": F.when(took, F.col("_new")).otherwise(F.col("rows")), "source_engine": F.when(took, name).otherwise(F.col("source_engine")), "confidence": F.col("_sure"), "needs_review": F.col("_sure") < threshold}).drop("_new", "_sure")
