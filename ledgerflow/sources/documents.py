"""Fetched documents as files, texts and tables: format, place, text by the format's reader, pages recognised and reflowed.

``fetched`` has a row for each document: company_id, filing_id, source, doc_seq, doc_url, market,
symbol, content_type and content. Reading pages of a PDF is an engine's work, a job given as a
parameter: from (doc_id, content) to the pages of ``geometry``, with the words of each page besides
if tables without rules are to be found. The same holds for recognising pages without text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import columns, geometry, ocr
from ..operators.storage import written
from . import formats, sinks

#: Fixed value: characters of a document's text that are kept.
MOST_CHARS = 5_000_000
KEYS = ["company_id", "filing_id", "source", "doc_seq"]
Pages = Callable[[DataFrame], DataFrame]


def page_texts(pages: DataFrame, recognise: ocr.Engine | None = None) -> DataFrame:
    """doc_id and text: pages without text recognised, then all reflowed together."""
    return geometry.reflow(ocr.recognised(pages, recognise))


def structured_texts(pages: DataFrame, recognise: ocr.Engine | None = None, **escalation) -> DataFrame:
    """doc_id, text and tables; tables are ruled ones or those of the words. Only documents without tables have their empty pages recognised."""
    parsed = written(columns.parsed_pages(pages) if "words" in pages.columns else pages, "parsed-pages")
    found = written(geometry.structured(parsed, **escalation), "structured")
    bare = found.where(F.size("tables") == 0).select("doc_id")
    again = page_texts(parsed.join(bare, "doc_id", "left_semi"), recognise).withColumnRenamed("text", "_again") if recognise else None
    if again is None:
        return found.select("doc_id", "text", "tables")
    return found.join(again, "doc_id", "left").select("doc_id", F.coalesce(F.nullif("_again", F.lit("")), "text").alias("text"), "tables")


def stored(fetched: DataFrame, root: str, pages: Pages | None = None, recognise: ocr.Engine | None = None, tables: bool = False, **escalation) -> tuple[DataFrame, DataFrame | None]:
    """Rows of filing_documents for all that was fetched, its files saved under ``root``; and of filing_tables, if ``tables`` are asked for.

    A document out of which nothing comes has no text and 0 characters.
    """
    kind = formats.format_of(F.col("doc_url"), F.col("content_type"), F.col("content"))
    rows = fetched.withColumn("doc_format", kind)
    rows = rows.withColumn("name", formats.file_name(F.col("doc_url"), F.col("doc_seq"), F.col("doc_format")))
    rows = written(rows.withColumn("doc_id", F.sha1(F.to_json(F.struct(*KEYS)).cast("binary"))), "fetched")
    files = written(sinks.save_documents(rows, root), "saved").select(*(F.col(c).alias(f"_{c}") for c in ("market", "symbol", "filing_id", "doc_seq", "digest", "path")))
    plain = rows.where("doc_format <> 'pdf'").select("doc_id", formats.document_text("content").alias("text"))
    cells = None
    if pages is not None:
        read = written(pages(rows.where("doc_format = 'pdf'").select("doc_id", "content")), "pages")
        if tables:
            both = written(structured_texts(read, recognise, **escalation), "texts")
            cells = rows.select(*KEYS, "doc_id").join(both.select("doc_id", F.explode("tables").alias("t")), "doc_id")
            cells = geometry.table_cells(cells.select(*KEYS, *(F.col(f"t.{c}").alias(c) for c in ("table_seq", "rows", "page_start", "page_end", "confidence", "source_engine")), F.col("t.needs_review").cast("int").alias("needs_review"))).withColumnRenamed("text", "value")
            plain = plain.unionByName(both.select("doc_id", "text"))
        else:
            plain = plain.unionByName(page_texts(read, recognise))
    text = F.substring(F.nullif("text", F.lit("")), 1, MOST_CHARS)
    safe = [sinks.safe_name(F.col(c)) for c in ("market", "symbol", "filing_id")]
    out = rows.join(plain, "doc_id", "left").withColumns({"_market": safe[0], "_symbol": safe[1], "_filing_id": safe[2], "_doc_seq": F.col("doc_seq").cast("long"), "_digest": sinks.content_digest("content")})
    out = out.join(files, ["_market", "_symbol", "_filing_id", "_doc_seq", "_digest"], "left")
    out = out.select(*KEYS, "doc_url", F.col("_path").alias("local_path"), "doc_format", F.octet_length("content").cast("long").alias("file_size"), text.alias("text_content"))
    return out.withColumn("text_chars", F.coalesce(F.length("text_content"), F.lit(0)).cast("long")), cells
