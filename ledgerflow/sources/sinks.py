"""Where documents and results go: files by issuer and filing, CSV for other tools, tables of text.

Document files lie at {market}/{symbol}/{filing_id}/{name} under a root. Each is written
under a name of its own and then moved, so none is ever half there; one that is there with the
same content is left alone, so a second run writes nothing.
"""

from __future__ import annotations

import contextlib
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .archives import opened

#: Longest part of a path in bytes, as file systems allow 255.
NAME_BYTES = 200
PARTS = ("market", "symbol", "filing_id", "name")
SAVED = "market string, symbol string, filing_id string, name string, doc_seq long, digest string, path string, size long, status string"


def safe_name(c: Column) -> Column:
    """A text as one part of a path: no separators, controls or leading dots; where it had to change or is long, with a piece of its hash."""
    bare = F.regexp_replace(F.coalesce(c, F.lit("")), r'[\x00-\x1f\x7f/\\:*?"<>|]', "_")
    bare = F.regexp_replace(bare, r"^[.\s]+|[.\s]+$", "_")
    short = F.when(F.octet_length(bare) > NAME_BYTES, F.substring(bare, 1, NAME_BYTES // 4)).otherwise(bare)
    ending = F.regexp_extract(bare, r"(\.[A-Za-z0-9]{1,8})$", 1)
    stem = F.regexp_replace(short, r"\.[A-Za-z0-9]{1,8}$", "")
    return F.when(short.eqNullSafe(c) & (short != ""), short).otherwise(F.concat(stem, F.lit("~"), F.substring(F.sha1(F.coalesce(c, F.lit("")).cast("binary")), 1, 8), ending))


def content_digest(c: str) -> Column:
    return F.sha1(F.coalesce(F.col(c), F.lit(b"")))


def _move_batches(batches: Iterator[pa.RecordBatch], root: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for one in (batch.slice(i, 1) for i in range(batch.num_rows)):  # one document's content is open at a time
            r = one.to_pylist()[0]
            target = "/".join([root, *(r[p] for p in PARTS)])
            system, at = opened(target)
            content, status = r["content"] or b"", "written"
            info = system.get_file_info(at)
            if info.is_file and info.size == len(content):
                with system.open_input_stream(at) as f:
                    status = "kept" if hashlib.sha256(f.read()).digest() == hashlib.sha256(content).digest() else status
            if status == "written":
                folder, name = at.rsplit("/", 1)
                system.create_dir(folder)
                part = f"{folder}/.{uuid.uuid4().hex}.part"
                try:
                    with system.open_output_stream(part) as f:
                        f.write(content)
                    system.move(part, at)
                except BaseException:
                    with contextlib.suppress(OSError):
                        system.delete_file(part)
                    raise
            rows.append({**{p: r[p] for p in PARTS}, "doc_seq": r["_ord"], "digest": r["_digest"], "path": target, "size": len(content), "status": status})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([*((p, pa.string()) for p in PARTS), ("doc_seq", pa.int64()), ("digest", pa.string()), ("path", pa.string()), ("size", pa.int64()), ("status", pa.string())]))


def save_documents(docs: DataFrame, root: str, ordinal: str = "doc_seq") -> DataFrame:
    """Write the files of ``docs`` (market, symbol, filing_id, name, content and an ordinal); what was done with each, once it is read.

    Names that meet within a filing are told apart by their ordinal, then content; rows alike in path, ordinal and content are one file.
    """
    safe = docs.select(*(safe_name(F.col(p)).alias(p) for p in PARTS), "content", F.col(ordinal).cast("long").alias("_ord"), content_digest("content").alias("_digest"))
    nth = F.row_number().over(Window.partitionBy(*PARTS).orderBy("_ord", "_digest"))
    safe = safe.dropDuplicates([*PARTS, "_ord", "_digest"]).withColumn("_nth", nth)
    safe = safe.withColumn("name", F.when(F.col("_nth") > 1, F.concat(F.col("_nth").cast("string"), F.lit("~"), "name")).otherwise(F.col("name")))
    return safe.select(*PARTS, "content", "_ord", "_digest").mapInArrow(lambda b: _move_batches(b, root.rstrip("/")), SAVED)


def save_csv(df: DataFrame, folder: str, mode: str = "overwrite") -> None:
    """Results as CSV files with headings; lists and structs as JSON."""
    flat = df.select(*((F.to_json(F.col(f"`{f.name}`")) if f.dataType.typeName() in ("array", "struct", "map") else F.col(f"`{f.name}`")).alias(f.name) for f in df.schema))
    flat.write.mode(mode).option("header", True).option("escape", '"').csv(folder)


def text_table(df: DataFrame, rows: int = 50, width: int = 40) -> str:
    """The first rows as a table of text, for a console."""
    cells = [[str(v) if v is not None else "" for v in r] for r in df.limit(rows).collect()]
    cells = [df.columns, *[[c if len(c) <= width else c[: width - 1] + "…" for c in r] for r in cells]]
    wide = [max(map(len, c)) for c in zip(*cells, strict=True)]
    lines = ["  ".join(c.ljust(w) for c, w in zip(r, wide, strict=True)).rstrip() for r in cells]
    return "\n".join([lines[0], "  ".join("-" * w for w in wide), *lines[1:]])
