"""Document formats by leading bytes, and text of archives and markup."""

from __future__ import annotations

import gzip
import html
import io
import re
import struct
import zipfile
import zlib
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from . import wordfiles

#: Leading bytes in hex and the format they mark.
MAGIC = {"255044462D": "pdf", "504B0304": "zip", "504B0506": "zip", "504B0708": "zip", "D0CF11E0A1B11AE1": "ole", "1F8B": "gzip", "25215053": "ps"}
#: File endings and the format they mark.
ENDINGS = {".pdf": "pdf", ".zip": "zip", ".xml": "xml", ".htm": "html", ".html": "html", ".txt": "txt", ".hwp": "hwp", ".hwpx": "hwpx"}
#: Archives in archives, characters after which no further member is read, and bytes read of one member.
MAX_DEPTH, MAX_CHARS, MAX_BYTES = 3, 5_000_000, 64 << 20


_SUFFIX = tuple(ENDINGS.items())


def sniff_column(content: Column) -> Column:
    """Format of a binary column by its first bytes, null if none is known; the two container formats are not looked into."""
    head = F.hex(F.substring(content, 1, 8))
    text = F.lower(F.ltrim(F.decode(F.substring(content, 1, 1024), "ISO-8859-1"), F.lit(" \t\r\n\x0b\x0c")))
    out = F
    for magic, name in MAGIC.items():
        out = out.when(head.startswith(magic), name)
    return out.when(text.startswith("<?xml"), "xml").when(text.startswith("<"), "html")


@F.pandas_udf(StringType())
def container_format(content: pd.Series) -> pd.Series:
    """Format by the first bytes, and of containers by what they hold."""
    return content.map(lambda x: None if x is None else sniff(bytes(x)))


def sniffed(content: Column) -> Column:
    """As ``container_format``, with Python for containers alone."""
    plain = sniff_column(content)
    return F.when(plain.isin("ole", "zip"), container_format(content)).otherwise(plain)


def format_from_name(name: Column) -> Column:
    out = F
    for ending, kind in _SUFFIX:
        out = out.when(F.lower(name).endswith(ending), kind)
    return out.otherwise(F.lit(None).cast("string"))


def format_of(url: Column, content_type: Column, content: Column) -> Column:
    """Format by content, else by the URL's path or the content type, HTML if nothing tells."""
    path, kind = F.lower(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit(""))), F.lower(F.coalesce(content_type, F.lit("")))
    says = lambda word, *ends: reduce(lambda a, b: a | b, [path.endswith(e) for e in ends], F.contains(kind, F.lit(word)))
    out = F.when(says("pdf", ".pdf"), "pdf").when(says("zip", ".zip"), "zip").when(says("xml", ".xml"), "xml").when(says("html", ".htm", ".html"), "html").when(says("text/plain", ".txt"), "txt")
    return F.coalesce(sniffed(content), out.when(path.endswith(".hwp"), "hwp").when(path.endswith(".hwpx"), "hwpx").otherwise("html"))


def file_name(url: Column, doc_seq: Column, kind: Column) -> Column:
    """The URL's last part with an ending that says what the file is; doc and its number where there is none."""
    last = F.element_at(F.split(F.coalesce(F.url_decode(F.try_parse_url(url, F.lit("PATH"))), F.lit("")), "/"), -1)
    stem = F.regexp_replace(last, r"(?<=.)\.[^.]*$", "")
    honest = F.when(format_from_name(last).eqNullSafe(kind), last).otherwise(F.concat(stem, F.lit("."), kind))
    return F.when(F.contains(last, F.lit(".")), honest).otherwise(F.concat(F.lit("doc"), doc_seq.cast("string"), F.lit("."), kind))


def local_path(root: str, market: Column, symbol: Column, filing_id: Column, name: Column) -> Column:
    return F.concat_ws("/", F.lit(root), market, symbol, filing_id, name)


def request_headers(url: Column, agent: str, browser: str) -> Column:
    """Headers by host: the declared agent for one regulator, a browser with a referrer for one exchange, a browser else."""
    host = F.lower(F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("")))
    pair = lambda k, v: [F.lit(k), F.lit(v)]
    return F.when(F.contains(host, F.lit("sec.gov")), F.create_map(*pair("User-Agent", agent))).when(F.contains(host, F.lit("hkexnews")), F.create_map(*pair("User-Agent", browser), *pair("Referer", "https://www1.hkexnews.hk/"))).otherwise(F.create_map(*pair("User-Agent", browser)))


def sniff(content: bytes) -> str | None:
    head = content[:8].hex().upper()
    kind = next((name for magic, name in MAGIC.items() if head.startswith(magic)), None)
    if kind == "ole":
        return "hwp" if wordfiles.is_binary(content) else "ole"
    if kind == "zip":
        return "hwpx" if wordfiles.is_package(content) else "zip"
    text = content[:1024].lstrip().lower()
    return kind or ("xml" if text.startswith(b"<?xml") else "html" if text.startswith(b"<") else None)


def markup_text(source: str) -> str:
    bare = re.sub(r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", " ", source)
    return re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", bare))).strip()


def text_of(content: bytes, kind: str | None = None, depth: int = 0) -> str | None:
    """Text of a document; archives are read member by member down to MAX_DEPTH."""
    kind = kind or sniff(content)
    try:
        if kind in ("xml", "html"):
            return markup_text(content.decode("utf-8", "replace")) or None
        if kind == "txt":
            return content.decode("utf-8", "replace").strip() or None
        if kind == "hwp":
            return wordfiles.binary_text(content)
        if kind == "hwpx":
            return wordfiles.package_text(content, markup_text)
        if kind in ("gzip", "zip") and depth < MAX_DEPTH:
            return _archive(content, kind, depth)
    except (OSError, zipfile.BadZipFile, EOFError, RuntimeError, ValueError, KeyError, IndexError, struct.error, zlib.error):
        return None
    return None


def whole(data: bytes, name: str) -> bytes:
    """``data`` if it was read to its end; ValueError if there was more, so that no document is cut without a sign."""
    if len(data) > MAX_BYTES:
        raise ValueError(f"{name} has more than {MAX_BYTES} bytes")
    return data


def _archive(content: bytes, kind: str, depth: int) -> str | None:
    if kind == "gzip":
        with gzip.open(io.BytesIO(content)) as z:  # a small archive can hold any amount
            data = z.read(MAX_BYTES + 1)
        return text_of(whole(data, "its content"), None, depth + 1)
    parts: list[str] = []
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        for info in z.infolist():
            if info.is_dir() or sum(map(len, parts)) >= MAX_CHARS:
                continue
            with z.open(info) as member:
                data = whole(member.read(MAX_BYTES + 1), info.filename)
            ending = next((k for e, k in ENDINGS.items() if info.filename.lower().endswith(e)), None)
            if (kind_of := sniff(data) or ending) and (text := text_of(data, kind_of, depth + 1)):
                parts.append(text)
    return "\n".join(parts).strip() or None


@F.pandas_udf(StringType())
def document_text(content: pd.Series) -> pd.Series:
    return content.map(lambda x: None if x is None else text_of(bytes(x)))
