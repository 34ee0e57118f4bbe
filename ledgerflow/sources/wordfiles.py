"""Text of word-processor files of two kinds: a binary compound file and a package of XML.

The compound file is read by its own small reader: sectors chained by an allocation
table, a tree of named streams, short streams packed in a stream of their own. What
is damaged, encrypted or made for distribution only has no text.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Callable
from functools import cached_property

#: Signatures, the tag of a paragraph's text, control characters eight units wide and those that stand for text.
COMPOUND = bytes.fromhex("D0CF11E0A1B11AE1")
BINARY_MARK, PACKAGE_MARK = b"HWP Document File", b"application/hwp+zip"
PARAGRAPH_TEXT = 67
WIDE = frozenset([*range(1, 10), 11, 12, *range(14, 24)])
AS_TEXT = {9: "\t", 10: "\n", 13: "\n", 30: " ", 31: " "}
_SECTION = re.compile(r"^Contents/section\d+\.xml$", re.I)
_END = 0xFFFFFFF0  # marks of ends and free sectors lie above


class CompoundFile:
    """Streams of a compound file by path."""

    def __init__(self, data: bytes):
        if data[:8] != COMPOUND:
            raise ValueError("not a compound file")
        self.data = data
        shift, mini = struct.unpack_from("<HH", data, 30)
        self.size, self.mini_size = 1 << shift, 1 << mini
        n_fat, self.root_at = struct.unpack_from("<II", data, 44)
        self.cutoff, self.mini_at, _, far_at, n_far = struct.unpack_from("<5I", data, 56)
        sectors = list(struct.unpack_from("<109I", data, 76))
        while n_far and far_at < _END:
            more = self.numbers(far_at)
            sectors += more[:-1]
            far_at, n_far = more[-1], n_far - 1
        self.fat = [x for s in sectors[:n_fat] if s < _END for x in self.numbers(s)]

    def sector(self, i: int) -> bytes:
        return self.data[(i + 1) * self.size : (i + 2) * self.size]

    def numbers(self, i: int) -> tuple[int, ...]:
        raw = self.sector(i)
        return struct.unpack(f"<{len(raw) // 4}I", raw[: len(raw) // 4 * 4])

    def chain(self, first: int, table: list[int], read: Callable[[int], bytes]) -> bytes:
        out, at = [], first
        while at < len(table) and len(out) <= len(table):  # a loop in the table ends too
            out.append(read(at))
            at = table[at]
        return b"".join(out)

    @cached_property
    def entries(self) -> list[tuple[str, int, int, int, int, int, int]]:
        """name, kind, left, right, child, first sector and size of each directory entry."""
        raw = self.chain(self.root_at, self.fat, self.sector)
        out = []
        for at in range(0, len(raw) - 127, 128):
            length = struct.unpack_from("<H", raw, at + 64)[0]
            name = raw[at : at + max(0, min(length, 64) - 2)].decode("utf-16-le", "replace")
            out.append((name, raw[at + 66], *struct.unpack_from("<III", raw, at + 68), *struct.unpack_from("<II", raw, at + 116)))
        return out

    @cached_property
    def streams(self) -> dict[str, int]:
        """Entries of streams by path, from the tree below the root."""
        found: dict[str, int] = {}
        todo, seen = [(self.entries[0][4], "")], set()
        while todo:
            i, prefix = todo.pop()
            if i >= len(self.entries) or i in seen:
                continue
            seen.add(i)
            name, kind, left, right, child, _, _ = self.entries[i]
            todo += [(left, prefix), (right, prefix)]
            if kind == 1:
                todo.append((child, f"{prefix}{name}/"))
            elif kind == 2:
                found[prefix + name] = i
        return found

    @cached_property
    def mini(self) -> tuple[list[int], bytes]:
        raw = self.chain(self.mini_at, self.fat, self.sector)
        return list(struct.unpack(f"<{len(raw) // 4}I", raw)), self.chain(self.entries[0][5], self.fat, self.sector)

    def read(self, path: str) -> bytes:
        *_, first, size = self.entries[self.streams[path]]
        if size >= self.cutoff:
            return self.chain(first, self.fat, self.sector)[:size]
        table, packed = self.mini
        return self.chain(first, table, lambda i: packed[i * self.mini_size : (i + 1) * self.mini_size])[:size]


def in_order(names: list[str]) -> list[str]:
    """Names by the number in their last part, then by name."""
    number = lambda n: int((re.search(r"\d+", n.rsplit("/", 1)[-1]) or [0])[0])
    return sorted(names, key=lambda n: (number(n), n))


def is_binary(data: bytes) -> bool:
    try:
        return CompoundFile(data).read("FileHeader").startswith(BINARY_MARK)
    except (ValueError, KeyError, IndexError, struct.error):
        return False


def is_package(data: bytes) -> bool:
    try:
        with zipfile.ZipFile(io.BytesIO(data)) as z:
            names = z.namelist()
            return ("mimetype" in names and z.read("mimetype").strip() == PACKAGE_MARK) or any(map(_SECTION.match, names))
    except (zipfile.BadZipFile, OSError, RuntimeError, zlib.error):
        return False


def paragraph(units: tuple[int, ...]) -> str:
    """Text of a paragraph's units; control characters are stepped over by their width."""
    out, skip = [], 0
    for u in units:
        if skip:
            skip -= 1
        elif u >= 32:
            out.append(u)
        else:
            out += map(ord, AS_TEXT.get(u, ""))
            skip = 7 if u in WIDE else 0
    return struct.pack(f"<{len(out)}H", *out).decode("utf-16-le", "replace")


def section(data: bytes) -> str:
    """Paragraphs of a section, a stream of records of tag, level and size."""
    out, at = [], 0
    while at + 4 <= len(data):
        head = int.from_bytes(data[at : at + 4], "little")
        tag, size, at = head & 0x3FF, head >> 20, at + 4
        if size == 0xFFF:
            size, at = int.from_bytes(data[at : at + 4], "little"), at + 4
        if tag == PARAGRAPH_TEXT:
            body = data[at : at + size]
            out.append(paragraph(struct.unpack(f"<{len(body) // 2}H", body[: len(body) // 2 * 2])))
        at += size
    return "\n".join(p for p in out if p.strip())


def binary_text(data: bytes) -> str | None:
    """Text of a binary document; none of an encrypted or damaged one."""
    file = CompoundFile(data)
    head = file.read("FileHeader")
    if len(head) < 40 or head[36] & 2:
        return None
    parts = []
    for name in in_order([n for n in file.streams if re.fullmatch(r"BodyText/section[^/]*", n, re.I)]):
        body = file.read(name)
        try:
            parts.append(section(zlib.decompress(body, -15) if head[36] & 1 else body))
        except zlib.error:
            continue
    return "\n".join(p for p in parts if p).strip() or None


def package_text(data: bytes, markup: Callable[[str], str]) -> str | None:
    """Text of a package's sections in the order of their numbers."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        parts = [markup(z.read(n).decode("utf-8", "replace")) for n in in_order([n for n in z.namelist() if _SECTION.match(n)])]
    return "\n".join(p for p in parts if p).strip() or None
