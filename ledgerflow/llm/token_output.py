"""Token ids of documents as binary files, and their reading.

Texts are encoded as the library does, pre-token by pre-token: numpy finds the
pre-tokens of all texts of a slice from the classes of their characters, a table from
their hashes gives the ids of those a worker has met, the library those of the others.
Texts with characters that engines class differently, or with the text of a special
token, go to the library whole. The ids are counted over all documents, and each gets a
rank by frequency. Documents are range-partitioned by doc_id; each partition is a file.

A file is a row of blocks, each of whole documents of about BLOCK_IDS ids:

    header   8 little-endian unsigned 64-bit integers: MAGIC, documents, ids,
             control bytes, data bytes, 0, 0, 0
    doc ids  signed 64-bit integers; flags: a byte each, 1 where the id is null
    sizes    unsigned 64-bit integers, ids of each document
    control  two bits for each rank, four to a byte, lowest first: its bytes less one
    data     the ranks' 1 to 4 bytes, little-endian

A decoder looks each control byte up in a table of four lengths and places, so that no rank
waits for the one before. The ids by rank are a file of their own. A list of blocks, as a table, says
which files count: what a lost task wrote is never listed, and a repeated one has a new name. Each
block knows the ids before it in its file, and a file's ids are summed over files.

Null and empty texts have the end id alone; texts of any length are encoded in slices of
whole texts; rows that repeat a doc_id are documents each, in the order of their
ids' hash; a null doc_id comes first. Empty tables give no files and no rows. Only
doc_id and text are read, so other columns cannot clash.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel

from .shared import Spans, Table, discard, per_row, records, saved, shared_dir, slices, small_batches, texts, tidy
from .token_counts import PLAIN, simple_specials, tokenizer_of

END_ID = 0
#: Ids of a block, and of a file.
BLOCK_IDS, FILE_IDS = 1 << 20, 1 << 24
#: Bytes of text that are encoded at once.
TEXT_BYTES = 1 << 20
#: Ids of pre-tokens that a worker keeps before it starts anew.
KEPT_IDS = 1 << 22
MAGIC = 0x3144494E454B4F54
_HEADER = 8

# -- encoding ---------------------------------------------------------------------

BLANK, LETTER, DIGIT, OTHER, STRANGE = range(5)


def _classes() -> np.ndarray:
    """The class of every character of PLAIN up to U+20FF, and STRANGE for all others."""
    out = np.full(0x2100, STRANGE, np.uint8)
    kinds = [(LETTER, regex.compile(r"\p{L}")), (DIGIT, regex.compile(r"\p{N}")), (BLANK, regex.compile(r"\s"))]
    for c in range(0x2100):
        if PLAIN.fullmatch(chr(c)):
            out[c] = next((k for k, p in kinds if p.fullmatch(chr(c))), OTHER)
    return out


_CLASS = _classes()


def byte_classes(raw: np.ndarray) -> np.ndarray:
    """The class of the character that each byte belongs to."""
    out = _CLASS.take(np.minimum(raw, 127))
    if raw.size and raw.max() > 127:
        out[raw > 127] = STRANGE
        lead = np.flatnonzero((raw >= 0xC2) & (raw < 0xE0))
        out[lead] = out[lead + 1] = _CLASS[((raw[lead] & 0x1F).astype(np.int64) << 6) | (raw[lead + 1] & 0x3F)]
        lead = np.flatnonzero((raw >= 0xE0) & (raw < 0xF0))
        point = ((raw[lead] & 0x0F).astype(np.int64) << 12) | ((raw[lead + 1] & 0x3F).astype(np.int64) << 6) | (raw[lead + 2] & 0x3F)
        out[lead] = out[lead + 1] = out[lead + 2] = np.where(point < len(_CLASS), _CLASS[np.minimum(point, len(_CLASS) - 1)], STRANGE)
    return out


def pre_tokens(raw: np.ndarray, at: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Where the pre-tokens of plain texts start; rows are bounded by ``at``."""
    n = len(raw)
    rows = np.zeros(n + 1, bool)
    rows[at] = True
    start = rows[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # blanks before a word: the last is a space of the word's, or a token of its own
    word = np.flatnonzero(start[1:] & (kind[1:] != BLANK) & (kind[:-1] == BLANK) & ~rows[1:n]) + 1
    start[word - 1] = True
    start[word] = raw[word - 1] != 32
    # contractions: an apostrophe that begins a token, and the letters that go with it
    mark = np.flatnonzero((raw == 39) & start)
    mark = mark[(mark + 1 < n)]
    mark = mark[~rows[mark + 1]]
    if len(mark):
        a = raw[mark + 1]
        b = np.where(~rows[np.minimum(mark + 2, n)], raw[np.minimum(mark + 2, n - 1)], 0)
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        start[mark[one | two] + 1] = False
        for take, hit in ((2, mark[one]), (3, mark[two])):
            end = hit + take
            end = end[end < n]
            start[end[kind[end] == LETTER]] = True
    return np.flatnonzero(start)


def _byte_characters() -> dict[int, int]:
    """Byte-level vocabularies spell printable Latin-1 bytes as themselves and the others, in order, from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    return {b: 0x100 + i for i, b in enumerate(b for b in range(256) if b not in printable)}


BYTE_CHARACTERS = _byte_characters()


class Encoder:
    """Ids of texts, each followed by the end id."""

    def __init__(self, path: str):
        self.tokenizer = tokenizer_of(path)
        specials = simple_specials(self.tokenizer)
        self.plain = specials is not None
        self.specials = specials or []
        byte_level = self.plain and isinstance(self.tokenizer.pre_tokenizer, ByteLevel) and not self.tokenizer.pre_tokenizer.add_prefix_space
        self.plain = byte_level and isinstance(self.tokenizer.model, BPE)
        self.model = self.tokenizer.model if self.plain else None
        self.forget()

    def forget(self) -> None:
        self.known, self.ids, self.n = Table(), np.zeros(1 << 16, np.uint32), 0
        self.at = np.zeros(1 << 14, np.int64)
        self.entries = 0

    def ids_of(self, words: list[bytes]) -> list[list[int]]:
        """The ids of pre-tokens, by the library's model, whose characters stand for bytes."""
        tokens = self.model.tokenize
        return [[t.id for t in tokens(w.decode("latin-1").translate(BYTE_CHARACTERS))] for w in words]

    def learn(self, keys: np.ndarray, words: list[bytes]) -> None:
        found = self.ids_of(words)
        sizes = np.array([len(x) for x in found], np.int64)
        flat = np.fromiter((i for x in found for i in x), np.uint32, int(sizes.sum()))
        while self.n + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while self.entries + len(keys) + 1 > len(self.at):
            self.at = np.concatenate([self.at, np.zeros_like(self.at)])
        self.ids[self.n : self.n + len(flat)] = flat
        self.at[self.entries + 1 : self.entries + 1 + len(keys)] = self.n + np.cumsum(sizes)
        self.known.store(keys, np.arange(self.entries, self.entries + len(keys), dtype=np.int32))
        self.n += len(flat)
        self.entries += len(keys)

    def by_library(self, rows: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch(rows, add_special_tokens=False)]

    def __call__(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text of the column."""
        raw, at = texts(column)
        for lo, hi in slices(at, TEXT_BYTES):
            yield from self.slice(raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo])

    def slice(self, raw: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        kind = byte_classes(raw)
        odd = per_row(kind == STRANGE, at) > 0 if self.plain else np.ones(len(at) - 1, bool)
        data = raw.tobytes()
        for s in self.specials:
            if s.encode() in data:
                odd |= np.array([s.encode() in data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)])
        start = pre_tokens(raw, at, kind) if not odd.all() else np.zeros(0, np.int64)
        row = np.searchsorted(at, start, "right") - 1
        end = np.append(start[1:], len(raw))
        if odd.any():
            mine = ~odd[row] if len(row) else np.zeros(0, bool)
            start, row, end = start[mine], row[mine], end[mine]
        key = Spans(raw, False)(start, end)
        key[key == 0] = 1
        if self.n > KEPT_IDS:
            self.forget()
        entry = self.known(key)
        if len(new := np.flatnonzero(entry < 0)):
            fresh, first = np.unique(key[new], return_index=True)
            first = new[first]
            self.learn(fresh, [data[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)])
            entry[new] = self.known(key[new])
        begin, size = self.at[entry], self.at[entry + 1] - self.at[entry]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.ids[np.repeat(begin - (ends - size), size) + np.arange(total)]
        cuts = np.append(0, ends)[np.searchsorted(row, np.arange(len(at)))]
        out = [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        if len(which := np.flatnonzero(odd)):
            for r, x in zip(which, self.by_library([data[at[r] : at[r + 1]].decode() for r in which]), strict=True):
                out[r] = x
        return out


_encoders: dict[str, Encoder] = {}


def encode_batches(batches: Iterator[pa.RecordBatch], path: str, end_id: int, kind: str) -> Iterator[pa.RecordBatch]:
    """doc_id, ids as little-endian integers of ``kind``, and how many, of every text."""
    encode = _encoders.setdefault(path, None) or Encoder(path)
    _encoders[path] = encode
    end = np.array([end_id], kind).tobytes()
    for batch in batches:
        ids = [x.astype(kind).tobytes() + end for x in encode(batch.column("text"))]
        yield records(doc_id=batch.column("doc_id"), ids=pa.array(ids, pa.binary()), n=np.array([len(x) // np.dtype(kind).itemsize for x in ids], np.int64))


def count_ids(batches: Iterator[pa.RecordBatch], size: int, kind: str) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(size, np.int64)
    for batch in batches:
        counts += np.bincount(joined(batch.column("ids"), kind), minlength=size)
    there = np.flatnonzero(counts)
    yield records(id=there.astype(np.int32), n=counts[there])


def joined(column: pa.Array, kind: str) -> np.ndarray:
    """All ids of a binary column, one row after the other."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind) if len(column) and data is not None else np.zeros(0, kind)


# -- the coding of ranks ----------------------------------------------------------

#: By control byte: the lengths of its four ranks, and where each begins.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
PLACES = np.cumsum(LENGTHS, axis=1) - LENGTHS
SUMS = LENGTHS.sum(axis=1)


def coded(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of ranks below 2**32; the last control byte may name ranks that are not there."""
    r = ranks.astype("<u4")
    size = 1 + (r > 0xFF).astype(np.uint8) + (r > 0xFFFF) + (r > 0xFFFFFF)
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4) < size[:, None]]
    code = np.zeros(-(-len(r) // 4) * 4, np.uint8)
    code[: len(r)] = size - 1
    code = code.reshape(-1, 4)
    return (code[:, 0] | code[:, 1] << 2 | code[:, 2] << 4 | code[:, 3] << 6).tobytes(), data.tobytes()


def decoded(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ranks of a block."""
    sums = SUMS[control]
    at = ((np.cumsum(sums) - sums)[:, None] + PLACES[control]).reshape(-1)[:n]
    size = LENGTHS[control].reshape(-1)[:n]
    out = data[at].astype(np.uint32)
    for k in range(1, 4):
        if not len(more := np.flatnonzero(size > k)):
            break
        out[more] |= data[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


# -- files --------------------------------------------------------------------------


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def block(doc_ids: list[int | None], ids: list[np.ndarray], rank_of: np.ndarray) -> bytes:
    control, data = coded(rank_of[np.concatenate(ids)])
    sizes = np.array([len(x) for x in ids], "<u8")
    null = np.array([d is None for d in doc_ids], np.uint8)
    head = np.array([MAGIC, len(ids), int(sizes.sum()), len(control), len(data), 0, 0, 0], "<u8")
    return b"".join([head.tobytes(), np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(), sizes.tobytes(), control, data])


def write_batches(batches: Iterator[pa.RecordBatch], folder: str, rank_of: np.ndarray, kind: str) -> Iterator[pa.RecordBatch]:
    """Write a partition's documents as one file; a row for each block."""
    shard = TaskContext.get().partitionId()
    name = f"{folder}/{shard:06d}-{uuid.uuid4().hex}.ids"
    fs, path = _open(name)
    out, at, before, held, docs, listed = None, 0, 0, [], [], []

    def flush() -> None:
        nonlocal out, at, before, held, docs
        if out is None:
            out = fs.open_output_stream(path)
        data, n = block(docs, held, rank_of), sum(map(len, held))
        out.write(data)
        listed.append((shard, name, at, len(data), before, n))
        at, before, held, docs = at + len(data), before + n, [], []

    waiting = 0
    try:
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), strict=True):
                x = np.frombuffer(ids.as_buffer(), kind)
                if held and waiting + len(x) > BLOCK_IDS:
                    flush()
                    waiting = 0
                held.append(x.copy())
                docs.append(doc)
                waiting += len(x)
        if held:
            flush()
    finally:
        if out is not None:
            out.close()
    yield pa.RecordBatch.from_pydict(dict(zip(("shard", "path", "at", "size", "before", "n"), map(list, zip(*listed, strict=True)) if listed else [[]] * 6, strict=True)), BLOCK_SCHEMA)


BLOCKS = "shard int, path string, at long, size long, before long, n long"
BLOCK_SCHEMA = pa.schema([("shard", pa.int32()), ("path", pa.string()), ("at", pa.int64()), ("size", pa.int64()), ("before", pa.int64()), ("n", pa.int64())])


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc ids, their nulls, sizes and ranks of a block."""
    magic, docs, n, control, size = (int(x) for x in np.frombuffer(data, "<u8", 5))
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = 8 * _HEADER
    doc_ids, at = np.frombuffer(data, "<i8", docs, at), at + 8 * docs
    null, at = np.frombuffer(data, np.uint8, docs, at), at + docs
    sizes, at = np.frombuffer(data, "<u8", docs, at).astype(np.int64), at + 8 * docs
    codes, at = np.frombuffer(data, np.uint8, control, at), at + control
    return doc_ids, null.astype(bool), sizes, decoded(codes, np.frombuffer(data, np.uint8, size, at), n)


def read_blocks(batches: Iterator[pa.RecordBatch], ids_at: str) -> Iterator[tuple[dict, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Each listed block with its doc ids, nulls, sizes and token ids."""
    fs, path = _open(ids_at)
    with fs.open_input_file(path) as f:
        by_rank = np.frombuffer(f.read(), "<u4")
    for batch in batches:
        for b in batch.to_pylist():
            fs, path = _open(b["path"])
            with fs.open_input_file(path) as f:
                f.seek(b["at"])
                doc_ids, null, sizes, ranks = unpacked(f.read(b["size"]))
            yield b, doc_ids, null, sizes, by_rank[ranks].astype("<u4")


def digest_batches(batches: Iterator[pa.RecordBatch], ids_at: str) -> Iterator[pa.RecordBatch]:
    """doc_id, start, n_tokens and the CRC-32 of the ids of each document of the listed blocks."""
    for b, doc_ids, null, sizes, ids in read_blocks(batches, ids_at):
        cuts = np.append(0, np.cumsum(sizes))
        data = memoryview(ids.tobytes())
        crcs = np.array([zlib.crc32(data[4 * x : 4 * y]) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)], np.int64)
        yield records(doc_id=pa.array(doc_ids.astype(np.int64), mask=null), start=b["first"] + b["before"] + cuts[:-1], n_tokens=sizes, ids_crc32=crcs)


def id_batches(batches: Iterator[pa.RecordBatch], ids_at: str) -> Iterator[pa.RecordBatch]:
    """doc_id, start and the ids themselves."""
    for b, doc_ids, null, sizes, ids in read_blocks(batches, ids_at):
        cuts = np.append(0, np.cumsum(sizes))
        lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(ids.astype(np.int64)))
        yield records(doc_id=pa.array(doc_ids.astype(np.int64), mask=null), start=b["first"] + b["before"] + cuts[:-1], ids=lists)


class TokenFiles:
    """Written files: the list of their blocks, and the file of ids by rank."""

    def __init__(self, blocks: DataFrame, ids_at: str):
        self.blocks, self.ids_at = blocks, ids_at

    def _listed(self) -> DataFrame:
        """Blocks with the ids of all files before theirs; a row for each file is summed."""
        files = self.blocks.groupBy("shard").agg(F.sum("n").alias("ids"))
        first = files.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("first"))
        return self.blocks.join(first, "shard").repartition(max(1, self.blocks.count()), F.col("path"), F.col("at"))

    def digests(self) -> DataFrame:
        at = self.ids_at
        return self._listed().mapInArrow(lambda b: tidy(digest_batches(b, at)), "doc_id long, start long, n_tokens long, ids_crc32 long")

    def ids(self) -> DataFrame:
        at = self.ids_at
        return self._listed().mapInArrow(lambda b: tidy(id_batches(b, at)), "doc_id long, start long, ids array<long>")


def ranked_ids(encoded: DataFrame, size: int, kind: str) -> np.ndarray:
    """All ids of the vocabulary, the most frequent first, ties by id; a table of the vocabulary's size."""
    counts = np.zeros(size, np.int64)
    rows = encoded.select("ids").mapInArrow(lambda b: count_ids(b, size, kind), "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    for r in rows.collect():
        counts[r["id"]] = r["n"]
    return np.lexsort((np.arange(size), -counts)).astype("<u4")


def write_tokens(docs: DataFrame, path: str, end_id: int = END_ID) -> TokenFiles:
    """Encode all texts with the tokenizer at ``path`` and write them in ascending order of doc_id."""
    spark: SparkSession = docs.sparkSession
    small_batches(spark)
    size = max(tokenizer_of(path).get_vocab_size(), end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encoded = saved(rows.mapInArrow(lambda b: tidy(encode_batches(b, path, end_id, kind)), "doc_id long, ids binary, n long"), "token-ids", "zstd")
    by_rank = ranked_ids(encoded, size, kind)
    rank_of = np.empty(size, np.uint32)
    rank_of[by_rank] = np.arange(size)
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/ids-{uuid.uuid4().hex}"
    fs, at = _open(folder)
    fs.create_dir(at)
    with fs.open_output_stream(f"{at}/by-rank.u32") as f:
        f.write(by_rank.tobytes())
    total = encoded.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    order = [F.col("doc_id"), F.xxhash64("ids")]
    ranged = encoded.repartitionByRange(max(1, -(-total // FILE_IDS)), *order).sortWithinPartitions(*order).select("doc_id", "ids")
    blocks = saved(ranged.mapInArrow(lambda b: tidy(write_batches(b, folder, rank_of, kind)), BLOCKS), "blocks")
    discard(encoded)
    return TokenFiles(blocks, f"{folder}/by-rank.u32")


def token_output(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files written and read again."""
    return write_tokens(docs, path, end_id).digests()
