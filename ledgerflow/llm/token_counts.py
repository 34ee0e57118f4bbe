"""Token counts by a two-tier lookup on the map side; no pre-token is ever shuffled.

Tier one is a broadcast hash table of pre-token lengths. A byte-pair vocabulary
lists its entries by how frequent they were, so the table holds every entry that
is a pre-token, with the length the library gives it: at most the vocabulary's
size, whatever the input's. Tier two is each Python worker's own cache of the
lengths of all other pre-tokens, emptied when it reaches CACHE_ENTRIES. Pre-tokens
come from the rule below where a text has only characters that every engine of
regular expressions classes alike, and else from the library's own pre-tokenizer,
so both tiers serve every script. The text of a special token is one token and
parts the text, as the library does it by default.

Null and empty texts have 0 bytes and 0 tokens; repeated rows are counted each;
ties cannot occur; an empty table gives no rows; columns other than doc_id and text
are not read, so their names cannot clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import records, small_batches

CACHE_ENTRIES = 1 << 18
#: The pre-token rule of byte-level BPE tokenizers, a fixed value.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that every engine classes alike.
PLAIN = regex.compile(r"[\t\n\r\x20-\x7E\xA1-ɏ‐-‧‰-⁞€]*")


class Lengths(dict):
    """Token counts of pre-tokens, by lookup or else by the library."""

    def __init__(self, frequent: dict[str, int], tokenizer):
        super().__init__(frequent)
        self.frequent, self.tokenizer = frequent, tokenizer

    def __missing__(self, piece: str) -> int:
        if len(self) >= CACHE_ENTRIES + len(self.frequent):
            self.clear()
            self.update(self.frequent)
        n = self[piece] = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return n


def tokenizer_of(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def frequent_lengths(path: str) -> dict[str, int]:
    """The vocabulary entries that are pre-tokens, with their lengths."""
    t = tokenizer_of(path)
    special = {x.content for x in t.get_added_tokens_decoder().values()}
    whole = regex.compile(PRE_TOKEN)
    pieces = [p for p in t.decode_batch([[i] for i in range(t.get_vocab_size())], skip_special_tokens=False) if p and p not in special and "\ufffd" not in p]
    pieces = [p for p in pieces if ((m := whole.match(p)) and m.end() == len(p) if PLAIN.fullmatch(p) else len(t.pre_tokenizer.pre_tokenize_str(p)) == 1)]
    return dict(zip(pieces, (len(e.ids) for e in t.encode_batch(pieces, add_special_tokens=False)), strict=True))


def simple_specials(t) -> list[str] | None:
    """The texts of special tokens, the longest first; None if one has rules of its own or the tokenizer rewrites texts first."""
    added = t.get_added_tokens_decoder().values()
    if t.normalizer is not None or t.pre_tokenizer is None or any(x.lstrip or x.rstrip or x.single_word for x in added):
        return None
    return sorted((x.content for x in added), key=len, reverse=True)


class Counter:
    """Counts the tokens of texts by lookups of their pre-tokens."""

    def __init__(self, path: str, frequent: dict[str, int]):
        self.tokenizer = tokenizer_of(path)
        self.lengths = Lengths(frequent, self.tokenizer)
        self.pre_tokens, self.plain = regex.compile(PRE_TOKEN).findall, PLAIN.fullmatch
        self.specials = simple_specials(self.tokenizer)
        self.split = re.compile("|".join(map(re.escape, self.specials))).split if self.specials else None

    def __call__(self, text: str) -> int:
        if self.specials is None:
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        if self.split and any(s in text for s in self.specials):
            parts = self.split(text)
            return len(parts) - 1 + sum(map(self.part, parts))
        return self.part(text)

    def part(self, text: str) -> int:
        if self.plain(text):
            return sum(map(self.lengths.__getitem__, self.pre_tokens(text)))
        return sum(self.lengths[text[a:b]] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(text))


_workers: dict[str, Counter] = {}


def count_batches(batches: Iterator[pa.RecordBatch], path: str, frequent: Broadcast) -> Iterator[pa.RecordBatch]:
    if path not in _workers:
        _workers[path] = Counter(path, frequent.value)
    count = _workers[path]
    for batch in batches:
        counts = [count(text) if text else 0 for text in batch.column("text").to_pylist()]
        yield records(doc_id=batch.column("doc_id"), n_bytes=batch.column("n_bytes"), n_tokens=pa.array(counts, pa.int64()))


def token_counts(docs: DataFrame, path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document, as the library counts for the file at ``path``."""
    spark = docs.sparkSession
    small_batches(spark)
    frequent = spark.sparkContext.broadcast(frequent_lengths(path))
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    out = rows.mapInArrow(lambda batches: count_batches(batches, path, frequent), "doc_id long, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
