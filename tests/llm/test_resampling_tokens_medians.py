"""Importance resampling, token files and rolling medians against brute force, and long texts and repeated rows of older operators."""

import datetime as dt
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import decontaminate, importance_resampling as IR, line_dedup, quality_rules, rolling_median as RM, token_output as TO
from ledgerflow.llm.queries import QUERIES, tokenizer_file
from ledgerflow.llm.token_counts import tokenizer_of

SF = "/root/testdata/sf0.001"
BPE = tokenizer_file("byte_bpe_50k.json")

# -- medians -----------------------------------------------------------------------


def doubled(x):
    x = sorted(x)
    return x[(len(x) - 1) // 2] + x[len(x) // 2]


def brute_medians(rows, minutes=60):
    """click_id -> (kind, n, median2, mad4, far) of rows (click_id, ts, kind, value)."""
    once = {}
    for r in sorted((r for r in rows if r[1] is not None), key=lambda r: (r[1], r[2] is None, r[2] or "", r[3] is None, r[3] or 0)):
        once.setdefault(r[0], r)
    cents = {i: math.floor(100 * r[3] + 0.5) if r[3] is not None and math.isfinite(r[3]) else None for i, r in once.items()}
    out = {}
    for i, (_, ts, kind, _) in once.items():
        w = [cents[j] for j, o in once.items() if o[2] == kind and ts - dt.timedelta(minutes=minutes) <= o[1] <= ts and cents[j] is not None]
        m = doubled(w) if len(w) > 1 else None
        mad = doubled([abs(2 * c - m) for c in w]) if len(w) > 1 else None
        out[i] = (kind, len(w), m, mad, None if m is None or cents[i] is None else 2 * abs(2 * cents[i] - m) > 3 * mad)
    return out


CLICKS = "click_id long, ts timestamp_ntz, kind string, value double, props string"


def medians(spark, rows):
    got = RM.rolling_median(spark.createDataFrame([(*r, "{}") for r in rows], CLICKS)).collect()
    assert len({r["click_id"] for r in got}) == len(got)
    return {r["click_id"]: (r["kind"], r["n"], r["median2"], r["mad4"], r["far"]) for r in got}


def some_clicks(n, r, span_s=20_000):
    at = dt.datetime(2024, 3, 31, 1, 0)
    rows = [(i, at + dt.timedelta(seconds=r.randrange(span_s)), r.choice(["view", "view", "view", "click", None, ""]), r.choice([None, 0.005, -1.5, r.randrange(-500, 900) / 100, 5.2, 1e6 * r.random()])) for i in range(n)]
    return rows + [(n, None, "view", 1.0), (n + 1, at, "view", float("nan")), (n + 2, at, "view", float("inf")), *rows[:20]]


@pytest.mark.parametrize("bits, part", [(17, 1 << 18), (3, 40), (1, 12)])
def test_medians_as_brute_force(spark, monkeypatch, bits, part):
    """Also with chunks of eight and two events, so that windows, moments and kinds lie in many of them."""
    monkeypatch.setattr(RM, "_CHUNK_BITS", bits)
    monkeypatch.setattr(RM, "_PART_BITS", 33 - bits)
    monkeypatch.setattr(RM, "PART_EVENTS", part)
    rows = some_clicks(250, random.Random(bits))
    hot = dt.datetime(2024, 3, 31, 2, 30)
    rows += [(1000 + i, hot, "view", (i * 37 % 50) / 10) for i in range(40)] + [(1100, hot + dt.timedelta(minutes=60), "view", 3.0), (1101, hot + dt.timedelta(minutes=60, microseconds=1), "view", 3.0)]
    assert medians(spark, rows) == brute_medians(rows)


def test_no_clicks_and_few(spark):
    assert medians(spark, []) == {}
    rows = [(1, None, "a", 1.0), (2, dt.datetime(2024, 1, 1), None, None), (3, dt.datetime(2024, 1, 1), "a", 1.0), (None, dt.datetime(2024, 1, 1), "a", 2.0), (None, dt.datetime(2024, 1, 1), "a", 2.0)]
    assert medians(spark, rows) == {2: (None, 0, None, None, None), 3: ("a", 2, 300, 200, False), None: ("a", 2, 300, 200, False)}


def test_lanes_of_any_length(monkeypatch):
    """A chunk gives the same however it is cut into lanes."""
    r = np.random.default_rng(5)
    n, window = 600, 40
    ts, cents = np.sort(r.integers(0, 900, n)), r.integers(-50, 50, n)
    at, what, c = np.concatenate([ts, ts + window]), np.repeat([RM.CLICK, RM.LEAVES], n), np.concatenate([cents, cents])
    o = np.lexsort((what, at))
    at, what, c = at[o], what[o], c[o]
    want = [[int(x) for x in c[(what == RM.CLICK) & (at <= t) & (at >= t - window)]] for t in at]
    for lane in (1, 7, 64, 5000):
        monkeypatch.setattr(RM, "LANE_EVENTS", lane)
        counts, m2, mad, held = RM.chunk_medians(at, what, c, np.ones(len(at), bool), np.where(what == RM.LEAVES, -1, 1), (np.zeros(0, np.int64), np.zeros(0, np.int64)))
        assert not len(held[0])
        for k in np.flatnonzero(what == RM.CLICK):
            w = want[k]
            assert counts[k] == len(w)
            if len(w) > 1:
                assert (m2[k], mad[k]) == (doubled(w), doubled([abs(2 * x - doubled(w)) for x in w]))


def test_medians_gather_nothing(spark, monkeypatch):
    """No window or group of a whole series, no cross join, no broadcast of clicks."""
    monkeypatch.setattr(RM, "PART_EVENTS", 20)
    rows = spark.createDataFrame([(*r, "{}") for r in some_clicks(50, random.Random(1))], CLICKS)
    plan = RM.rolling_median(rows)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "SinglePartition" not in plan


# -- resampling --------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def grams(text):
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def brute_resample(docs, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    s, t = [0] * 10000, [0] * 10000
    for texts, c in ((x for _, x in docs), s), (target, t):
        for x in texts:
            for f in grams(x)[1]:
                c[bucket(f)] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10000) / ((s[b] + 1) * (sum(t) + 10000)))) for b in range(10000)]
    rows = []
    for d, x in docs:
        w, f = grams(x)
        weight = sum(gain[bucket(y)] for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(w) >= 20])
    able = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[: 25 * len(able) // 100])}
    return sorted(((*r[:4], rank.get(id(r))) for r in rows), key=str)


def test_resampling_as_brute_force(spark):
    r = random.Random(4)
    vocab = ["the", "ÉTÉ", "été", "don", "T", "42", "日本", "x" * 70, "y" * 200, "ß"]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", "  ", "\n", "-", "'"]) for _ in range(n))
    docs = [(i, text(r.randrange(60))) for i in range(120)] + [(200, None), (201, ""), (202, " \n"), (None, text(30)), (7, text(30))]
    docs += [docs[5]] * 2  # repeated rows
    target = [text(20), None, "the the the", ""]
    df = spark.createDataFrame([(d, t, "src", 1.0) for d, t in docs], "doc_id long, text string, rank string, score double")
    got = IR.importance_resampling(df, spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"))
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(docs, target)


def test_resampling_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert [r["n_features"] for r in IR.importance_resampling(docs, docs.limit(0)).collect()] == [79]
    assert IR.importance_resampling(docs.limit(0), docs).count() == 0


def test_long_texts_in_slices(monkeypatch):
    r = random.Random(2)
    text = " ".join(r.choice(["ab", "c", "déf", "z" * 90, "gh"]) + r.choice(["", "  ", "\n"]) for _ in range(900)) + " " * 300 + "q" * 500 + " tail end"
    want = sorted(zlib.crc32(f.encode()) % 10000 for f in grams(text)[1])
    for size in (1 << 20, 64, 150, 1000):
        monkeypatch.setattr(IR, "SLICE_BYTES", size)
        parts = [f for _, f in IR.features(pa.array(["x y", text, None]))]
        whole = [f for _, f in IR.features(pa.array([text]))]
        assert sorted(b for f in whole for b in f.bucket.tolist()) == want and sum(int(f.words.sum()) for f in whole) == len(grams(text)[0])
        assert sum(len(f.bucket) for f in parts) == len(want) + 3


# -- token files -------------------------------------------------------------------


def test_encoder_as_library():
    r = random.Random(3)
    parts = [*"ab'stremvld  \n\t.,!1 2éçñßÀ×÷¼²—€’“", "'s", "'re", "'ll", " 've", "don't", "  ", "\r\n", "<|endoftext|>", "日本", " ", "\u0085", "ſ", "\x1c", "\x00"]
    some = ["".join(r.choice(parts) for _ in range(r.randint(0, 40))) for _ in range(3000)] + ["", None, "'", "'s's", "'ll'", "\n\n a", " \n a", "a \n", "l'été", "word " * 5000]
    encode, library = TO.Encoder(BPE), tokenizer_of(BPE)
    for _ in range(2):  # again from what it has learned
        got = list(encode(pa.array(some)))
        want = library.encode_batch([x or "" for x in some], add_special_tokens=False)
        assert all(g.tolist() == w.ids for g, w in zip(got, want, strict=True))
        encode.n = TO.KEPT_IDS + 1  # the next slice forgets all


def test_encoder_of_another_kind():
    path = tokenizer_file("word_bpe_49k.json")
    some = ["Hello, World's end", "", "<|endoftext|> x", "l'été"]
    want = tokenizer_of(path).encode_batch(some, add_special_tokens=False)
    assert [x.tolist() for x in TO.Encoder(path)(pa.array(some))] == [w.ids for w in want]


def test_coding_round_trip():
    r = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 10_001):
        ranks = r.integers(0, 1 << 32, n) >> r.integers(0, 32, n)
        control, data = TO.coded(ranks)
        assert len(control) == -(-n // 4) and (TO.decoded(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n) == ranks).all()
    assert len(TO.coded(np.zeros(8, np.int64))[1]) == 8


def brute_tokens(docs):
    library, at, out = tokenizer_of(BPE), 0, []
    for d, x in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*library.encode(x or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((d, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_token_files_as_library(spark, monkeypatch):
    monkeypatch.setattr(TO, "FILE_IDS", 3000)
    r = random.Random(9)
    docs = [(r.randrange(10**9), " ".join(r.choice(["the", "Cat's", "été", "日本", "  x", "\n"]) for _ in range(r.randrange(90)))) for _ in range(150)] + [(None, "no id"), (3, None), (4, ""), (5, "long " * 3000)]
    files = TO.write_tokens(spark.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, start int"), BPE)
    assert sorted(map(tuple, files.digests().collect()), key=str) == sorted(brute_tokens(docs), key=str)
    assert files.blocks.select("path").distinct().count() > 1
    ids = {r["doc_id"]: r["ids"] for r in files.ids().collect()}
    assert ids[3] == [0] and ids[4] == [0] and ids[None] == [*tokenizer_of(BPE).encode("no id").ids, 0]


def test_no_documents_no_files(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert TO.token_output(empty, BPE).count() == 0


def test_repeated_rows_are_documents_each(spark):
    docs = [(1, "a b"), (1, "a b"), (2, "c")]
    got = TO.token_output(spark.createDataFrame(docs, "doc_id long, text string"), BPE).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"]) for r in got) == [(1, 0, 3), (1, 3, 3), (2, 6, 2)]


def test_files_of_the_given_tables(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_token_output"](spark, SF).collect())) == brute_tokens(docs)


# -- older operators -----------------------------------------------------------------


def test_long_text_and_an_item_of_one_token(spark):
    """A text of 200,000 tokens beside items of one and of many tokens."""
    r = random.Random(1)
    item = [f"i{k}" for k in range(40)]
    long = [f"w{r.randrange(5000)}" for _ in range(200_000)]
    long[150_000:150_040] = item[:10] + ["x", "y"] + item[12:]
    docs = spark.createDataFrame([(1, " ".join(long)), (2, "short text"), (3, " ".join(long[:1000]))], "doc_id long, text string")
    items = spark.createDataFrame([(10, " ".join(item)), (11, "onlyone"), (12, "w17")], "item_id long, text string")
    got = {x["doc_id"]: x["item_ids"] for x in decontaminate.decontaminate(docs, items).collect()}
    assert got == {1: [10, 12], 2: [], 3: [12] if "w17" in long[:1000] else []}


def test_hits_needed_are_hits_there():
    """Every way for half of an item to be equal gives the number of hits that is asked for."""
    r = random.Random(8)
    spans = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    for _ in range(2000):
        n = r.randrange(3, 130)
        equal = set(r.sample(range(n), math.ceil(n / 2)))
        if r.random() < 0.5:  # the worst patterns are regular ones
            step = r.choice(["10", "1100", "110000", "11000", "1100011000", "100"])
            equal = {i for i in range(n) if step[i % len(step)] == "1"}
        if 2 * len(equal) < n:
            continue
        hits = sum(all(at + i in equal for i in m) for m in spans for at in range(n - m[-1]))
        blocks = n // 10
        needed = max(1, min(decontaminate._bounds()[0], math.ceil(n / 2) - (n - 10 * blocks) - 4 * blocks))
        assert hits >= needed or hits == 0 and n < 7, (n, sorted(equal))


def test_repeated_row_that_loses_a_line(spark):
    line = "a line of more than forty characters, that many share"
    docs = spark.createDataFrame([(i, f"own {i}\n{line}") for i in (1, 1, 2, 3, 4, 5)], "doc_id long, text string")
    got = sorted((r["doc_id"], r["n_lines"], r["n_dropped"]) for r in line_dedup.line_dedup(docs).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 2, 1), (5, 2, 0)]
    kept = line_dedup.with_bitmaps(docs).where(F.col("doc_id") == 1).collect()
    assert [r["n_dropped"] for r in kept] == [1, 1]


def test_hosts_of_urls_are_judged_together(spark):
    """Pages of one domain share its rate, whatever their path, user or case; a null source is a host of its own."""
    good = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(i, "too short", f"https://Bad.example/p{i}?q={i}") for i in range(60)] + [(100, good, "http://u@bad.example/x"), (101, good, "good.example"), (102, good, None)] + [(200 + i, good, f"https://good.example/{i}") for i in range(60)]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, source string")).collect()}
    assert {got[i]["host"] for i in (0, 59, 100)} == {"bad.example"} and {got[i]["host"] for i in (101, 200)} == {"good.example"} and got[102]["host"] is None
    assert not got[100]["kept"] and not got[100]["base_failed"] and got[101]["kept"]
