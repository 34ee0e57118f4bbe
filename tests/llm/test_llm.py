"""Operators against brute force on a fixture with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import collections
import hashlib
import math
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import components, decontaminate, html_extract, language_id, license_scan, line_dedup, near_join, quality_classifier, quality_rules, sentencepieces, token_counts
from ledgerflow.llm.queries import QUERIES, tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, h string, row_key string, item_ids string, n_dropped int, p_doc string"


def texts():
    r = random.Random(3)
    vocab = [f"{a}{b}" for a in ("the", "mor", "Sta", "élan", "ünd", "qi", "ben") for b in ("", "ing", "er", "ß", "tion", "o")]
    line = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    shared = "This very same line occurs in many documents, really."
    out = [line(r.randint(30, 90)) + "\n" + (f"  {shared.upper() if i % 2 else shared}\t\n" if i % 3 == 0 else "") + line(r.randint(12, 40)) for i in range(40)]
    base = line(200).split(" ")
    for _ in range(25):  # near copies with up to five words changed
        w = list(base)
        for _ in range(r.randint(0, 5)):
            w[r.randrange(len(w))] = r.choice(vocab) + str(r.randrange(99))
        out.append(" ".join(w))
    return [*out, out[0], out[0], None, "", " \n\t ", "one two", "one two", "A b\x0bc d e", "###  $$$ ||| <|endoftext|> 日本語\x85\x1c x", line(9000), "a" * 3000, "\n\n"]


@pytest.fixture(scope="module")
def rows():
    out = [(i, t, ("en", "de", None)[i % 3], ("src0", "https://h.example/p/x", None)[i % 3], len(t or ""), None, "x", "y", "z", 1, "q") for i, t in enumerate(texts())]
    return [*out, out[1], (None, texts()[2], "en", None, 1, True, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def labels(spark, rows):
    return spark.createDataFrame([(i, int(i % 4 > 0), 0, "t") for i in range(40)] + [(None, 1, 0, "t"), (3, None, 1, "t")], "doc_id long, quality int, toxic int, text string")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def pairs(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_token_counts(docs, rows, none):
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    want = sorted(((r[0], len((r[1] or "").encode()), len(t.encode(r[1] or "", add_special_tokens=False).ids)) for r in rows), key=str)
    assert pairs(token_counts.token_counts(docs, path), "doc_id", "n_bytes", "n_tokens") == want
    assert token_counts.token_counts(none, path).count() == 0


def brute_rules(text):
    words = WORD.findall(text or "")
    runs = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if runs[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_quality_rules(docs, rows, none):
    want = sorted(((r[0], *brute_rules(r[1])) for r in rows), key=str)
    out = quality_rules.quality_rules(docs)
    assert pairs(out, "doc_id", *quality_rules.NAMES) == want
    for r in out.collect():
        failed = r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["host_rate"] <= 0.5)
    assert quality_rules.quality_rules(none).count() == 0


def test_host_rates_shrink(spark):
    rows = [("good", False)] * 200 + [("bad", True)] * 150 + [("bad", False)] * 10 + [("tiny", True)] + [(None, False)] * 5
    rates = {r["host"]: r["host_rate"] for r in quality_rules.host_rates(spark.createDataFrame(rows, "host string, base_failed boolean")).collect()}
    assert rates["good"] < 0.05 and rates["bad"] > 0.8 and 0.4 < rates["tiny"] < 1


def test_line_dedup(docs, rows, none):
    key = lambda x: "".join(c.lower() if c.isascii() else c for c in x.strip(" \t\n\x0b\x0c\r"))
    where = collections.defaultdict(set)
    for r in rows:
        for x in (r[1] or "").split("\n"):
            if r[0] is not None and len(key(x)) >= 40:
                where[key(x)].add(r[0])
    want = []
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if r[0] is None or len(where.get(key(x), ())) < 5 or max(where[key(x)]) == r[0]]
        want.append((r[0], len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    got = pairs(line_dedup.line_dedup(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert got == sorted(want, key=str) and sum(x[2] for x in got) > 5
    assert line_dedup.line_dedup(none).count() == 0


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_join(docs, rows, none):
    own = collections.defaultdict(list)
    for r in rows:
        if r[0] is not None:
            own[r[0]].append(sets_of(r[1]))
    root = {i: i for i in own}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in own:
        for j in own:
            if i < j and any(a and b and 100 * len(a & b) >= 80 * len(a | b) for a in own[i] for b in own[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    want = sorted({(r[0], len(sets_of(r[1])) if r[0] is not None else 0, find(r[0]) if r[0] is not None else None) for r in rows}, key=str)
    got = pairs(near_join.near_join(docs).distinct(), "doc_id", "n_shingles", "component_id")
    assert [x for x in zip(got, want, strict=True) if x[0] != x[1]] == []
    assert len({x[2] for x in got}) < len(own) - 10
    assert near_join.near_join(none).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, 900), (900, 7), (3, 3)]
    got = dict(pairs(components.connected_components(spark.createDataFrame(chain, "x long, y long")), "id", "label"))
    assert {got[i] for i in range(100, 161)} == {100} and got[900] == got[7] == got[5] == 5 and 3 not in got


def test_decontaminate(spark, docs, none):
    r = random.Random(8)
    words = [f"w{i}" for i in range(400)]
    items = [" ".join(r.choice(words) for _ in range(n)) for n in (30, 18, 40, 12, 6)]
    swapped = items[2].split(" ")
    swapped[7] = swapped[21] = "other"
    bench = spark.createDataFrame([*enumerate(items), (8, ""), (9, None), (None, items[0])], "item_id long, text string")
    filler = lambda n: " ".join(r.choice(words) for _ in range(n))
    cases = [(1, f"{filler(50)} {items[0].upper()}, {filler(9)}", [0]), (2, f"{filler(5)}\n{' '.join(swapped)}", [2]), (3, filler(300), []), (4, f"{items[1]} {filler(20)} {items[3]}", [1, 3]), (5, f"x {items[4]} y", [4]), (6, " ".join(items[0].split()[:9]), []), (7, None, []), (7, items[0], [0]), (None, items[1], [1])]
    got = decontaminate.decontaminate(spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string"), bench)
    assert pairs(got, "doc_id", "item_ids") == sorted(((a, c) for a, _, c in cases), key=str)
    assert decontaminate.decontaminate(docs, bench).where("contaminated").count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("kept").count() == docs.count()
    assert decontaminate.decontaminate(none, bench).count() == 0


def test_excerpts_of_long_items_are_leaks(spark):
    r = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    item, long = ([r.choice(words) for _ in range(n)] for n in (59, 2000))
    bench = spark.createDataFrame([(0, " ".join(item)), (1, " ".join(long))], "item_id long, text string")
    filler = lambda: " ".join(r.choice(words) for _ in range(60))
    swapped = long[700:713]
    swapped[4] = swapped[8] = "other"
    cases = [(1, item[7:36], [0]), (2, long[100:1000], [1]), (3, long[50:63], [1]), (4, swapped, [1]), (5, item[20:29], []), (6, [], [])]
    got = decontaminate.decontaminate(spark.createDataFrame([(i, f"{filler()} {' '.join(w)} {filler()}") for i, w, _ in cases], "doc_id long, text string"), bench)
    assert pairs(got, "doc_id", "item_ids") == [(i, x) for i, _, x in cases]


def test_masks_hit_whatever_is_half_equal():
    masks = [[i for i, c in enumerate(m) if c == "1"] for m in decontaminate.MASKS]
    hit = lambda x: any(all(x[i + p] for p in m) for m in masks for i in range(len(x) - m[-1]))
    for n in range(3, 17):  # every pattern of equal (1) and replaced (0) tokens; a longer row that is half equal has a half of such lengths that is
        for bits in range(1 << n):
            if bits.bit_count() >= max(3, n / 2):
                assert hit([bits >> i & 1 for i in range(n)]), (n, bits)


def test_substituted_items_are_found(spark):
    r = random.Random(6)
    words = [f"w{i}" for i in range(3000)]
    items, cases = [], []
    for n in (4, 5, 6, 8, 9, 10, 15, 17, 27, 59):
        for k in (n // 4, n // 2, -4, -3, -2):
            w = [r.choice(words) for _ in range(n)]
            items.append(" ".join(w))
            gone = r.sample(range(n), k) if k >= 0 else range(-k - 1, n, -k)
            if n - len(gone) >= 3:
                cases.append((len(items) - 1, " ".join("other" if i in gone else x for i, x in enumerate(w))))
    filler = lambda: " ".join(r.choice(words) for _ in range(40))
    docs = spark.createDataFrame([(i, f"{filler()} {t} {filler()}") for i, t in cases], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    assert [(d, i) for d, i in pairs(decontaminate.decontaminate(docs, bench), "doc_id", "item_ids") if d not in i] == []


def test_language(spark, docs, none):
    out = language_id.language_id(docs)
    assert out.count() == docs.count()
    for r in out.collect():
        assert 0 <= r["score"] <= 1 and (r["lang_pred"] in ("en", "de", "und"))
    by = {r["doc_id"]: r for r in out.collect() if r["doc_id"] is not None}
    assert by[67]["lang_pred"] == by[68]["lang_pred"] == "und"
    assert language_id.language_id(none).count() == 0


def test_context_trees_are_distributions():
    trees = language_id.fit({"a": ["abab abba " * 30, "xyz abx"], "b": ["zzz yyy ababz " * 20]})
    for context in (b"   ", b"aba", b"zzz", b"qqq", b" ab", b"yyy", b"xyz", b"\xff\x00a"):  # seen by both, by one, by none
        codes = np.array([int.from_bytes(context + bytes([b]), "big") for b in range(256)])
        assert np.allclose(np.exp2(-trees.lengths(codes)).sum(0), 1, atol=1e-9)
    raw = np.frombuffer(b"abab abbazzz yyy ababz", np.uint8)
    bits = language_id.code_lengths(trees, raw, np.array([0, 9, 9, len(raw)]))
    assert bits[0, 0] < bits[0, 1] and bits[2, 1] < bits[2, 0] and not bits[1].any()


def brute_bits(samples, text, order=3, least=4):
    """Code length by method C with exclusion, byte by byte from counted contexts."""
    seen = collections.defaultdict(collections.Counter)
    pad = lambda t: b" " * order + t.lower().encode()
    for t in map(pad, samples):
        for i in range(order, len(t)):
            for m in range(order + 1):
                seen[t[i - m : i]][t[i]] += 1

    def chance(context):
        lower = dict.fromkeys(range(256), 1 / 256) if not context and not isinstance(context, bytes) else chance(context[1:] if context else None)
        own = seen.get(context) if context is not None else None
        if not own or len(context) == order and sum(own.values()) < least:
            return lower
        n, k = sum(own.values()), len(own)
        rest = sum(p for b, p in lower.items() if b not in own)
        return {b: own[b] / (n + k) if b in own else k / (n + k) * p / rest for b, p in lower.items()}

    t = pad(text)
    return -sum(math.log2(chance(t[i - order : i])[t[i]]) for i in range(order, len(t)))


def test_code_lengths_against_brute_force():
    samples = {"a": ["the cat sat on the mat and the hat"] * 3 + ["then this"], "b": ["le chat est sur la table, là où il était"] * 4}
    trees = language_id.fit(samples)
    for text in ("the chat on the tab", "été", "x", "this là"):
        raw = np.frombuffer(text.encode(), np.uint8)
        got = language_id.code_lengths(trees, raw, np.array([0, len(raw)]))[0]
        assert np.allclose(got, [brute_bits(samples[k], text) for k in "ab"], atol=1e-3)


def test_seventy_languages(spark):
    r = random.Random(4)
    words = {f"l{k:02d}": ["".join(r.choice("abcdefghijklmnopqrstuvwxyzäöüéèñ") for _ in range(r.randint(3, 9))) for _ in range(30)] for k in range(70)}
    rows = [(i, " ".join(r.choice(w) for _ in range(40)), k) for i, (k, w) in enumerate((k, w) for k, w in words.items() for _ in range(8))]
    out = language_id.language_id(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    want = {i: k for i, _, k in rows}
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in out.collect()) >= 0.98 * len(rows)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the driver's tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = language_id.language_id(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert out.where("lang = lang_pred").count() >= 0.95 * out.count() > 0


def test_quality_classifier(docs, labels, none):
    out = quality_classifier.quality_classifier(docs, labels)
    assert out.count() == docs.count() and all(0 <= r["quality_score"] <= 1 for r in out.collect())
    assert quality_classifier.quality_classifier(docs, labels.limit(0)).where("kept").count() == docs.count()
    assert quality_classifier.quality_classifier(none, labels).count() == 0
    assert [r[0] for r in docs.sparkSession.createDataFrame([("HTTPS://u@H.ex/a/b/c",), ("src1",), (None,)], "s string").select(F.concat_ws("|", quality_classifier.host_of(F.col("s")), quality_classifier.path_of(F.col("s")))).collect()] == ["h.ex|a", "src1|", "|"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the driver's tables")
def test_quality_on_labels(spark):
    at = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{at}/labels.parquet")
    out = quality_classifier.quality_classifier(spark.read.parquet(f"{at}/documents.parquet"), labels).join(labels, "doc_id")
    assert out.where("kept <> (quality = 1)").count() <= 0.02 * out.count()


def test_sentencepieces(docs, rows, none):
    path = tokenizer_file("piece_bpe_32k.model")
    out = sentencepieces.encode(docs, path)
    got = out.collect()
    assert all(r["round_trip"] for r in got)
    back = sentencepieces.decode(out, path).where("rank = 0")
    assert pairs(back, "doc_id", "text") == sorted(((r[0], r[1] or "") for r in rows), key=str)
    by = collections.defaultdict(list)
    for r in got:
        by[r["doc_id"], r["rank"]].append(r)
    for (doc, rank), all_ in by.items():
        assert len({tuple(r["ids"]) for r in all_}) == len(all_) or doc == 1  # the repeated row is equal
        if rank:
            assert by[doc, 0][0]["perturbed"] >= all_[0]["perturbed"] and all_[0]["ids"] != by[doc, 0][0]["ids"]
    assert sentencepieces.encode(none, path).count() == 0


def test_sampling_without_replacement():
    lattice = sentencepieces.Lattice(tokenizer_file("piece_bpe_32k.model"))
    lattice.pieces = {k: (v[0], 0.3) for k, v in lattice.pieces.items()}
    lattice.weigh()
    units = sentencepieces.unit_states(lattice, "th an")
    chance, first, second, n = {}, collections.Counter(), collections.Counter(), 4000
    for i in range(n):
        found, kappa = sentencepieces.sample_paths(lattice, units, (i + 1) * 0x9E3779B97F4A7C15, 3)
        ids = [tuple(f[0].tolist()) for f in found]
        assert len(set(ids)) == 3 and found[0][2] >= found[1][2] >= found[2][2] >= kappa
        first[ids[0]] += 1
        second[ids[1]] += 1
        chance |= {k: math.exp(f[1]) for k, f in zip(ids, found, strict=True)}
    assert abs(sum(chance.values()) - 1) < 1e-6
    for k, p in chance.items():
        two = sum(q * p / (1 - q) for j, q in chance.items() if j != k)
        assert abs(first[k] / n - p) < 0.03 and abs(second[k] / n - two) < 0.03


def lattice_edges(lattice, text):
    """Edges of a text's lattice as the automaton has them, and as all occurrences of pieces."""
    units, at, got = sentencepieces.unit_states(lattice, text), 0, set()
    _, piece, to, begin = lattice.tables()
    chars = lattice.arrays[7]
    for unit in units.tolist():
        todo, seen = [unit], set()
        while todo:
            state = todo.pop()
            if state and state not in seen:
                seen.add(state)
                i = at + int(chars[unit] - chars[state])
                for e in range(begin[state], begin[state + 1]):
                    got.add((i, i + int(chars[state] - chars[to[e]]), int(piece[e])))
                    todo.append(int(to[e]))
        at += int(chars[unit])
    whole = sentencepieces.SPACE + text.replace(" ", sentencepieces.SPACE)
    assert at == len(whole)
    want = {(i, j, lattice.pieces[whole[i:j]][0]) for i in range(at) for j in range(i + 1, min(at, i + lattice.longest) + 1) if whole[i:j] in lattice.pieces}
    return got, want | {(i, i + 1, lattice._bytes(c, c.encode())) for i, c in enumerate(whole) if c not in lattice.pieces}


LONG = ["mail bob_und.34@mail7.example.com now", "https://www.example.com/a/very/long/path/withmanywords/index.html?query=thequickbrownfox", "x" * 40 + "incomprehensibilities" * 4 + "\n" + "donaudampfschifffahrtsgesellschaftskapitän", "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。何でも薄暗いじめじめした所で", "\U0001f600\u0e01" * 30 + " ab"]


def test_no_edge_of_a_long_word_is_lost():
    lattice = sentencepieces.Lattice(tokenizer_file("piece_bpe_32k.model"))
    for text in LONG:
        got, want = lattice_edges(lattice, text)
        assert got == want


INDENTED = ["def f(x):\n    if x:\n        return  x\n", "    four", "  ", "a  b   c", "trailing    ", "name" + " " * 30 + "value" + " " * 15 + "|", "a▁b ▁ c▁", " "]


def test_runs_of_spaces_are_pieces(spark):
    path = tokenizer_file("piece_bpe_32k.model")
    lattice = sentencepieces.Lattice(path)
    for text in INDENTED:
        got, want = lattice_edges(lattice, text)
        assert got == want
    runs = {v[0] for k, v in lattice.pieces.items() if len(k) > 1 and set(k) == {sentencepieces.SPACE}}
    out = sentencepieces.encode(spark.createDataFrame([(i, INDENTED[i % 6]) for i in range(60)], "doc_id long, text string"), path).collect()
    assert len(runs) == 14 and all(r["round_trip"] for r in out) and all(runs & set(r["ids"]) for r in out if r["rank"] == 0 and r["doc_id"] % 6 in (2, 5))


def test_probabilities_of_long_words():
    lattice = sentencepieces.Lattice(tokenizer_file("piece_bpe_32k.model"))
    for text in (*LONG, "thequickbrownfox" * 50):
        whole = sentencepieces.SPACE + text.replace(" ", sentencepieces.SPACE)
        mass, paths = [0.0] * (len(whole) + 1), [1] * (len(whole) + 1)
        log = {v[0]: math.log(v[1]) for v in lattice.pieces.values()} | {lattice._bytes(c, c.encode()): lattice.floor * len(c.encode()) for c in whole if c not in lattice.pieces}
        edges = collections.defaultdict(list)
        for i, j, x in lattice_edges(lattice, text)[1]:
            edges[i].append((j, log[x]))
        for i in range(len(whole) - 1, -1, -1):
            mass[i] = np.logaddexp.reduce([w + mass[j] for j, w in edges[i]])
            paths[i] = sum(paths[j] for j, _ in edges[i])
        found, kappa = sentencepieces.sample_paths(lattice, sentencepieces.unit_states(lattice, text), 99, 3)
        assert len({tuple(f[0].tolist()) for f in found}) == len(found) == min(3, paths[0])
        assert [f[2] for f in found] == sorted((f[2] for f in found), reverse=True) and found[-1][2] >= kappa
        for ids, log_p, _ in found:
            assert math.isclose(log_p, sum(log[x] for x in ids.tolist()) - mass[0], abs_tol=1e-6)


def test_license_scan(spark, docs, none):
    mit = " ".join(license_scan.SENTENCES[k][0] for k in ("mit-grant", "mit-notice", "mit-warranty", "mit-liability"))
    cases = [(1, f"Some text.\n{mit}\nMore.", ["MIT"]), (2, "Intro\nLicensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]), (3, "This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]), (4, "Released under the MIT License. Licensed under the Apache License, Version 2.0.\nAll rights reserved.", ["MIT", "Apache-2.0"]), (5, "my driving license", []), (6, None, [])]
    got = license_scan.license_scan(spark.createDataFrame([c[:2] for c in cases], "doc_id long, text string"))
    assert pairs(got, "doc_id", "licenses") == [(a, c) for a, _, c in cases]
    assert got.where("doc_id = 4").first()["unmatched"] == ["rights"]
    assert all(any(a in s.lower() for a in license_scan.ANCHORS) for all_ in [*license_scan.SENTENCES.values(), *license_scan.families()[0].values()] for s in all_)
    assert license_scan.license_scan(docs).count() == docs.count() and license_scan.license_scan(none).count() == 0


def test_html(spark):
    article = "<article><h1>A &amp; title</h1><p>First   para\nwith words, enough of them to read.<p>Second one, &eacute;t&eacute;, which goes on for some more words.</article>"
    page = f"<html><head><title>t</title><style>p{{}}</style><script>var x='</p>';</script></head><body><nav><ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li></ul></nav><div class=\"ad\">Buy this thing now.</div>{article}<section id=comments><h2>Comments</h2><div class=comment><p>I disagree with all of this, sorry.</p></div></section><footer>&copy; site</footer></body></html>"
    want = "A & title\n\nFirst para with words, enough of them to read.\n\nSecond one, été, which goes on for some more words."
    rows = [(1, "u", page), (2, None, None), (3, "u", ""), (4, "u", page[:400]), (5, "u", "<" * 2000 + "<a href='x"), (1, "u", page)]
    out = html_extract.html_extract(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = pairs(out, "page_id", "text", "n_chars")
    assert got[0] == got[1] == (1, want, len(want)) and got[2] == (2, "", 0) and got[3] == (3, "", 0) and len(got) == 6
    model = html_extract.model()
    wrong = total = 0
    for source, good in html_extract.training(60, seed=99):
        there = good & set(re.findall(r"q\d+", source))
        found = set(re.findall(r"q\d+", html_extract.extract_texts([source], model)[0]))
        wrong, total = wrong + len(there ^ found), total + len(there)
    assert wrong < 0.02 * total


def test_decoding_never_contradicts():
    page = html_extract.Page("<div><p>a</p><div><p>b</p></div></div><p>c")
    keep = page.decode(np.array([0.0, -1.0, 0.4, -0.2, 0.3, -5.0]))
    assert all(keep[page.parent[i]] for i in range(1, len(keep)) if keep[i])


def test_pipeline(spark, docs, labels, tmp_path):
    import corpus_pipeline

    bench = spark.createDataFrame([(1, texts()[50])], "item_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    now = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, now, str(tmp_path))
        assert new.columns == docs.columns and new.dtypes == docs.dtypes
        assert new.count() <= now.count()
        now = new
    assert corpus_pipeline.run(spark, str(tmp_path)).where("not round_trip").count() == 0


def test_registered():
    assert {int(k[2:].split("_")[0]) for k in QUERIES} == set(range(1, 14))
