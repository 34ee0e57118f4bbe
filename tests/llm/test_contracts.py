"""Probes of the operators' contracts: gold texts, SQL, plans, wrapped notices, scripts, shared folder, empty tables."""

import collections
import html
import math
import os
import random
import re
import textwrap
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import html_extract, license_scan, line_dedup, near_join, quality_classifier, sentencepieces, shared, token_counts
from ledgerflow.llm.queries import QUERIES, SQL, tokenizer_file

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


@needs_tables
@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "clicks"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, sql = QUERIES[name](spark, SF), con.sql(SQL[name])
    assert sorted(df.columns) == sorted(sql.columns)
    at = [sql.columns.index(c) for c in sorted(sql.columns)]
    assert sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect()) == sorted(tuple(plain(r[i]) for i in at) for r in sql.fetchall())


# -- pages ---------------------------------------------------------------------------

PROSE = "This is a fairly long paragraph of article prose, with commas, stops. And it goes on for quite some more words to look real."
INSIDE = [
    ('<p>See <a href="/hidden-falls">Falls link</a> for more.</p>', "See Falls link for more."),
    ('<p title="hidden gems">Some gems are in this paragraph.</p>', "Some gems are in this paragraph."),
    ('<p data-id="ad">A paragraph whose data name looks bad.</p>', "A paragraph whose data name looks bad."),
    ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn></math> be so.</p>", "Let x=2 be so."),
    ("<p>A drawing <svg><text>label</text></svg> is shown.</p>", "A drawing label is shown."),
    ("<p>Raw <xmp><b>bold</b></xmp> stays.</p>", "Raw <b>bold</b> stays."),
    ("<p>" + "1234567890 " * 40 + "</p>", ("1234567890 " * 40).strip()),
]


@pytest.mark.parametrize("inside, want", INSIDE)
def test_article_parts_stay(inside, want):
    page = f"<html><head><title>t</title></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><article><h1>A title</h1><p>{PROSE}</p>{inside}<p>{PROSE}</p></article><footer>Copyright me</footer></body></html>"
    assert html_extract.extract_texts([page], html_extract.model()) == ["\n\n".join(["A title", PROSE, want, PROSE])]


def gold(page):
    """The text between the article's tags, whose blocks these pages mark by h1 and p alone."""
    blocks = re.split(r"</?(?:h1|p)\b[^>]*>", re.search(r"<article>(.*?)</article>", page, re.S)[1])
    texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in blocks]
    return "\n\n".join(t for t in texts if t)


@needs_tables
def test_gold_texts_of_real_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    assert len(sources) > 10
    for r in QUERIES["op1_html_extraction"](spark, SF).collect():
        assert r["text"] == gold(sources[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_deep_pages_are_linear():
    took = []
    for n in (4000, 32000):
        began = time.perf_counter()
        html_extract.Page("<div>" * n + "x" + "</div>" * n)
        html_extract.Page("<b><center>" * n + "x")
        took.append(time.perf_counter() - began)
    assert took[1] < 40 * took[0]


def test_empty_and_clashing_pages(spark):
    rows = spark.createDataFrame([(1, "u", "<p>" + "word " * 50000, "x", 3)], "page_id long, url string, html string, text string, n_chars int")
    assert html_extract.html_extract(rows).first()["n_chars"] in (0, 50000 * 5 - 1)
    assert html_extract.html_extract(rows.limit(0)).count() == 0


# -- licences ---------------------------------------------------------------------------


def test_each_known_sentence_is_itself():
    words = license_scan.built_in()
    for key, all_ in {**license_scan.SENTENCES, **license_scan.families()[0]}.items():
        for s in all_:
            assert license_scan.identify(s) == [words.known[license_scan.normal(s)]], s
            assert words.known[license_scan.normal(s)] == key or sum(license_scan.normal(s) in map(license_scan.normal, x) for x in {**license_scan.SENTENCES, **license_scan.families()[0]}.values()) > 1


WHOLE = {"MIT": ["mit-grant", "mit-notice", "mit-warranty", "mit-liability"], "BSD-3-Clause": ["bsd-grant", "bsd-source", "bsd-binary", "bsd-endorse", "bsd-warranty", "bsd-liability"], "GPL-3.0-or-later": ["gpl3-grant", "gpl-warranty", "gpl-details", "gpl-copy"], "Apache-2.0": ["apache-grant", "apache-may", "apache-copy", "apache-warranty"]}


@pytest.mark.parametrize("name", WHOLE)
@pytest.mark.parametrize("mark", ["", " * ", "# ", "// ", ";; ", "> "])
def test_wrapped_and_commented_notices(name, mark):
    whole = " ".join(license_scan.SENTENCES[k][0] for k in WHOLE[name])
    for width in (50, 76, 80):
        text = "Some title\n\n" + "\n".join(mark + x for x in textwrap.wrap(whole, width)) + "\n\nMore text."
        assert [x[0] for x in license_scan.scan(text)[0]] == [name]


def test_matches_against_brute_force():
    r = random.Random(2)
    sentences = {k: [f"licen {k} {w}." for w in ("one", "one two")] for k in "abcd"}
    rules = [("X", ["a", "b", "c"]), ("Y", ["a", "b"]), ("Z", ["b"]), ("W", ["d", "d"])]
    words = license_scan.Dictionary(sentences, rules)

    def brute(ids):
        found, used = [], set()
        for i in range(len(ids)):
            if i in used or ids[i] is None:
                continue
            for name, wanted in rules:
                at, ok = [], True
                for w in wanted:
                    lo = at[-1] + 1 if at else i
                    near = [j for j in range(lo, min(len(ids), lo + (license_scan.GAP if at else 0) + 1)) if ids[j] == w and j not in used and all(ids[x] is None for x in range(lo, j))]
                    if not near:
                        ok = False
                        break
                    at.append(near[0])
                if ok:
                    used.update(at)
                    found.append((name, at[0], at[-1]))
                    break
        return found

    for _ in range(400):
        parts = [r.choice([*sum(sentences.values(), []), "Unknown text here."]) for _ in range(r.randint(1, 9))]
        want = [next((k for k, v in sentences.items() if p in v), None) for p in parts]
        assert license_scan.identify("\n\n".join(parts), words) == want
        assert license_scan.match(want, words)[0] == brute(want)


# -- lines, tokens, pieces --------------------------------------------------------------


def test_line_plan_sorts_within_ranges(spark):
    docs = spark.createDataFrame([(i, "\n".join(["a line that is long enough to be counted by everyone"] * 3)) for i in range(8)], "doc_id long, text string")
    once = line_dedup.first_occurrences(line_dedup.line_hashes(docs, 40))
    plan = once._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan and "hashpartitioning" not in plan and "position" in plan.split("Sort [")[1].split("\n")[0] and "WindowGroupLimit" in plan
    assert sorted((r["doc_id"], r["position"]) for r in once.collect()) == [(i, 0) for i in range(8)]


def test_tokens_of_many_scripts(spark):
    from tokenizers import Tokenizer

    r = random.Random(1)
    path = tokenizer_file("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    pool = ["日本語 テキスト", "Привет, мир", "😀👨‍👩‍👧 emoji", "<|endoftext|>", " ", "\n\n", "\x85", "　", "it's", "don’t", "αβγ", "١٢٣", "ⅷ", "á", "​", "<|endof", " x", "123abc", "한국어", "\x1c", "ǆ", "𝔘𝔫𝔦", "  \t ", "'S", "\xa0", "→"]
    texts = ["".join(r.choice(pool) for _ in range(r.randint(1, 12))) for _ in range(600)]
    got = token_counts.token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()
    assert {x["doc_id"]: x["n_tokens"] for x in got} == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in enumerate(texts)}
    count = token_counts.Counter(path, token_counts.frequent_lengths(path))
    count.tokenizer = None  # what both tiers know needs no library, whatever the script
    assert count.lengths["мир"] == len(t.encode("мир").ids)


def test_inclusion_scores_are_exact():
    """Weighted by their inclusion scores the drawn shares sum to 1 on average, and a path's own share to its chance."""
    lattice = sentencepieces.Lattice(tokenizer_file("piece_bpe_32k.model"))
    lattice.pieces = {k: (v[0], 0.3) for k, v in lattice.pieces.items()}
    lattice.weigh()
    units = sentencepieces.unit_states(lattice, "th an")
    n, sums, own, chance = 4000, 0.0, collections.Counter(), {}
    for i in range(n):
        found, kappa = sentencepieces.sample_paths(lattice, units, (i + 7) * 0x9E3779B97F4A7C15, 2)
        for ids, log_p, _ in found:
            share = math.exp(log_p) / -math.expm1(-math.exp(log_p - kappa))
            sums += share
            own[tuple(ids.tolist())] += share
            chance[tuple(ids.tolist())] = math.exp(log_p)
    assert abs(sums / n - 1) < 0.03
    assert all(abs(own[k] / n - p) < 0.03 for k, p in chance.items())


def test_rows_do_not_depend_on_their_neighbours(spark):
    path = tokenizer_file("piece_bpe_32k.model")
    r = random.Random(9)
    rows = [(i, " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 300)))) for i in range(40)]
    both = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda df: sorted((x["doc_id"], x["rank"], tuple(x["ids"]), x["log_p"], x["perturbed"], x["log_inclusion"]) for x in df.collect())
    assert key(sentencepieces.encode(both.repartition(3), path)) == key(sentencepieces.encode(both.coalesce(1), path))


def test_decode_keeps_the_callers_columns(spark):
    path = tokenizer_file("piece_bpe_32k.model")
    rows = sentencepieces.encode(spark.createDataFrame([(1, "a text")], "doc_id long, text string"), path).withColumn("text", F.lit("own"))
    with pytest.raises(ValueError):
        sentencepieces.decode(rows, path)
    assert {(r["text"], r["spelled"]) for r in sentencepieces.decode(rows, path, out="spelled").collect()} == {("own", "a text")}


# -- joins, sites, folders --------------------------------------------------------------


def test_sketches_never_differ_more_than_sets():
    r = np.random.default_rng(3)
    for _ in range(200):
        a = r.integers(0, 1 << 63, int(r.integers(1, 400)), np.uint64)
        b = np.unique(np.concatenate([a[r.random(len(a)) < 0.8], r.integers(0, 1 << 63, int(r.integers(0, 60)), np.uint64)]))
        a = np.unique(a)
        bits = [np.bincount((shared.mixed(x) >> np.uint64(1)).astype(np.int64) % 512, minlength=512) & 1 for x in (a, b)]
        assert (bits[0] != bits[1]).sum() <= len(np.setxor1d(a, b))


def test_long_lists_of_near_copies(spark):
    """A hot passage in documents of many sizes: bands and sketches lose no link."""
    r = random.Random(6)
    passage = [f"p{i}" for i in range(30)]
    texts = [" ".join(passage + [f"w{r.randrange(60 if i % 2 else 4000)}" for _ in range(r.randint(0, 40))]) for i in range(150)]
    sets = [{tuple(x.split()[j : j + 5]) for j in range(len(x.split()) - 4)} for x in texts]
    root = list(range(150))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(150):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    got = near_join.near_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {x["doc_id"]: x["component_id"] for x in got} == {i: find(i) for i in range(150)}
    assert len({find(i) for i in range(150)}) < 150


def test_posteriors_against_brute_force(spark):
    r = random.Random(12)
    sites = ["https://a.ex/x/1", "https://a.ex/y/2", "b.ex", None, "https://c.ex/z/3"]
    docs = [(i, " ".join(r.choice(["good", "words", "###", "a", "|"]) for _ in range(r.randint(0, 40))), r.choice(sites)) for i in range(300)]
    labels = [(i, int("###" not in (docs[i][1] or "")[:40])) for i in range(0, 300, 3)]
    out = quality_classifier.quality_classifier(spark.createDataFrame(docs, "doc_id long, text string, source string"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    groups = collections.defaultdict(list)
    where = {}
    for x in out:
        m = re.match(r"^(?:\w+://)?([^/]*)(?:/([^/]*)/)?", x["source"] or "")
        where[x["doc_id"]] = (m[1], m[2] or "")
        groups[where[x["doc_id"]]].append(x["p_doc"])
    hosts = collections.defaultdict(list)
    for (h, _), p in groups.items():
        hosts[h] += p
    n = len(out)
    mean = sum(x["p_doc"] for x in out) / n

    def weight(squares, n2, k):
        chance = mean * (1 - mean)
        free = n - n2 - k
        spread = (squares - k * chance) / free if free else None
        return min(max(chance / spread - 1, 1.0), 1e6) if spread is not None and spread > 0 else 1e6

    k2 = sum(sum(p) ** 2 / len(p) for p in hosts.values())
    p2 = sum(sum(p) ** 2 / len(p) for p in groups.values())
    of_host = weight(k2 - n * mean * mean, sum(len(p) ** 2 for p in hosts.values()) / n, len(hosts) - 1)
    of_path = weight(p2 - k2, sum(sum(len(q) ** 2 for (h, _), q in groups.items() if h == g) / len(p) for g, p in hosts.items()), len(groups) - len(hosts))
    odds = lambda p: math.log(max(p, 1e-6) / max(1 - p, 1e-6))
    for x in out:
        h, g = hosts[where[x["doc_id"]][0]], groups[where[x["doc_id"]]]
        host = (sum(h) - x["p_doc"] + of_host * mean) / (len(h) - 1 + of_host)
        site = (sum(g) - x["p_doc"] + of_path * host) / (len(g) - 1 + of_path)
        assert math.isclose(x["p_site"], site, rel_tol=1e-9)
        assert math.isclose(x["quality_score"], 1 / (1 + math.exp(-(odds(x["p_doc"]) + odds(site) - odds(mean)))), rel_tol=1e-9)


@needs_tables
def test_quality_of_labels_not_learned(spark):
    docs, labels = spark.read.parquet(f"{SF}/../sf0.01/documents.parquet"), spark.read.parquet(f"{SF}/../sf0.01/labels.parquet")
    learned = labels.where("doc_id % 2 = 0")
    out = quality_classifier.quality_classifier(docs, learned).join(labels.where("doc_id % 2 = 1"), "doc_id")
    assert out.where("kept <> (quality = 1)").count() <= 0.03 * out.count() and out.count() > 100


def test_shuffled_attach_and_scratch(spark, monkeypatch):
    monkeypatch.setattr(shared, "BROADCAST_BYTES", 0)
    docs = spark.createDataFrame([(i, "\n".join(["a line that is long enough to be counted by everyone", f"own line {i}"])) for i in range(9)], "doc_id long, text string")
    assert "SortMergeJoin" in shared.attach(docs, docs.select("doc_id"), ["doc_id"], "inner", 8)._jdf.queryExecution().executedPlan().toString()
    assert sum(r["n_dropped"] for r in line_dedup.line_dedup(docs).collect()) == 8
    with shared.scratch(spark):
        gone = shared.saved(docs, "gone")
        with shared.kept():
            stays = shared.saved(docs, "stays")
    assert stays.count() == 9
    with pytest.raises(Exception, match="(?i)not.*exist|not_exist|FileNotFound"):
        spark.read.parquet(gone._saved_at).count()


def test_no_shared_folder_on_a_cluster():
    class Session:
        class conf:
            get = staticmethod(lambda *a: None)

        class sparkContext:
            master = "spark://host:7077"
            getConf = staticmethod(lambda: {})

            class _jsc:
                sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False)}))}))

    with pytest.raises(RuntimeError):
        shared.shared_dir(Session)


def test_pipeline_on_empty_tables(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
