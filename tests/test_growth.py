"""Steps whose work must grow with the input alone: what is parsed once, carried once, or handed on in small pieces."""

import json
import random
import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from ledgerflow import registry
from ledgerflow.functions.scalars import SPACE, strip
from ledgerflow.operators import columns, geometry, grid
from ledgerflow.sources import asia, disclosures, landing, sinks, statutes

LANDED = "symbol string, fiscal_year int, reprt_code string, fs_scope string, payload string"


def test_statements_of_every_year(spark):
    found = registry.queries()["korean_statements"](spark, "/root/testdata/sf0.001").groupBy("fiscal_year").count().collect()
    assert {r["fiscal_year"] for r in found} == {2022, 2023} and len({r["count"] for r in found}) == 1


def test_a_payload_that_answers_several_requests(spark):
    items = [{"account_nm": f"a{i}", "sj_div": "cis", "thstrm_amount": "-" if i == 1 else "-1,000", "thstrm_dt": "2023.01.01 ~ 2023.12.31"} for i in range(3)]
    texts = [json.dumps(items), json.dumps([1, None, items[0], {}]), "{}", "[", None]
    each = spark.createDataFrame([("A", 2023, c, s, t) for t in texts for c in asia.REPORTS for s in asia.SCOPES], LANDED)
    asked = each.groupBy("symbol", "fiscal_year", "payload").agg(F.collect_list(F.struct("reprt_code", "fs_scope")).alias("requests"))
    rows = lambda df: sorted(map(str, asia.statement_rows(df).collect()))
    assert rows(each) == rows(asked) and len(rows(each)) == 8 * 4
    plan = asia.statement_rows(asked)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(ArrayType(StructType") == 1


def test_fields_of_lists(spark):
    df = spark.createDataFrame([(1, '[{"a":"x","b":{"c":[1]}},{"a":2}]'), (2, '[{"a":"y"},null,"z",[{"a":"n"}]]'), (3, '{"a":"w"}'), (4, "[]"), (5, "no")], "k int, payload string")
    got = landing.listed_fields(df, ["k"], ["a", "b"]).select("k", "r.a", "r.b")
    want = landing.records(df, ["k"], ["a", "b"]).select("k", "a", "b")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 3


def test_stripping_is_that_of_the_pattern(spark):
    chars = [*(chr(c) for c in range(0x3100) if not 0xD800 <= c < 0xE000), "\ufeff", "\u200b", "가"]
    texts = [a + b for c in chars for a, b in ((c, "x"), ("x", c), (c + "x" + c, "y " + c), (c, c))]
    df = spark.createDataFrame([(t,) for t in [*texts, "", None]], "t string")
    assert df.where(~strip(F.col("t")).eqNullSafe(F.regexp_replace("t", rf"^{SPACE}+|{SPACE}+$", ""))).count() == 0


def test_what_a_report_says_of_itself_is_read_once(spark):
    lines = [f"Item {i}\x01\u3000x 12(a)  1,{i:03d} ({i})" for i in range(4)]
    text = "Balance sheet\n2023 and 2022 in HK$ million\n" + "\n".join([*lines, "Item 5", "12 1 2", "Annual Report 1 2"])
    facts = asia.annual_report_facts(spark.createDataFrame([("A", 3, text)], "symbol string, page_no int, text string"))
    assert sorted((r["account"], r["fiscal_year"], r["value"], r["currency"]) for r in facts.collect()) == sorted((f"Item {i}\x01\u3000x", y, v * 1e6, "HKD") for i in range(4) for y, v in ((2023, 1000.0 + i), (2022, -float(i))))
    plan = facts._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate posexplode")]
    assert "RMB" not in above and "20\\d{2}" not in above


def test_items_leave_in_slices(spark):
    n = 2 * statutes.SLICE + 7
    laws = [{"법령ID": str(i), "법령일련번호": f"M{i}"} for i in range(n)]
    texts = [json.dumps({"LawSearch": {"law": laws, "x": 1}}), "no", None, json.dumps({"LawSearch": {"law": laws[0], "x": 1}}), json.dumps({"LawSearch": {"law": []}})]
    df = spark.createDataFrame([(f"q{i}", t) for i, t in enumerate(texts)], "query string, payload string").coalesce(1)
    got = statutes.unfolded(df, ["query"], "items")
    assert sorted((r["query"], r["ord"], json.loads(r["x"])["법령ID"]) for r in got.collect()) == sorted([("q0", i, str(i)) for i in range(n)] + [("q3", 0, "0")])
    assert statutes.statutes(df, ["query"]).count() == n + 1 and statutes.raw_items(df, ["query"]).count() == n


def test_a_page_of_a_search_is_small(spark):
    plan = registry.queries()["statute_search"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().analyzed().toString()
    assert "MapInArrow" in plan and "page_of" in plan


def test_reading_order_gets_edges_alone(spark):
    line = "text string, x0 double, x1 double, top double, bottom double"
    two = [(f"{s}{r}", x, x + 200.0, 20.0 * r, 20.0 * r + 9) for r in range(4) for s, x in (("l", 0.0), ("r", 300.0))]
    pages = [(1, two), (2, []), (3, None), (4, [(None, 0.0, 1.0, 5.0, 6.0), ("", None, None, None, None)]), (5, [("b", 0.0, 9.0, 9.0, 9.0), ("a", 0.0, 9.0, 1.0, 9.0)])]
    df = spark.createDataFrame(pages, f"page int, lines array<struct<{line.replace(' ', ':')}>>".replace(",:", ", ")).coalesce(1)
    got = df.select("page", geometry.reading_order("lines").alias("o"))
    assert {r["page"]: r["o"] for r in got.collect()} == {1: [0, 2, 4, 6, 1, 3, 5, 7], 2: [], 3: [], 4: [0, 1], 5: [1, 0]}
    assert {r["page"]: r["o"] for r in got.where("page > 3").collect()} == {4: [0, 1], 5: [1, 0]}
    assert "ArrowEvalPython [_orders(transform(" in got._jdf.queryExecution().optimizedPlan().toString() and "bottom" not in got._jdf.queryExecution().optimizedPlan().toString().split("ArrowEvalPython")[1].splitlines()[0]


def test_words_are_dealt_into_rows_once(spark):
    word = "doc_id int, page_no int, ord int, text string, x0 double, x1 double, top double, bottom double"
    rows = [(1, 1, 20 * r + i, "words", 50.0 + 30 * i + (100 if i > 4 else 0), 78.0 + 30 * i + (100 if i > 4 else 0), 20.0 * r, 20.0 * r + 9) for r in range(5) for i in range(10)]
    plan = columns.column_lines(spark.createDataFrame(rows, word), ["doc_id", "page_no"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" not in text and "median(" not in text
    assert [len(r["lines"]) for r in plan.collect()] == [10]


def test_words_of_a_page_meet_no_join(spark):
    word = "doc_id int, page_no int, ord int, text string, x0 double, x1 double, top double, bottom double"
    two = [(20 * r + i, "words", 50.0 + 30 * i + (100 if i > 4 else 0), 78.0 + 30 * i + (100 if i > 4 else 0), 20.0 * r, 20.0 * r + 9) for r in range(9) if r != 4 for i in range(10)]
    across = [(80 + i, "across", 120.0 + 60 * i, 178.0 + 60 * i, 80.0, 89.0) for i in range(4)]
    plan = columns.column_lines(spark.createDataFrame([(d, 1, *w) for d in (1, None) for w in two + across], word), ["doc_id", "page_no"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and text.count("Exchange") == 1  # the planner takes words for few, by their bytes as Parquet
    got = {r["doc_id"]: [(x["x0"], x["top"]) for x in r["lines"]] for r in plan.collect()}
    side = lambda x, rows: [(x, 20.0 * r) for r in rows]
    assert got[1] == got[None] == side(50.0, range(4)) + side(300.0, range(4)) + [(120.0, 80.0)] + side(50.0, range(5, 9)) + side(300.0, range(5, 9))


def test_a_form_is_parsed_for_the_tags_it_has(spark):
    docs = ["<d><rptOwnerName>A &amp; B</rptOwnerName><officerTitle> CEO </officerTitle></d>", "<d><x><rptOwnerName>\n</rptOwnerName></x><isDirector><value>true</value></isDirector></d>", "<d><isDirector>0</isDirector><isOfficer>1</isOfficer></d>", "<d><officerTitle/></d>", "not a form"]
    forms = spark.createDataFrame([("S", "2024-01-02", "4", str(i), i, f"u{i}") for i in range(len(docs))], "symbol string, filed_date string, filing_type string, filing_id string, ord int, xml_url string")
    got = disclosures.insider_trades(forms, spark.createDataFrame([(f"u{i}", d) for i, d in enumerate(docs)], "url string, content string"))
    assert {r["filing_id"]: (r["insider"], r["relation"]) for r in got.collect()} == {"0": ("A & B", "CEO"), "1": ("unknown", "director"), "2": ("unknown", "officer"), "3": ("unknown", None), "4": ("unknown", None)}


def test_one_document_is_open_at_a_time(tmp_path):
    n, size = 40, 1 << 20
    batch = pa.RecordBatch.from_pylist([{"market": "US", "symbol": "A", "filing_id": "f", "name": f"{i}.txt", "content": bytes([i]) * size, "_ord": i, "_digest": str(i)} for i in range(n)])
    for want in ("written", "kept"):
        tracemalloc.start()
        (out,) = sinks._move_batches(iter([batch]), str(tmp_path))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert out.column("status").to_pylist() == [want] * n and out.column("size").to_pylist() == [size] * n
        assert peak < 6 * size


WORDS = "doc_id int, page_no int, ord int, text string, x0 double, x1 double, top double, bottom double"
GRIDS = "doc_id int, page_no int, table_no int, box array<double>, rows array<array<double>>, cols array<array<double>>, scale double"


def test_words_and_grids_are_shuffled_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (grid.filled_grids(spark.createDataFrame([], WORDS), spark.createDataFrame([], GRIDS)), registry.queries()["filled_grids"](spark, "/root/testdata/sf0.001")):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 2 and plan.count("SortMergeJoin") == 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_words_find_all_rows_that_hold_them(spark):
    rng = random.Random(5)
    words, tables, want = [], [], {}
    for page in range(40):
        ws = [(page, 1, i, rng.choice(["a", "b c", " ", "", None]), x - 1.0, x + 1.0, y - 2.0, y + 2.0) for i in range(60) for x, y in [(rng.uniform(-20, 320), rng.choice([rng.uniform(-60, 400), 10.0 * rng.randrange(40)]))]]
        ws += [(page, 1, 60, "far", 0.0, 2.0, 1e300, float("inf")), (page, 1, 61, "none", 0.0, 2.0, None, 1.0)]
        words += ws
        for no in range(rng.randrange(4)):
            # rows that meet, lie in one another, repeat, are upside down or far off, in no order
            edges = [(y, y + rng.choice([0.0, 10.0, 25.0, 300.0, -5.0])) for y in (rng.choice([10.0 * rng.randrange(-5, 40), 1e5]) for _ in range(rng.randrange(30)))]
            rows, cols = [[0.0, 2 * a, 9.0, 2 * b] for a, b in edges] + [None], [[20.0 * c, 0.0, 20.0 * c + 15, 9.0] for c in rng.sample(range(30), rng.randrange(6))]
            tables.append((page, 1, no, [10.0, 6.0, 500.0, 500.0], rows, cols, 2.0))
            filled = []
            for a, b in edges if cols else []:
                cells = [[] for _ in cols]
                for _, _, _, text, x0, x1, top, bottom in ws:
                    if top is not None and a + 3 <= (top + bottom) / 2 <= b + 3:
                        far = [max((10 + c[0]) / 2 - (x0 + x1) / 2, (x0 + x1) / 2 - (10 + c[2]) / 2, 0.0) for c in cols]
                        cells[far.index(min(far))] += [text] if text is not None else []
                filled += [[" ".join(c) for c in cells]] if any(" ".join(c).strip() for c in cells) else []
            want |= {(page, no, i): r for i, r in enumerate(filled)}
    tables.append((0, 1, 9, [0.0] * 4, None, [[0.0] * 4], 1.0))
    w, t = spark.createDataFrame(words, WORDS), spark.createDataFrame(tables, GRIDS)
    for band in (3.0, grid.BAND, 1e4):
        assert {(r["doc_id"], r["table_no"], r["row_idx"]): r["cells"] for r in grid.filled_grids(w, t, band).collect()} == want
    assert len(want) > 100
