import gzip
import io
import struct
import zipfile
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import scalars as S
from ledgerflow.operators import columns, geometry, metrics, signals
from ledgerflow.operators.asof import asof_join
from ledgerflow.operators.upsert import replace_partition, upsert
from ledgerflow.sources import formats


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize("market,raw,want", [("KR", "5930", "005930"), ("KR", "005930.KS", "005930"), ("HK", "700", "00700"), ("HK", "0700.HK", "00700"), ("US", " aapl ", "AAPL"), ("KR", "ABC", "ABC"), ("KR", "1234567", "1234567")])
def test_symbols(spark, market, raw, want):
    assert one(spark, S.normalize_symbol(F.lit(market), F.lit(raw))) == want


@pytest.mark.parametrize("raw,want", [("20240131", "2024-01-31"), ("2024-01-31T00:00", "2024-01-31"), (" 2024-01-31 10:00", "2024-01-31"), ("  ", None), (None, None)])
def test_iso(spark, raw, want):
    assert one(spark, S.to_iso(F.lit(raw).cast("string"))) == want


def test_numbers(spark):
    assert one(spark, S.parse_money(F.lit("$382,500,000"))) == 382500000.0
    assert one(spark, S.parse_signed(F.lit("(1,234)"))) == -1234.0
    assert one(spark, S.parse_scaled(F.lit("1.2"), F.lit("billion"))) == 1.2e9
    assert one(spark, S.compact_number(F.lit(2.5e9))) == "2.50B"
    assert one(spark, S.pad_cik(F.lit("x1"))) == "x1"


def test_upsert_policies(spark):
    old = spark.createDataFrame([("a", 1, "x"), (None, 1, "n")], "k string, v int, w string")
    new = spark.createDataFrame([("a", 2, None, 1), ("b", 3, "y", 2), (None, 1, "n", 3)], "k string, v int, w string, _ord int")
    rows = lambda *a: sorted(map(tuple, upsert(old, new, ["k"], *a).collect()), key=str)
    assert rows("update", {"w": "coalesce_new_old"}) == sorted([("a", 2, "x"), ("b", 3, "y"), (None, 1, "n"), (None, 1, "n")], key=str)
    assert ("a", 2, None) in rows("replace")
    assert ("a", 1, "x") in rows("ignore")
    with pytest.raises(ValueError):
        upsert(old, new, ["k"], "other")
    with pytest.raises(ValueError):
        upsert(old, new.drop("_ord"), ["k"])


def test_replace_partition(spark):
    old = spark.createDataFrame([(1, 0, "a"), (1, 1, "b"), (2, 0, "c")], "d int, i int, t string")
    new = spark.createDataFrame([(1, 0, "z")], "d int, i int, t string")
    assert sorted(map(tuple, replace_partition(old, new, ["d"]).collect())) == [(1, 0, "z"), (2, 0, "c")]


def test_archives():
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("a.xml", "<?xml version='1.0'?><a>one</a>")
        z.writestr("b.png", b"\x89PNG")
    outer = io.BytesIO()
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("in.zip", inner.getvalue())
        z.writestr("c.txt", "two")
    assert formats.text_of(outer.getvalue()) == "one\ntwo"
    assert formats.text_of(gzip.compress(b"<html><script>x</script>hi &amp; you</html>")) == "hi & you"
    assert formats.text_of(b"PK\x03\x04broken") is None


PAGE = "doc_id long, page_no int, height double, lines array<struct<text: string, x0: double, x1: double, top: double, bottom: double>>, tables array<struct<bbox: array<double>, col_x: array<double>, rows: array<array<string>>, source_engine: string, structure_confidence: double>>"


def page(n, top, bottom, rows, edges=(10.0, 50.0), engine=None, confidence=None):
    return (1, n, 800.0, [], [([0.0, float(top), 100.0, float(bottom)], list(edges), rows, engine, confidence)])


def test_stitch(spark):
    head = ["a", "b"]
    stitch = lambda *pages: geometry.stitch(spark.createDataFrame(list(pages), PAGE)).orderBy("table_seq").collect()
    high = page(2, 40, 300, [head, ["3", "4"]])
    joined = stitch(page(1, 200, 780, [head, ["1", " 2 "], []], engine="x", confidence=0.0), high)
    assert len(joined) == 1 and joined[0]["rows"] == [head, ["1", "2"], ["3", "4"]] and joined[0]["page_end"] == 2 and joined[0]["structure_confidence"] == 0.0 and joined[0]["source_engine"] == "x"
    assert len(stitch(page(1, 200, 780, [head, ["1", "2"]]), page(2, 40, 300, [head, ["3", "4"]], (200.0, 300.0)))) == 2
    assert len(stitch(page(1, 200, 400, [head, ["1", "2"]]), high)) == 2
    assert len(stitch(page(1, 200, 780, [head, ["1", "2"]]), page(3, 40, 300, [head, ["3", "4"]]))) == 2
    # columns that drift are held against the table's first piece
    drift = [page(i, 40, 780, [head, ["1", str(i)]], (10.0 + 8 * i, 50.0 + 8 * i)) for i in range(1, 4)]
    assert [(r["page_start"], r["page_end"]) for r in stitch(*drift)] == [(1, 2), (3, 3)]
    # a page without tables closes the open one, a page with an empty grid alone does not
    assert len(stitch(page(1, 40, 780, [head, ["1", "2"]]), (1, 2, 800.0, [], []), page(3, 40, 300, [head, ["3", "4"]]))) == 2
    assert len(stitch(page(1, 40, 780, [head, ["1", "2"]]), page(2, 40, 300, [["", ""]]), page(3, 40, 300, [head, ["3", "4"]]))) == 1


def test_reflow(spark):
    line = lambda text, top, x0=0.0, x1=100.0: (text, x0, x1, float(top), top + 10.0)
    pages = [(7, i, 800.0, [line("ACME Report", 10), line(a, 400), line(f"- {i} -", 790)], []) for i, a in enumerate(["The first half", "of it ends here.", "Another exam-"], 1)]
    run = lambda rows: geometry.reflow(spark.createDataFrame(rows, PAGE)).first()["text"]
    assert run(pages) == "The first half of it ends here.\n\nAnother exam-"
    assert run([(7, 1, 800.0, [line("exam-", 10), line("ple 中", 20), line("文", 30), line("한", 40), line("국", 50)], [])]) == "example 中文 한 국"
    two = [line(f"left {i}", 100 + 20 * i, 0.0, 200.0) for i in range(3)] + [line(f"right {i}", 100 + 20 * i, 250.0, 450.0) for i in range(3)]
    assert run([(7, 1, 800.0, [*two, line("A heading over both of them", 50, 0.0, 440.0)], [])]) == "A heading over both of them left 0 left 1 left 2 right 0 right 1 right 2"
    assert run([(7, 1, 800.0, [], [])]) == ""


def test_structured(spark):
    rows = [["Revenue", "1,234"], ["Cost", "99,999"]]
    df = spark.createDataFrame([(7, 1, 800.0, [("Hello there 1234.", 0.0, 50.0, 400.0, 410.0)], [([0.0, 200.0, 9.0, 300.0], [1.0, 2.0], rows, None, 1.0)]), (8, 1, 800.0, [], [])], PAGE)
    r = {x["doc_id"]: x for x in geometry.structured(df, cost_per_page=0.5).collect()}
    t = r[7]["tables"][0]
    assert (r[7]["text"], t["confidence"], t["needs_review"], r[7]["escalated_count"]) == ("Hello there 1234.", 0.5, True, 0) and (r[8]["text"], r[8]["tables"], r[8]["page_count"]) == ("", [], 1)
    fixed = lambda rows, context: F.array(F.array(F.lit("Revenue"), F.lit("1,234")))
    better = geometry.structured(df, cost_per_page=0.5, engine=fixed).where("doc_id = 7").first()
    assert (better["tables"][0]["confidence"], better["tables"][0]["needs_review"], better["est_cost"]) == (1.0, False, 0.5)


@pytest.mark.parametrize("text, want", [("1,234.5", True), ("(12)", True), ("-3%", True), ("12 000", True), ("", False), ("()", False), ("1a", False), ("12-13", False)])
def test_number_cells(spark, text, want):
    assert one(spark, S.is_numeric(F.lit(text))) == want


def test_unicode_space(spark):
    assert one(spark, S.normalize_symbol(F.lit("US"), F.lit("　aapl\xa0"))) == "AAPL"
    assert one(spark, S.to_iso(F.lit("\xa02024-01-31 10:00"))) == "2024-01-31"
    assert one(spark, S.is_page_number(F.lit("第　１２　页"))) and one(spark, S.squeeze(F.lit("a\u2003\x85b\x1c"))) == "a b"
    assert S.range_or_default(None, None, "2024-02-29", 1) == ("2023-02-28", "2024-02-29") and S.range_or_default("2020-01-01", None, "2024-05-06") == ("2020-01-01", "2024-05-06")


def compound(streams):
    """A compound file of short streams in a storage, written sector by sector."""
    names = ["Root Entry", "FileHeader", "BodyText", *streams["BodyText"]]
    data = {"FileHeader": streams["FileHeader"], **streams["BodyText"]}
    mini, starts = b"", {}
    for n in names:
        if n in data:
            starts[n] = len(mini) // 64
            mini += data[n] + bytes(-len(data[n]) % 64)
    chains = []
    for n in names:
        if n in data:
            k = -(-len(data[n]) // 64)
            chains += [starts[n] + i + 1 for i in range(k - 1)] + [0xFFFFFFFE]
    body = mini + bytes(-len(mini) % 512)
    mini_fat = struct.pack(f"<{len(chains)}I", *chains)
    mini_fat += b"\xff" * (-len(mini_fat) % 512)
    nothing = 0xFFFFFFFF
    links = {"Root Entry": (nothing, nothing, 1), "FileHeader": (nothing, 2, nothing), "BodyText": (nothing, nothing, 3)}
    for i, n in enumerate(streams["BodyText"]):
        links[n] = (nothing, 4 + i if i + 1 < len(streams["BodyText"]) else nothing, nothing)
    directory = b""
    for n in names:
        raw = n.encode("utf-16-le") + b"\0\0"
        kind = 5 if n == "Root Entry" else 1 if n == "BodyText" else 2
        first, size = (0, len(mini)) if kind == 5 else (starts.get(n, 0), len(data.get(n, b"")))
        directory += raw.ljust(64, b"\0") + struct.pack("<HBB3I", len(raw), kind, 1, *links[n]) + bytes(36) + struct.pack("<IQ", first, size)
    directory += bytes(-len(directory) % 512)
    blocks = [body, mini_fat, directory]
    at, fat, places = 1, [0xFFFFFFFD], []
    for b in blocks:
        k = len(b) // 512
        places.append(at)
        fat += [at + i + 1 for i in range(k - 1)] + [0xFFFFFFFE]
        at += k
    fat_sector = struct.pack(f"<{len(fat)}I", *fat) + b"\xff" * (512 - 4 * len(fat))
    first_root = struct.pack("<I", places[0])
    directory = directory[:116] + first_root + directory[120:]
    head = bytes.fromhex("D0CF11E0A1B11AE1") + bytes(16) + struct.pack("<HHHHH", 62, 3, 0xFFFE, 9, 6) + bytes(6) + struct.pack("<9I", 0, 1, places[2], 0, 4096, places[1], len(mini_fat) // 512, 0xFFFFFFFE, 0)
    return head + struct.pack("<I", 0) + b"\xff" * (4 * 108) + fat_sector + body + mini_fat + directory


def record(tag, body):
    return struct.pack("<I", tag | min(len(body), 0xFFF) << 20) + (struct.pack("<I", len(body)) if len(body) >= 0xFFF else b"") + body


def test_word_files():
    control = struct.pack("<8H", 2, *[0x41] * 7)  # a wide control: its payload is no text
    text = lambda t: record(67, control + t.encode("utf-16-le") + struct.pack("<H", 13))
    deflate = lambda b: zlib.compressobj(9, 8, -15)

    def packed(b):
        c = deflate(b)
        return c.compress(b) + c.flush()

    sections = {"Section10": record(66, b"xx") + text("열번째 " + "가" * 3000), "Section2": text("둘째")}
    header = lambda flags: b"HWP Document File".ljust(32, b"\0") + struct.pack("<II", 0x05000000, flags)
    plain = compound({"FileHeader": header(0), "BodyText": {k: v for k, v in sections.items() if k == "Section2"}})
    small = compound({"FileHeader": header(1), "BodyText": {k: packed(v) for k, v in sections.items()}})
    assert formats.sniff(plain) == "hwp" and formats.text_of(plain) == "둘째" and formats.text_of(small) == "둘째\n\n열번째 " + "가" * 3000
    assert formats.text_of(compound({"FileHeader": header(2), "BodyText": sections})) is None
    assert formats.sniff(compound({"FileHeader": b"other".ljust(40), "BodyText": {"Section2": b"x"}})) == "ole" and formats.text_of(plain[:600]) is None
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("mimetype", "application/hwp+zip")
        z.writestr("Contents/header.xml", "<h>no</h>")
        z.writestr("Contents/section10.xml", "<a>ten</a>")
        z.writestr("Contents/section2.xml", "<a>two</a>")
    assert formats.sniff(out.getvalue()) == "hwpx" and formats.text_of(out.getvalue()) == "two\nten"


def test_asof_beyond_the_broadcast(spark):
    rates = spark.createDataFrame([("A", "2023-01-05", 1.0), ("A", "2023-03-31", 2.0), ("B", "2023-02-01", 3.0)], "k string, day string, rate double")
    left = spark.createDataFrame([("A", d) for d in ("2023-01-04", "2023-01-05", "2023-02-10", "2023-03-30", "2023-03-31", "2030-01-01", None)] + [("B", "2023-06-01"), ("C", "2023-06-01")], "c string, at string")
    want = {("A", "2023-01-04"): None, ("A", "2023-01-05"): 1.0, ("A", "2023-02-10"): 1.0, ("A", "2023-03-30"): 1.0, ("A", "2023-03-31"): 2.0, ("A", "2030-01-01"): 2.0, ("A", None): None, ("B", "2023-06-01"): 3.0, ("C", "2023-06-01"): None}
    for limit, node in ((1 << 20, "BroadcastHashJoin"), (0, "SortMergeJoin")):
        out = asof_join(left, rates, [("c", "k")], "at", "day", "rate", "r", broadcast_bytes=limit)
        assert {(x["c"], x["at"]): x["r"] for x in out.collect()} == want
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert node in plan or limit == 0


def test_anchors():
    text = "First. " + "x" * 600 + ". Alpha Fund and Beta have indicated an interest in purchasing up to an aggregate of $1.5 billion of shares. More text. " + "y" * 600
    m = signals.ANCHOR.search(text)
    cut = signals.excerpt(text, *m.span())
    assert cut.startswith("Alpha Fund") and cut.endswith("More text.") and m[2] == "1.5" and m[3] == "billion"
    assert signals.excerpt("A b. C d.", 0, 3) == "A b. C d."


def test_isolated_branches(spark):
    out, failed = signals.isolated(lambda: spark.range(1).toDF("a"), lambda: 1 / 0, lambda: spark.range(2).toDF("b"))
    assert out.count() == 3 and out.columns == ["a", "b"] and len(failed) == 1


def test_metrics():
    gold = [["h1", "h2"], ["a", "1"], ["b", "2"]]
    assert metrics.teds(gold, gold) == 1.0
    assert metrics.teds([["h1", "h2"], ["a", "1"], ["b", "3"]], gold) == pytest.approx(0.9)
    assert metrics.grits_con(gold[:2], gold) == pytest.approx(0.8)
    assert metrics.grits_con([], gold) == 0.0
