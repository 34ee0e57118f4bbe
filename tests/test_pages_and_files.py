"""Recognised pages, detected grids, escalation, archives, saved files, landed feeds, bucketed tables, peers and reviews."""

import json
import os
import resource
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from ledgerflow.operators import entities, escalation, geometry, grid, ocr, signals
from ledgerflow.plans import tables, views
from ledgerflow.sources import archives, sinks
from ledgerflow.streaming import landing

# -- pages without text ------------------------------------------------------------------

PAGE = "doc_id string, page_no int, height double, width double, image string, lines array<struct<text:string,x0:double,x1:double,top:double,bottom:double>>"


def engine(pages):
    return pages.select("doc_id", "page_no", F.col("image").alias("text"))


def test_pages_without_text_are_recognised(spark):
    own = [("own", 1.0, 2.0, 3.0, 4.0)]
    rows = [("a", 1, 900.0, 600.0, "one\r\n\n two ", []), ("a", 2, 900.0, 600.0, "never", own), ("a", 3, None, None, "x", None), ("b", 1, 900.0, 600.0, None, [])]
    got = {(r["doc_id"], r["page_no"]): [tuple(x) for x in r["lines"]] for r in ocr.recognised(spark.createDataFrame(rows, PAGE), engine).collect()}
    assert got == {("a", 1): [("one", 0.0, 600.0, 0.0, 450.0), ("two", 0.0, 600.0, 450.0, 900.0)], ("a", 2): own, ("a", 3): [("x", 0.0, 1.0, 0.0, 1.0)], ("b", 1): []}


def test_so_many_pages_of_a_document(spark):
    rows = [("a", i, 9.0, 9.0, "t", None if i % 3 else []) for i in range(200)] + [("b", 7, 9.0, 9.0, "t", [])]
    df = spark.createDataFrame(rows, PAGE)
    asked = sorted((r["doc_id"], r["page_no"]) for r in ocr.without_text(df).collect())
    assert asked == [("a", i) for i in range(50)] + [("b", 7)]
    assert "WindowGroupLimit" in ocr.without_text(df)._jdf.queryExecution().executedPlan().toString()
    assert ocr.recognised(df, None) is df


def test_recognised_pages_reflow_with_the_others(spark):
    line = lambda t, y: (t, 0.0, 100.0, y, y + 10)
    rows = [("a", i, 800.0, 600.0, "goes on over\nthe page's end.", [] if i == 2 else [line("A sentence that", 400.0)]) for i in (1, 2)]
    out = geometry.reflow(ocr.recognised(spark.createDataFrame(rows, PAGE), engine)).first()["text"]
    assert out == "A sentence that goes on over the page's end."


def test_engines_are_looked_for_once(caplog):
    with caplog.at_level("WARNING"):
        assert not ocr.engine_there("no_such_engine_here") and not ocr.engine_there("no_such_engine_here") and ocr.engine_there("json")
    assert len(caplog.records) == 1


# -- grids ------------------------------------------------------------------------------------


def test_grid_takes_every_word_of_its_rows(spark):
    word = lambda i, t, x, y: ("d", 1, i, t, x - 5.0, x + 5.0, y - 5.0, y + 5.0)
    words = [word(0, "Gross", 8.0, 10.0), word(1, "profit", 30.0, 10.0), word(2, "12", 140.0, 10.0), word(3, "Net", 30.0, 60.0), word(4, "out", 30.0, 35.0), word(5, "-", 75.0, 60.0), ("d", 2, 0, "other", 1.0, 2.0, 5.0, 15.0)]
    table = [("d", 1, 0, [0.0, 0.0, 300.0, 200.0], [[0.0, 0.0, 300.0, 40.0], [0.0, 80.0, 300.0, 90.0], [0.0, 100.0, 300.0, 140.0]], [[30.0, 0.0, 100.0, 9.0], [200.0, 0.0, 240.0, 9.0]], 2.0), ("d", 1, 1, [0.0] * 4, [], [], 1.0)]
    w = spark.createDataFrame(words, "doc_id string, page_no int, ord int, text string, x0 double, x1 double, top double, bottom double")
    t = spark.createDataFrame(table, "doc_id string, page_no int, table_no int, box array<double>, rows array<array<double>>, cols array<array<double>>, scale double")
    for band in (1.0, 24.0, 1000.0):
        got = [(r["row_idx"], r["cells"]) for r in grid.filled_grids(w, t, band).orderBy("row_idx").collect()]
        assert got == [(0, ["Gross profit", "12"]), (1, ["Net -", ""])]
    assert "CartesianProduct" not in grid.filled_grids(w, t)._jdf.queryExecution().executedPlan().toString()


# -- escalation ---------------------------------------------------------------------------------


def test_guards_in_order(caplog):
    ask = lambda prompts: prompts
    assert escalation.permitted(ask) is None and escalation.permitted(ask, enabled=True) is None
    assert escalation.permitted(ask, enabled=True, local_only=False) is None
    assert escalation.permitted(ask, enabled=False, local_only=False, key="k") is None
    assert escalation.permitted(ask, enabled=True, local_only=True, key="k") is None
    assert escalation.permitted(ask, enabled=True, local_only=False, key="k") is ask


TABLES = "doc_id int, table_seq int, confidence double, page_start int, page_end int, rows array<array<string>>, source_engine string, raw string, context string"


def doubtful(spark, *rows):
    return spark.createDataFrame([(1, i, c, 1, n, [["a", "99"]], "own", "12 and 34", "c" * 30_000) for i, (c, n) in enumerate(rows)], TABLES)


def test_choice_by_confidence_and_budget(spark):
    t = doubtful(spark, (0.5, 2), (0.9, 1), (None, 1), (0.1, 3), (0.66, 1), (0.65, 1))
    pick = lambda **a: [r["table_seq"] for r in escalation.chosen(t, **a).where("chosen").orderBy("table_seq").collect()]
    assert pick() == [0, 2, 3, 5] and pick(budget=0.08) == [2, 3] and pick(budget=0.0) == [] and pick(budget=0.12) == [0, 2, 3]


@pytest.mark.parametrize("reply, rows, engine_, sure", [
    ('ok ```json {"rows": [["a", 12], ["b", null]]} ```', [["a", "12"], ["b", ""]], "text-llm", 1.0), ('{"rows": [["a", "77"]]}', [["a", "77"]], "text-llm", 0.0),
    ('{"rows": []}', [["a", "99"]], "own", 0.3), ("no table", [["a", "99"]], "own", 0.3), (None, [["a", "99"]], "own", 0.3), ("raise", [["a", "99"]], "own", 0.3),
])
def test_replies(spark, reply, rows, engine_, sure):
    def ask(prompts):
        assert all("c" * 20_000 in p and "c" * 20_001 not in p and '[["a","99"]]' in p and "with 2 cells" in p for p in prompts)
        if reply == "raise":
            raise OSError("no net")
        return [reply] * len(prompts)

    t = escalation.chosen(doubtful(spark, (0.3, 2), (0.9, 1)))
    got = {r["table_seq"]: r for r in escalation.read_again(t, ask).collect()}
    assert (got[0]["rows"], got[0]["source_engine"], got[0]["confidence"]) == (rows, engine_, sure) and got[0]["escalated"] and got[0]["est_cost"] == pytest.approx(0.04)
    assert got[1]["rows"] == [["a", "99"]] and not got[1]["escalated"] and got[1]["est_cost"] == 0.0 and not got[1]["needs_review"] and got[0]["needs_review"] == (sure < 0.66)


def test_without_permission_nothing_is_asked(spark):
    r = escalation.read_again(escalation.chosen(doubtful(spark, (0.3, 2))), None).first()
    assert r["needs_review"] and not r["escalated"] and r["est_cost"] == 0.0 and "Python" not in escalation.read_again(escalation.chosen(doubtful(spark, (0.3, 2))), None)._jdf.queryExecution().executedPlan().toString()


# -- archives -------------------------------------------------------------------------------------


def test_archives_written_and_read(spark, tmp_path):
    spark.dataSource.register(archives.ZippedTables)
    at = f"file://{tmp_path}/z"
    rows = spark.createDataFrame([(i, "é\tx\ny" if i % 2 else None, float(i)) for i in range(100)], "a int, b string, c double").repartition(3)
    write = lambda mode: rows.write.format("zipped_tables").mode(mode).option("member", "INFO.tsv").save(at)
    write("append")
    read = lambda schema=None: (spark.read.schema(schema) if schema else spark.read).format("zipped_tables").option("member", "info.TSV").load(at)
    assert read().columns == ["a", "b", "c"] and read().count() == 100
    assert {r["b"] for r in read("b string, none string").collect()} == {"é x y", None} and {r["none"] for r in read("b string, none string").collect()} == {None}
    write("append")
    assert read().count() == 200
    write("overwrite")
    assert read().count() == 100 and len(archives.archives(at)) == 3 and not [p for p in os.listdir(tmp_path / "z") if p.startswith("_")]
    assert read().rdd.getNumPartitions() == 3
    assert spark.read.format("zipped_tables").option("member", "other").schema("a string").load(at).count() == 0


def test_failed_writes_leave_nothing(spark, tmp_path):
    spark.dataSource.register(archives.ZippedTables)
    bad = F.udf(lambda x: 1 // (x - 5), "int")
    with pytest.raises(Exception, match="ZeroDivision"):
        spark.range(20).repartition(4).select(bad("id").alias("v")).write.format("zipped_tables").mode("append").save(f"file://{tmp_path}/z")
    assert archives.archives(f"file://{tmp_path}/z") == []


def test_a_large_member_is_streamed(tmp_path):
    line = ("0000320193\t" + "X" * 80 + "\t12345\n") * 20_000
    with zipfile.ZipFile(tmp_path / "big.zip", "w", zipfile.ZIP_DEFLATED) as z, z.open("INFO.tsv", "w", force_zip64=True) as f:
        f.write(b"CIK\tNAME\tVALUE\n")
        for _ in range(104):
            f.write(line.encode())
    reader = archives._Reader(StructType([StructField("CIK", StringType()), StructField("VALUE", StringType())]), {"path": str(tmp_path / "big.zip"), "member": "info.tsv"})
    (part,) = reader.partitions()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert sum(b.num_rows for b in reader.read(part)) == 104 * 20_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100_000


# -- files ------------------------------------------------------------------------------------------

DOCS = "market string, symbol string, filing_id string, name string, content binary, doc_seq int"


def test_documents_are_saved_once(spark, tmp_path):
    rows = [("US", "AAPL", "f/1", "a.pdf", b"one", 0), ("US", "AAPL", "f/1", "a.pdf", b"two", 1), ("US", "AAPL", "f/1", "../x?.htm", b"three", 2), ("KR", "005930", "f2", "보고서.hwp", None, 0), ("US", "AAPL", "f/1", "a.pdf", b"one", 0)]
    save = lambda r: {(x["market"], x["name"]): (x["status"], x["size"]) for x in sinks.save_documents(spark.createDataFrame(r, DOCS), str(tmp_path)).collect()}
    first = save(rows)
    odd = next(n for _, n in first if "x_" in n)
    assert first == {("US", "a.pdf"): ("written", 3), ("US", "2~a.pdf"): ("written", 3), ("US", odd): ("written", 5), ("KR", "보고서.hwp"): ("written", 0)} and odd.endswith(".htm")
    assert {s for s, _ in save(rows).values()} == {"kept"}
    assert save([(*rows[0][:4], b"onf", 0)])["US", "a.pdf"] == ("written", 3)
    files = [os.path.join(d, n) for d, _, names in os.walk(tmp_path) for n in names]
    assert len(files) == 4 and not any(f.endswith(".part") for f in files) and all(str(tmp_path) in os.path.realpath(f) for f in files)


@pytest.mark.parametrize("name", ["plain.txt", "../../etc/passwd", "a/b\\c:d*e?.pdf", "..", "", None, "x" * 300 + ".xml", "é" * 150 + ".html", "tab\there", " . "])
def test_names_are_safe_and_stay_apart(spark, name):
    got = spark.range(1).select(sinks.safe_name(F.lit(name).cast("string")).alias("n")).first()["n"]
    assert got and len(got.encode()) <= 220 and "/" not in got and "\\" not in got and not got.startswith(".") and (got == name if name == "plain.txt" else "~" in got)


def test_csv_and_text(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a"b,c', [1, 2]), (2, None, [])], "k int, t string, l array<int>")
    sinks.save_csv(df.coalesce(1), f"{tmp_path}/csv")
    back = spark.read.csv(f"{tmp_path}/csv", header=True, escape='"')
    assert sorted(map(tuple, back.collect())) == [("1", 'a"b,c', "[1,2]"), ("2", None, "[]")]
    assert sinks.text_table(df.select("k", F.lit("x" * 50).alias("long")), 1, 10).split("\n") == ["k  long", "-  ----------", "1  xxxxxxxxx…"]


# -- landed feeds --------------------------------------------------------------------------------------

ROWS = "k int, v string, _ord int"
KEPT = StructType([StructField("k", IntegerType()), StructField("v", StringType())])


def test_feeds_take_each_file_once(spark, tmp_path):
    land, at = str(tmp_path / "land"), str(tmp_path / "table")
    table = landing.KeyedTable(spark, at, KEPT, ["k"], 4)
    drop = lambda rows: spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(land)
    run = lambda: landing.feed(spark.readStream.schema(ROWS).parquet(land), table, str(tmp_path / "cp"), rules={"v": "coalesce_new_old"})
    rows = lambda t=table: {r["k"]: r["v"] for r in t.read().collect()}
    drop([(i, f"a{i}", i) for i in range(20)])
    assert run() == 1 and run() == 0 and rows() == {i: f"a{i}" for i in range(20)}
    drop([(3, "b", 50), (4, None, 51), (30, "c", 52)])
    assert run() == 1
    want = {i: f"a{i}" for i in range(20)} | {3: "b", 30: "c"}
    assert rows() == want
    # a batch that is replayed, also over what it left half done
    table.write(spark.createDataFrame([(3, "b", 50), (4, None, 51), (30, "c", 52)], ROWS), table.versions()[-1], rules={"v": "coalesce_new_old"})
    assert rows() == want
    half = landing.KeyedTable(spark, at, KEPT, ["k"], 4)
    half._fs.delete(half._at("_whole", str(half.versions()[-1])), False)
    assert rows(half) == {i: f"a{i}" for i in range(20)}
    table.write(spark.createDataFrame([(3, "b", 50), (4, None, 51), (30, "c", 52)], ROWS), 2, rules={"v": "coalesce_new_old"})
    assert rows() == want
    table.compact()
    assert rows() == want and sum(n.startswith("version=") for b in table._names() if b.startswith("bucket=") for n in table._names(b)) == len([b for b in table._names() if b.startswith("bucket=")])


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    table = landing.KeyedTable(spark, str(tmp_path), KEPT, ["k"], 8)
    table.write(spark.createDataFrame([(i, "a", i) for i in range(100)], ROWS), 1)
    table.write(spark.createDataFrame([(1, "b", 1)], ROWS), 2)
    assert [b for b in table._names() if b.startswith("bucket=") and "version=2" in table._names(b)] and sum("version=2" in table._names(b) for b in table._names() if b.startswith("bucket=")) == 1
    table.write(spark.createDataFrame([], ROWS), 3)
    assert table.versions() == [1, 2, 3] and table.read().count() == 100


# -- bucketed tables, peers, reviews ---------------------------------------------------------------------


def test_documents_are_not_shuffled_again(spark, tmp_path):
    have = views.bucketed(spark.range(1000).select(F.col("id").cast("string").alias("filing_id"), F.lit(0).alias("doc_seq")), f"{tmp_path}/docs", ["filing_id", "doc_seq"], 8)
    wanted = spark.range(1200).select(F.col("id").cast("string").alias("filing_id"), F.array(F.lit(0), F.lit(1)).alias("seqs"))
    out = views.missing_documents(wanted, have, ["filing_id"])
    assert out.count() == 1000 + 400
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Final Plan")[-1].count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan


def test_unknown_peers_get_companies(spark):
    sec = spark.createDataFrame([(1, "KR", "005930", 7)], "security_id long, market string, symbol string, company_id long")
    companies = spark.createDataFrame([(7, "Samsung", "KR"), (9, "000660", "KR")], "company_id long, name string, country string")
    pairs = spark.createDataFrame([("KR", "005930", p, i) for i, p in enumerate(["660", "000660", "5930", "035420.KS"])], "market string, symbol string, peer string, _ord long")
    xref = tables.create(spark, ["identifier_xref"])["identifier_xref"]
    edges, after, _, made = entities.peers_with_companies(pairs, companies, xref, sec)
    assert sorted(map(tuple, edges.collect())) == [(7, 9), (7, 10)]
    assert {r["company_id"]: r["name"] for r in after.collect()} == {7: "Samsung", 9: "000660", 10: "035420"} and made.count() == 2


def test_reviews(spark):
    rows = [("a", "DRS", "2023-01-10", "d", 1), ("a", "DRS/A", "2023-02-01", "d", 2), ("a", "S-1", "2023-03-01", "p", 3), ("a", "F-1", "2023-03-01", "q", 4), ("b", "DRS", "2023-05-01", "d", 5), ("b", "F-1/A", "2023-04-01", "p", 6), ("c", "DRS", None, "d", 7), ("c", "S-1", "2023-01-01", "p", 8), ("d", "8-K", "2023-01-01", "p", 9), ("e", "DRS", "2023-01-01", "d", 10), ("e", "S-1/A", "2023-01-01", "z", 11)]
    df = spark.createDataFrame(rows, "symbol string, filing_type string, filed_date string, url string, ord int")
    got = {r["symbol"]: (r["signal_date"], r["url"], r["detail"]) for r in signals.confidential_reviews(df).collect()}
    assert set(got) == {"a", "e"}
    assert got["a"] == ("2023-03-01", "p", "Confidential DRS review: first draft 2023-01-10 -> first public S-1 2023-03-01 (50 days, 2 draft submission(s) on file)")
    assert json.dumps(got["e"][2]).count("(0 days, 1 draft")
