"""Fetched documents to files, texts and tables, and the back-fill that asks for what is missing."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerflow.api import Engine
from ledgerflow.operators import geometry
from ledgerflow.sources import documents

LINE = "array<struct<text:string,x0:double,x1:double,top:double,bottom:double>>"
FETCHED = "company_id long, filing_id string, source string, doc_seq int, doc_url string, market string, symbol string, content_type string, content binary"
TABLE = [{"bbox": [0.0, 700.0, 9.0, 790.0], "col_x": [1.0, 50.0], "rows": [["Revenue", "1,234"], ["Cost", "99,999"]], "source_engine": "ruled", "structure_confidence": 1.0}]


def pages(pdfs):
    """An engine for the tests: a file's text is its pages, parted by '|'; an empty page has no lines, one with T a table."""
    rows = pdfs.select("doc_id", F.posexplode(F.split(F.decode("content", "UTF-8"), r"\|")).alias("page_no", "t"))
    line = F.when(F.col("t").isin("%PDF-", ""), F.array().cast(LINE)).otherwise(F.array(F.struct(F.col("t").alias("text"), F.lit(0.0).alias("x0"), F.lit(9.0).alias("x1"), F.lit(400.0).alias("top"), F.lit(410.0).alias("bottom"))))
    schema = geometry.T.ArrayType(geometry.TABLE).simpleString()
    table = F.when(F.contains("t", F.lit("1,234")), F.from_json(F.lit(__import__("json").dumps(TABLE)), schema)).otherwise(F.array().cast(schema))
    return rows.select("doc_id", "page_no", F.lit(800.0).alias("height"), F.lit(600.0).alias("width"), line.alias("lines"), table.alias("tables"))


def recognise(empty):
    return empty.select("doc_id", "page_no", F.lit("seen by the engine").alias("text"))


def fetched(spark):
    rows = [
        (1, "f1", "s", 0, "http://h/a.pdf", "US", "AAPL", None, b"%PDF-|Total 1,234 and|12.|"), (1, "f1", "s", 1, "http://h/a.pdf", "US", "AAPL", None, b"%PDF-|one line|"),
        (1, "f1", "s", 2, "http://h/x.htm", "US", "AAPL", "text/html", b"<p>Some <b>text</b></p>"), (2, "f2", "s", 0, "http://h/n", "KR", "005930", "text/plain", b""), (2, "f2", "t", 0, "http://h/n", "KR", "005930", "text/plain", b"\x00\x01"),
    ]
    return spark.createDataFrame(rows, FETCHED)


def test_documents_to_rows_and_files(spark, tmp_path):
    rows, cells = documents.stored(fetched(spark), str(tmp_path), pages, recognise, tables=True)
    got = {(r["filing_id"], r["source"], r["doc_seq"]): r for r in rows.collect()}
    assert got["f1", "s", 0]["text_content"] == "Total 1,234 and 12." and got["f1", "s", 1]["text_content"] == "seen by the engine one line seen by the engine"
    assert got["f1", "s", 2]["text_content"] == "Some text" and got["f1", "s", 2]["doc_format"] == "html" and got["f2", "s", 0]["text_chars"] == 0 and got["f2", "s", 0]["text_content"] is None
    assert all(os.path.getsize(r["local_path"]) == r["file_size"] for r in got.values()) and got["f1", "s", 0]["local_path"] != got["f1", "s", 1]["local_path"]
    c = {(r["row_idx"], r["col_idx"]): r for r in cells.collect()}
    assert {k: r["value"] for k, r in c.items()} == {(0, 0): "Revenue", (0, 1): "1,234", (1, 0): "Cost", (1, 1): "99,999"} and c[0, 0]["confidence"] == 0.5 and c[0, 0]["needs_review"] == 1


def test_plain_texts(spark, tmp_path):
    rows, cells = documents.stored(fetched(spark), str(tmp_path), pages)
    got = {(r["filing_id"], r["source"], r["doc_seq"]): r["text_content"] for r in rows.collect()}
    assert cells is None and got["f1", "s", 1] == "one line" and got["f1", "s", 0] == "Total 1,234 and 12."
    rows, _ = documents.stored(fetched(spark), str(tmp_path))
    assert {r["doc_format"]: r["text_chars"] for r in rows.where("filing_id = 'f1'").collect()} == {"pdf": 0, "html": 9}


def test_long_texts_are_cut(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "MOST_CHARS", 4)
    rows, _ = documents.stored(fetched(spark), str(tmp_path))
    assert {r["text_content"] for r in rows.collect()} == {"Some", None}


@pytest.fixture()
def engine(spark):
    e = Engine(spark).create()
    e.tables["securities"] = spark.createDataFrame([(5, 1, "US", "AAPL", 0), (6, 1, "HK", "01", 1)], "security_id long, company_id long, market string, symbol string, is_primary int")
    e.write("filings", spark.createDataFrame([(1, "f1", '["http://h/a.htm","http://h/b.htm","http://h/c.htm"]', "s", 1), (1, "f2", None, "s", 2)], "company_id long, filing_id string, doc_urls string, source string, _ord long"))
    return e


def test_backfill_asks_for_what_is_missing(spark, engine, tmp_path):
    asked = []

    def fetch(wanted):
        asked.append(sorted((r["filing_id"], r["doc_seq"], r["market"], r["symbol"]) for r in wanted.collect()))
        found = wanted.where("doc_seq <> 1" if len(asked) == 1 else "true")
        return found.withColumns({"content_type": F.lit("text/html"), "content": F.when(F.col("doc_seq") == 2, F.lit("")).otherwise(F.concat(F.lit("<p>"), "doc_url", F.lit("</p>"))).cast("binary")})

    assert engine.backfill(fetch, str(tmp_path)) == {"documents": 2, "empty": 1}
    assert engine.backfill(fetch, str(tmp_path)) == {"documents": 1, "empty": 0}
    assert asked == [[("f1", i, "HK", "01") for i in range(3)], [("f1", 1, "HK", "01")]]
    got = {r["doc_seq"]: (r["text_content"], r["local_path"]) for r in engine.tables["filing_documents"].collect()}
    assert got[0] == ("http://h/a.htm", f"{tmp_path}/HK/01/f1/a.htm") and got[2][0] is None and len(got) == 3
    assert engine.documents_to_fetch().where("doc_url <> ''").count() == 0


def test_backfill_writes_tables(spark, engine, tmp_path):
    fetch = lambda wanted: wanted.where("doc_seq = 0").withColumns({"content_type": F.lit(None).cast("string"), "content": F.lit(b"%PDF-|Total 1,234")})
    for _ in range(2):
        engine.tables["filing_documents"] = engine.tables["filing_documents"].limit(0)
        engine.backfill(fetch, str(tmp_path), pages=pages, tables=True)
    assert engine.tables["filing_tables"].count() == 4 and {r["filing_id"] for r in engine.tables["filing_tables"].collect()} == {"f1"}
