"""Tables without rules and pages in columns, as jobs over words, against plain code page by page."""

import random

import plain_columns as plain
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import columns, geometry

WORDS = "doc_id string, page_no int, ord int, text string, x0 double, x1 double, top double, bottom double"


def word(text, x, y, width=None):
    return {"text": text, "x0": float(x), "x1": float(x) + (width or 6.0 * len(text)), "top": float(y), "bottom": y + 10.0}


def frame(spark, pages):
    rows = [(name, 1, i, w["text"], w["x0"], w["x1"], w["top"], w["bottom"]) for name, words in pages.items() for i, w in enumerate(words)]
    return spark.createDataFrame(rows, WORDS).repartition(3)


def tables(spark, pages):
    got = columns.column_tables(frame(spark, pages), ["doc_id", "page_no"]).collect()
    return {r["doc_id"]: [t.asDict() for t in r["tables"]] for r in got}


def lines(spark, pages):
    got = columns.column_lines(frame(spark, pages), ["doc_id", "page_no"]).collect()
    return {r["doc_id"]: [x.asDict() for x in r["lines"]] for r in got}


def borderless():
    grid = [("", "31 March", "31 March"), ("", "2024", "2023"), ("Revenue", "1,234", "987"), ("Cost", "(56)", "(43)"), ("Net", "1,178", "944")]
    right = lambda text, edge, y: word(text, edge - 6.0 * len(text), y)
    words = [word("(RMB", 50, 20), word("million)", 80, 20)]
    for i, (a, b, c) in enumerate(grid):
        y = 40 + 20 * i
        words += [word(a, 50, y)] if a else []
        words += [right(x, edge, y) for cell, edge in ((b, 300), (c, 420)) for x, edge in ([(cell.split()[0], edge - 36), (cell.split()[1], edge)] if " " in cell else [(cell, edge)])]
    return words


def side(name, x, y):
    return [word(w, x + 32 * k, y, 28) for k, w in enumerate(f"{name} has some more words".split())]


def test_borderless_tables(spark):
    words = borderless()
    prose = [word(f"word{j}", 50 + 100 * j, 20 * i) for i in range(6) for j in range(4)]
    got = tables(spark, {"table": words, "prose": prose, "few": words[:5], "short": [w for w in words if w["top"] < 70]})
    ((table,),) = got.values()
    assert set(got) == {"table"} and table["rows"] == [["31 March", "31 March"], ["2024", "2023"], ["Revenue", "1,234", "987"], ["Cost", "(56)", "(43)"], ["Net", "1,178", "944"]]
    assert table["structure_confidence"] == 0.6 and table["source_engine"] == "column-geometry"


def test_column_lines(spark):
    words = [word(w, 100 + 60 * k, 5, 50) for k, w in enumerate("one heading over all columns".split())]
    words += [w for i in range(5) for w in side(f"L{i}", 50, 30 + 20 * i) + side(f"R{i}", 300, 30 + 20 * i)]
    figures = [w for i in range(8) for w in side(f"L{i}", 50, 30 + 20 * i) + [word(str(i * 1000), 300, 30 + 20 * i)]]
    got = lines(spark, {"set": words, "figures": figures, "table": borderless()})
    assert set(got) == {"set"} and [x["text"].split()[0] for x in got["set"]] == ["one", "L0", "L1", "L2", "L3", "L4", "R0", "R1", "R2", "R3", "R4"]


def random_page(r):
    """Stretches of tables, headings, prose in one or two columns and crossing lines, with jitter, ties and blanks."""
    words, y = [], 10.0
    for _ in range(r.randrange(1, 5)):
        kind = r.choice(["table", "columns", "columns", "prose", "cross"])
        for _ in range(r.randrange(1, 9)):
            y += r.choice([12, 14, 20, 1.2])
            jit = lambda: r.choice([0, 0, 0.4, 1.6, -0.3])
            if kind == "table":
                xs = [50, 200, 320, 430][: r.randrange(2, 5)]
                words += [word(r.choice(["Revenue", "12,300", "(45)", "9%", "n.a.", "1", "Net profit", " "]), x + r.choice([0, 0, 5, 12]), y + jit()) for x in xs if r.random() < 0.9]
            elif kind == "columns":
                words += [word(r.choice(["some", "words", "more", "12"]), x + 32 * k, y + jit(), 28) for x in (50, 310) for k in range(r.randrange(3, 7))]
            elif kind == "prose":
                words += [word(r.choice(["long", "line", "of", "text"]), 50 + 40 * k, y + jit(), 30) for k in range(r.randrange(4, 12))]
            else:
                words += [word("crossing", 150 + 70 * k, y, 66) for k in range(4)]
    r.shuffle(words)
    return words


@pytest.mark.parametrize("seed", [1, 2])
def test_random_pages_as_plain_code(spark, seed):
    r = random.Random(seed)
    pages = {f"p{i}": p for i in range(150) if (p := random_page(r))}
    near = lambda x: [{k: pytest.approx(v) if isinstance(v, (float, list)) and k in ("bbox", "col_x", "x0", "x1", "top", "bottom") else v for k, v in t.items()} for t in x]
    want = {n: t for n, p in pages.items() if (t := plain.column_tables(p))}
    got = tables(spark, pages)
    assert set(got) == set(want) and len(want) > 10
    for n in want:
        assert got[n] == near(want[n]), n
    want = {n: t for n, p in pages.items() if (t := plain.column_lines(p)) is not None}
    got = lines(spark, pages)
    assert set(got) == set(want) and len(want) > 5
    for n in want:
        assert got[n] == near(want[n]), n


def test_parsed_pages(spark):
    line = [{"text": "own", "x0": 0.0, "x1": 1.0, "top": 0.0, "bottom": 1.0}]
    ruled = [{"bbox": [0.0], "col_x": [0.0], "rows": [["ruled"]], "source_engine": "r", "structure_confidence": 1.0}]
    two = [w for i in range(6) for w in side(f"L{i}", 50, 30 + 20 * i) + side(f"R{i}", 300, 30 + 20 * i)]
    rows = [("a", 1, borderless(), ruled, line), ("a", 2, borderless(), [], line), ("a", 3, two, None, line), ("a", 4, two[:3], [], line), ("a", 5, None, [], line)]
    schema = "doc_id string, page_no int, words array<struct<text:string,x0:double,x1:double,top:double,bottom:double>>, tables " + geometry.T.ArrayType(geometry.TABLE).simpleString() + ", lines array<struct<text:string,x0:double,x1:double,top:double,bottom:double>>"
    out = columns.parsed_pages(spark.createDataFrame(rows, schema))
    got = {r["page_no"]: ([t["rows"][0][0] for t in r["tables"]], [x["text"].split()[0] for x in r["lines"]][:2]) for r in out.collect()}
    assert got == {1: (["ruled"], ["own"]), 2: (["31 March"], ["own"]), 3: ([], ["L0", "L1"]), 4: ([], ["own"]), 5: ([], ["own"])}
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString() and out.columns == ["doc_id", "page_no", "words", "tables", "lines"]


def test_no_words(spark):
    empty = frame(spark, {"a": [word("x", 1, 1)]}).where(F.lit(False))
    assert columns.column_tables(empty, ["doc_id"]).count() == 0 == columns.column_lines(empty, ["doc_id"]).count()
