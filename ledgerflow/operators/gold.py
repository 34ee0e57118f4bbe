"""Cases with a known answer, laid out as pages: one table, a table over many pages, and wrapped prose, in three languages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import evaluation, geometry

HEIGHT, WIDTH, STEP, ROWS_A_PAGE = 800.0, 600.0, 14.0, 40
#: Headings, labels and sentences of the cases by language; figures are the same in all.
WORDS = {
    "en": ("US", ["Item", "Receipts", "Costs", "Surplus"], ["Receipts grew in all four regions over the year, as new sites opened on time and older ones kept their trade.", "The board plans no large outlays next year and will pay down what it owes to its banks before it buys more land."]),
    "ko": ("KR", ["항목", "수입", "비용", "잉여"], ["회사는 올해 모든 지역에서 수입이 늘었으며 새로 문을 연 매장들이 계획대로 자리를 잡고 기존 매장들도 거래를 지켜 냈습니다.", "이사회는 내년에 큰 지출을 계획하지 않으며 땅을 더 사기 전에 은행에 진 빚부터 갚을 예정입니다."]),
    "zh": ("HK", ["項目", "進款", "費用", "盈餘"], ["公司今年在各個地區的進款都有增長新開的店舖按時開業原有的店舖也守住了生意全年的盈餘因此比去年更多。", "董事會明年沒有大筆支出的計劃在購買更多土地之前會先償還欠銀行的款項並且保留足夠的現金。"]),
}
FIGURES = [["2023", "2022"], ["1,540", "1,310"], ["820", "790"], ["720", "520"]]
PAGES = "doc_id string, page_no int, height double, width double, lines array<struct<text:string,x0:double,x1:double,top:double,bottom:double>>, tables " + geometry.T.ArrayType(geometry.TABLE).simpleString()
GOLD = "name string, category string, paragraphs array<string>, gold array<array<array<string>>>"


def _line(text: str, at: int) -> tuple:
    return (text, 0.0, WIDTH, 100.0 + at * STEP, 110.0 + at * STEP)


def _wrapped(text: str, language: str) -> list[str]:
    """A sentence as lines: between words, but for Chinese, which is cut anywhere."""
    if language == "zh":
        return [text[i : i + 22] for i in range(0, len(text), 22)]
    lines = [""]
    for w in text.split():
        if len(lines[-1]) + len(w) > 48:
            lines.append("")
        lines[-1] = f"{lines[-1]} {w}".strip()
    return lines


def _table_pages(name: str, rows: list[list[str]]) -> list[tuple]:
    """A table from page to page: it fills each but the last, and begins at the head of each but the first."""
    out = []
    for n, lo in enumerate(range(0, len(rows), ROWS_A_PAGE)):
        part = rows[lo : lo + ROWS_A_PAGE]
        top = 40.0 if n else 300.0
        box = [40.0, top, 500.0, 780.0 if lo + ROWS_A_PAGE < len(rows) else top + 20 * len(part)]
        lines = [_line("  ".join(r), i) for i, r in enumerate(part)]
        out.append((name, n + 1, HEIGHT, WIDTH, lines, [(box, [40.0, 200.0, 350.0], part, "drawn", 1.0)]))
    return out


def cases(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Pages (doc_id, page_no, height, width, lines, tables) and gold (name, category, paragraphs, gold) of seven cases."""
    pages: list[tuple] = []
    gold: list[tuple] = []
    for language, (market, labels, prose) in WORDS.items():
        place = f"{market}/{language}"
        table = [[label, *f] for label, f in zip(labels, FIGURES, strict=True)]
        pages += _table_pages(f"{language}-table", table)
        gold.append((f"{language}-table", f"{place}/table", [], [table]))
        lines = [_line(t, i) for i, t in enumerate(x for p in prose for x in _wrapped(p, language))]
        pages += [(f"{language}-prose", n + 1, HEIGHT, WIDTH, part, []) for n, part in enumerate([lines[:3], lines[3:]])]
        gold.append((f"{language}-prose", f"{place}/prose", prose, []))
        if language == "en":
            long = [table[0]] + table[1:] * 30
            pages += _table_pages("en-split", long)
            gold.append(("en-split", f"{place}/split-table", [], [long]))
    return spark.createDataFrame(pages, PAGES), spark.createDataFrame(gold, GOLD)


def score(pages: DataFrame, gold: DataFrame) -> DataFrame:
    """Scores by category of what the engine makes of the pages."""
    read = geometry.structured(pages).select(F.col("doc_id").alias("name"), "text", F.transform("tables", lambda t: t["rows"]).alias("pred"))
    return evaluation.roll_up(evaluation.score_cases(gold.join(read, "name", "left")))
