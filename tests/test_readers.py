"""Readers of files and small parsers that no query over the driver's tables reaches."""

from pyspark.sql import functions as F

from ledgerflow.operators import entities
from ledgerflow.sources import asia, disclosures, formats


def test_tab_table(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes("ACCESSION_NUMBER\tFILINGMANAGER_NAME\n1\tCaf\xe9 Fund\n".encode("latin-1"))
    assert disclosures.tab_table(spark, str(tmp_path / "a.tsv")).first()["FILINGMANAGER_NAME"] == "Café Fund"


def test_read_overrides(spark, tmp_path):
    (tmp_path / "o.csv").write_text("group,market,symbol\ng, hk ,700\ng,US,\n,US,A\n")
    assert [(r["group"], r["market"], r["symbol"]) for r in entities.read_overrides(spark, str(tmp_path / "o.csv")).collect()] == [("g", "HK", "00700")]


def test_bulk_link(spark):
    page = '<a href="/x.zip"><a href="/files/structureddata/form-13f-data-sets/2024_form13f.zip"><a href="/form-13f-data-sets/2023_form13f.zip">'
    rows = spark.createDataFrame([(page,), ("none",)], "p string").select(disclosures.bulk_link(F.col("p")).alias("u")).collect()
    assert [r["u"] for r in rows] == ["https://www.sec.gov/files/structureddata/form-13f-data-sets/2024_form13f.zip", None]


def test_exchange_master(spark):
    lists = spark.createDataFrame([("KOSPI", "005930", "a"), ("KOSDAQ", "035720", None)], "exchange string, ticker string, name string")
    assert [(r["symbol"], r["exchange"], r["currency"]) for r in asia.exchange_master(lists, ["035720"]).collect()] == [("035720", "KOSDAQ", "KRW")]


def test_local_path(spark):
    path = spark.range(1).select(formats.local_path("/docs", F.lit("KR"), F.lit("005930"), F.lit("f1"), F.lit("a.pdf")).alias("p"))
    assert path.first()["p"] == "/docs/KR/005930/f1/a.pdf"
