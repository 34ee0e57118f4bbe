"""The relational tables as views over the driver's star schema.

Each is one SELECT that Spark and DuckDB read alike, so a query and its oracle
start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

_CCY = "CASE n_regionkey % 3 WHEN 0 THEN 'KRW' WHEN 1 THEN 'HKD' ELSE 'USD' END"
STANDINS: dict[str, str] = {
    "securities": f"""SELECT c_custkey AS security_id, c_custkey % 300 AS company_id, CASE n_regionkey % 3 WHEN 0 THEN 'KR' WHEN 1 THEN 'HK' ELSE 'US' END AS market,
        CAST(c_custkey AS VARCHAR(20)) AS symbol, CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'ADR' ELSE 'COMMON' END AS security_type,
        {_CCY} AS currency, CASE WHEN c_custkey < 300 THEN 1 ELSE 0 END AS is_primary FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "companies": """SELECT c_custkey AS company_id, c_name AS name, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'XX' END AS country, c_mktsegment AS sector, CASE WHEN c_custkey % 5 = 0 THEN 'LEI' END AS lei FROM {customer} WHERE c_custkey < 300
        UNION ALL SELECT 100000 + s_suppkey, s_name, 'SS', 'SUPPLY', NULL FROM {supplier}""",
    "prices": f"""SELECT o_custkey AS security_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS trade_date, o_totalprice AS close, {_CCY} AS currency, o_orderpriority AS source, o_orderkey AS ord
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey""",
    "fx_rates": f"""SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS rate_date, {_CCY} AS base_ccy, 'USD' AS quote_ccy, 'spot' AS rate_type, CAST(floor(max(o_totalprice)) AS DOUBLE) / CAST(100000 AS DOUBLE) AS rate, 'mid' AS source
        FROM {{orders}} JOIN {{customer}} ON o_custkey = c_custkey JOIN {{nation}} ON c_nationkey = n_nationkey WHERE n_regionkey % 3 < 2 GROUP BY 1, 2""",
    "financials": """SELECT l_suppkey AS company_id, CAST(year(l_shipdate) AS INT) AS fiscal_year, CASE WHEN quarter(l_shipdate) = 4 THEN 'FY' ELSE concat('Q', CAST(quarter(l_shipdate) AS VARCHAR(1))) END AS fiscal_period,
        CASE WHEN l_suppkey % 2 = 0 THEN 'CFS' ELSE 'OFS' END AS fs_scope, CASE l_returnflag WHEN 'A' THEN 'IS' WHEN 'R' THEN 'CF' ELSE 'BS' END AS statement_type, l_linestatus AS account, round(sum(l_extendedprice), 2) AS value,
        CASE l_suppkey % 4 WHEN 0 THEN 'KRW' WHEN 1 THEN 'HKD' WHEN 2 THEN 'USD' END AS currency, CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE CAST(CAST(max(l_shipdate) AS DATE) AS VARCHAR(10)) END AS period_end
        FROM {lineitem} GROUP BY 1, 2, 3, 4, 5, 6, 8""",
    "filings": """SELECT doc_id % 500 AS company_id, doc_id AS filing_id, source AS filing_type, CASE WHEN doc_id % 9 = 0 THEN NULL ELSE concat('2023-', lpad(CAST(1 + doc_id % 12 AS VARCHAR(2)), 2, '0'), '-', lpad(CAST(1 + doc_id % 28 AS VARCHAR(2)), 2, '0')) END AS filed_date, CAST(doc_id % 4 AS INT) AS n_urls, lang AS source FROM {documents}""",
    "filing_documents": """SELECT doc_id % 500 AS company_id, doc_id AS filing_id, lang AS source, CAST(0 AS INT) AS doc_seq, n_chars AS text_chars FROM {documents} WHERE doc_id % 3 > 0
        UNION ALL SELECT doc_id % 500, doc_id, lang, CAST(1 AS INT), CAST(0 AS BIGINT) FROM {documents} WHERE doc_id % 6 = 1""",
}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def base(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def standin(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = STANDINS[name]
    return spark.sql(text, **{t: base(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text})


def with_standins(sql: str) -> str:
    """DuckDB text of a query over stand-ins, each as a common table expression."""
    used: list[str] = []

    def visit(text: str) -> None:
        for n in STANDINS:
            if n not in used and re.search(rf"\b{n}\b", text):
                used.append(n)

    visit(sql)
    parts = [f"{n} AS ({STANDINS[n].format(**{t: t for t in TABLES})})" for n in used]
    head = "WITH " + ", ".join(parts) if parts else ""
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"{head}, {body[5:]}" if parts else body
    return f"{head} {body}"
