"""Queries over writes, entities, page geometry, evaluation and statistics, made from the driver's tables, with SQL for their rows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S
from ..operators import columns, entities, evaluation, geometry, signals, stats
from ..operators.upsert import replace_partition, with_ids
from ..sources import formats
from . import tables
from .catalogue import QUERIES, SQL, query
from .standins import base, standin

# -- writes ------------------------------------------------------------------------------------


def _n(expr: str, k: int) -> str:
    """An expression that is null for every k-th order."""
    return f"CASE WHEN o_orderkey % {k} = 0 THEN NULL ELSE {expr} END"


_TEXT = "CAST({} AS VARCHAR(20))"
_CUST, _ORD, _CLERK = _TEXT.format("o_custkey"), _TEXT.format("o_orderkey"), "o_orderpriority"
#: For each table its columns as expressions over orders that both engines read; the others are null.
WRITES: dict[str, dict[str, str]] = {
    "financials": {"company_id": "o_custkey % 50", "fiscal_year": "2000 + o_custkey % 3", "fiscal_period": "'FY'", "fs_scope": "'CFS'", "statement_type": "CASE WHEN o_custkey % 2 = 0 THEN 'IS' ELSE '' END", "account": "o_orderstatus", "account_local": _n(_CLERK, 3), "value": _n("o_totalprice", 4), "source": "'s'"},
    "filings": {"company_id": "o_custkey", "filing_id": "o_orderstatus", "filed_date": _n(_CLERK, 2), "doc_urls": _n(_ORD, 3), "source": "'s'"},
    "filing_documents": {"company_id": "o_custkey", "filing_id": "o_orderstatus", "source": "'s'", "doc_seq": "CAST(o_custkey % 2 AS INT)", "text_content": _n(_CLERK, 2), "text_chars": "o_orderkey"},
    "fx_rates": {"rate_date": _CLERK, "base_ccy": "o_orderstatus", "quote_ccy": "'USD'", "rate_type": "'spot'", "rate": "o_totalprice", "source": "'s'"},
    "statutes": {"law_id": _TEXT.format("o_custkey % 200"), "law_serial_no": "o_orderstatus", "name": _n(_CLERK, 2), "company_id": _n("o_custkey", 3), "articles_json": _n(_ORD, 5)},
    "statute_details": {"law_id": _TEXT.format("o_custkey % 200"), "law_serial_no": "o_orderstatus", "name": _n(_CLERK, 2), "department": _n(_ORD, 3), "raw_text": _n(_ORD, 4)},
    "statute_history": {"law_id": _TEXT.format("o_custkey % 200"), "law_serial_no": "o_orderstatus", "name": _CLERK, "status": _n(_ORD, 2)},
    "statute_translations": {"law_id": _TEXT.format("o_custkey % 200"), "law_serial_no": _n(_ORD, 2), "content_en": _n(_CLERK, 3)},
    "statute_comparisons": {"law_id": _TEXT.format("o_custkey % 200"), "mst": "'m'", "comparison_type": "o_orderstatus", "article_no": _CLERK, "old_text": _n(_ORD, 2), "new_text": _ORD},
    "law_api_raw": {"target": "o_orderstatus", "item_key": _TEXT.format("o_custkey % 200"), "title": _n(_CLERK, 2), "payload_json": _ORD},
    "companies": {"company_id": "o_custkey % 300", "name": _n(_CLERK, 2), "country": _n("o_orderstatus", 3), "lei": _n(_ORD, 5), "source": _ORD},
    "securities": {"security_id": "o_custkey", "company_id": "o_orderkey", "market": "o_orderstatus", "symbol": _CUST, "currency": _n(_CLERK, 2), "is_primary": "CAST(o_orderkey % 2 AS INT)", "source": _ORD},
    "identifier_xref": {"id_type": "o_orderstatus", "id_value": _CUST, "company_id": "o_orderkey", "source": _n(_CLERK, 2)},
    "ratios": {"company_id": "o_custkey", "fiscal_year": "2020", "fiscal_period": "'FY'", "metric": "o_orderstatus", "value": _n("o_totalprice", 2), "source": "'s'"},
    "run_log": {"run_id": "o_custkey", "started_at": _n(_CLERK, 2), "status": _n("o_orderstatus", 3), "rows_written": "o_orderkey"},
}


def _sides(name: str, source: str) -> tuple[str, str]:
    """SQL of the rows there (one a key) and of the rows to write."""
    t = tables.TABLES[name]
    exprs = ", ".join(f"{e} AS {c}" for c, e in WRITES[name].items())
    rows = f"SELECT {exprs}, o_orderkey AS _ord FROM {source}"
    first = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(t.keys)} ORDER BY _ord) AS _n FROM ({rows} WHERE o_orderkey % 5 < 2)) q WHERE _n = 1"
    return first, f"{rows} WHERE o_orderkey % 5 > 0"


def _write_sql(name: str) -> str:
    t = tables.TABLES[name]
    old, new = _sides(name, "orders")
    cols = list(WRITES[name])
    both = f"SELECT 0 AS side, {', '.join(cols)}, _ord FROM ({old}) UNION ALL SELECT 1, {', '.join(cols)}, _ord FROM ({new})"

    def one(c: str) -> str:
        rule = t.rules.get(c, "new") if t.policy == "update" else {"replace": "new", "ignore": "keep"}[t.policy]
        way, there = ("DESC" if rule in ("new", "coalesce_new_old") else "ASC"), (f" FILTER ({c} IS NOT NULL)" if rule.startswith("coalesce") else "")
        return f"(array_agg({c} ORDER BY side {way}, _ord {way}){there})[1] AS {c}"

    return f"SELECT {', '.join(t.keys)}, {', '.join(one(c) for c in cols if c not in t.keys)} FROM ({both}) GROUP BY {', '.join(t.keys)}"


def _register_write(name: str) -> None:
    def run(spark, d):
        orders = base(spark, d, "orders")
        old, new = (spark.sql(x, orders=orders) for x in _sides(name, "{orders}"))
        full = tables.create(spark, [name])[name].unionByName(old.drop("_ord", "_n"), allowMissingColumns=True)
        types = dict(tables.create(spark, [name])[name].dtypes)
        full = full.select(*(F.col(c).cast(t).alias(c) for c, t in types.items()))
        return tables.write(name, full, new).select(*WRITES[name])

    QUERIES[f"write_{name}"], SQL[f"write_{name}"] = run, _write_sql(name)


for _name in WRITES:
    _register_write(_name)


@query("""SELECT l_suppkey AS doc, CAST(l_linenumber AS INT) AS row_idx, max(l_orderkey) AS v FROM lineitem WHERE l_suppkey % 2 = 1 GROUP BY 1, 2 UNION ALL SELECT l_suppkey, CAST(0 AS INT), min(l_orderkey) FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1""")
def write_filing_cells(spark, d):
    li = base(spark, d, "lineitem").withColumnsRenamed({"l_suppkey": "doc", "l_linenumber": "row_idx"})
    old = li.groupBy("doc", F.col("row_idx").cast("int").alias("row_idx")).agg(F.max("l_orderkey").alias("v"))
    new = li.where("doc % 2 = 0").groupBy("doc").agg(F.min("l_orderkey").alias("v")).select("doc", F.lit(0).alias("row_idx"), "v")
    return replace_partition(old, new, ["doc"])


@query("""WITH f AS (SELECT o_orderkey, row_number() OVER (ORDER BY max(o_totalprice) DESC, o_orderkey) AS n FROM orders WHERE o_orderkey % 3 > 0 GROUP BY 1), t AS (SELECT coalesce(max(10 * o_orderkey), 0) AS top FROM orders WHERE o_orderkey % 3 = 0)
SELECT o.o_orderkey, CAST(CASE WHEN o.o_orderkey % 3 = 0 THEN 10 * o.o_orderkey ELSE top + n END AS BIGINT) AS id FROM orders o LEFT JOIN f USING (o_orderkey), t""")
def surrogate_ids(spark, d):
    o = base(spark, d, "orders").select("o_orderkey", "o_totalprice")
    old = o.where("o_orderkey % 3 = 0").select("o_orderkey", (10 * F.col("o_orderkey")).alias("id")).distinct()
    return with_ids(old, o.withColumn("_ord", -F.col("o_totalprice")), ["o_orderkey"], "id").select("o_orderkey", "id")


@query("""WITH r AS (SELECT s.company_id, CAST(s.security_id AS BIGINT) AS security_id, strftime(e.ts, '%Y-%m-%d') AS metric_date, e.value AS market_cap, row_number() OVER (PARTITION BY s.security_id, CAST(e.ts AS DATE) ORDER BY e.event_id DESC) AS n, count(*) OVER () AS written FROM events e JOIN securities s ON s.symbol = CAST(e.user_id AS VARCHAR) AND s.market = 'US')
SELECT security_id, metric_date, market_cap, written FROM r WHERE n = 1""")
def write_coverage_security(spark, d):
    rows = base(spark, d, "events").select(F.lit("US").alias("market"), F.col("user_id").cast("string").alias("symbol"), F.date_format("ts", "yyyy-MM-dd").alias("metric_date"), F.col("value").alias("market_cap"), F.lit("s").alias("source"), F.col("event_id").alias("_ord"))
    empty = tables.create(spark, ["daily_metrics"])["daily_metrics"]
    out, written = tables.write_coverage("daily_metrics", empty, rows, standin(spark, d, "securities"))
    return out.select("security_id", "metric_date", "market_cap").crossJoin(F.broadcast(written))


@query("SELECT CAST(c_custkey AS VARCHAR) AS law_id, CASE WHEN c_custkey = 7 THEN 99 ELSE c_nationkey END::BIGINT AS company_id FROM customer")
def statute_link(spark, d):
    rows = base(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("law_id"), F.col("c_nationkey").cast("bigint").alias("company_id"))
    return tables.link_statute(rows, "7", 99)


# -- entities ------------------------------------------------------------------------------------

_GROUP = "CASE WHEN {0} % 3 = 0 THEN 'L' || ({0} % 200) WHEN {0} % 3 = 1 THEN 'N' || ({0} % 90) || '|' || ({0} % 2) ELSE 'I' || {0} END"


@query(f"""WITH r AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 7 = 0 AND c_custkey > 0 THEN c_custkey - 1 ELSE c_custkey END AS own FROM customer), g AS (SELECT k, own, CASE WHEN k = 0 THEN 'alone' ELSE {_GROUP.format('own')} END AS g FROM r),
ids AS (SELECT g, row_number() OVER (ORDER BY g = 'alone', min(own)) AS company_id FROM g WHERE k % 7 <> 0 OR k = 0 GROUP BY g) SELECT 'S' || k AS symbol, CAST(company_id AS BIGINT) AS company_id FROM g JOIN ids USING (g)""")
def entity_resolution(spark, d):
    k = F.col("c_custkey")
    receipt = k % 7 == 0
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    rows = base(spark, d, "customer").select(
        F.lit("US").alias("market"), text("S", k).alias("symbol"), F.when(receipt, F.when(k % 2 == 0, "ADR").otherwise("GDR")).alias("security_type"),
        F.when(~receipt & (k % 3 == 0), text("L", k % 200)).alias("lei"), F.when(~receipt & (k % 3 == 2), text("I", k)).alias("isin"),
        F.when(k % 3 == 1, text("Name ", k % 90)).otherwise(text("Other ", k)).alias("name"), (k % 2).cast("string").alias("country"), F.when(receipt, text("US:S", k - 1)).alias("underlying_symbol"), k.alias("_ord"),
    )
    empty = tables.create(spark, ["companies", "identifier_xref", "securities"])
    return entities.resolve(rows, empty["companies"], empty["identifier_xref"], empty["securities"])[0].select("symbol", "company_id")


@query("""WITH m AS (SELECT c_custkey % 120 AS g, market, symbol, security_id, company_id, ord FROM (SELECT c_custkey, c_custkey AS ord FROM customer) c JOIN securities s ON s.security_id = c.c_custkey), t AS (SELECT g, arg_min(company_id, ord) AS target FROM m GROUP BY g)
SELECT s.security_id, coalesce(t.target, s.company_id) AS company_id FROM securities s LEFT JOIN m ON m.security_id = s.security_id LEFT JOIN t ON t.g = m.g""")
def link_overrides(spark, d):
    sec = standin(spark, d, "securities").withColumn("symbol", S.normalize_symbol(F.col("market"), F.col("symbol")))
    rows = sec.select((F.col("security_id") % 120).cast("string").alias("group"), F.lower("market").alias("market"), F.concat(F.lit(" "), "symbol").alias("symbol"), F.col("security_id").alias("_ord"))
    missing = rows.limit(0).unionByName(spark.createDataFrame([("g", "US", "none", 0), ("5", "KR", "999999", 0)], "group string, market string, symbol string, _ord long"))
    xref = tables.create(spark, ["identifier_xref"])["identifier_xref"]
    return entities.apply_overrides(entities.overrides_of(rows.unionByName(missing)), sec, xref)[0].select("security_id", "company_id")


@query("""SELECT 'KR' AS market, lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS symbol, 'KRW' AS currency, 'placeholder' AS source FROM supplier WHERE s_suppkey % 3 = 0""")
def master_placeholders(spark, d):
    k = F.col("s_suppkey")
    have = base(spark, d, "supplier").where("s_suppkey % 3 > 0").select(F.lit("KR").alias("market"), F.lpad(k.cast("string"), 6, "0").alias("symbol"))
    wanted = base(spark, d, "supplier").select(F.lit("KR").alias("market"), F.concat(k.cast("string"), F.lit(".KS")).alias("symbol"), k.alias("_ord"))
    return entities.missing_master(wanted, have).select("market", "symbol", "currency", "source")


@query("SELECT company_id, name, coalesce(lei, CASE WHEN company_id % 2 = 0 THEN 'F' || company_id END) AS lei FROM companies")
def lei_fill(spark, d):
    c = standin(spark, d, "companies")
    found = c.where("company_id % 2 = 0").select("company_id", F.concat(F.lit("F"), F.col("company_id").cast("string")).alias("lei"))
    xref = tables.create(spark, ["identifier_xref"])["identifier_xref"]
    return entities.fill_leis(c, xref, found)[0].select("company_id", "name", "lei")


@query("""SELECT DISTINCT a.company_id, b.company_id AS peer_company_id FROM securities a JOIN securities b ON b.market = a.market AND b.security_id = a.security_id + 3 WHERE a.company_id <> b.company_id""")
def peer_edges(spark, d):
    sec = standin(spark, d, "securities").withColumn("symbol", S.normalize_symbol(F.col("market"), F.col("symbol")))
    pairs = sec.select("market", "symbol", F.explode(F.array(*[(F.col("security_id") + 3).cast("string")] * 2)).alias("peer"))
    return entities.peer_edges(pairs, sec)


@query("""SELECT security_id, company_id, row_number() OVER (PARTITION BY company_id ORDER BY is_primary DESC, security_id) AS rank FROM securities""")
def listing_rank(spark, d):
    return entities.linked_rank(standin(spark, d, "securities")).select("security_id", "company_id", "rank")


# -- page geometry ---------------------------------------------------------------------------------


def _table_pages(spark, d):
    """A document for each customer, with a page for each order and on it a table that may start high or end low; some pages have none, some an empty grid."""
    o = base(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), "o_orderkey", "o_orderpriority")
    o = o.withColumn("page_no", F.row_number().over(Window.partitionBy("doc_id").orderBy("o_orderkey")))
    k = F.col("o_orderkey")
    rows = F.array(F.array(F.lit("head"), F.lit("value")), F.array(F.col("o_orderpriority"), k.cast("string")))
    grid = F.when(k % 11 == 0, F.array(F.array(F.lit(""), F.lit(" ")))).otherwise(rows)
    box = F.array(F.lit(0.0), F.when(k % 3 > 0, 40.0).otherwise(300.0), F.lit(100.0), F.when(k % 5 > 0, 780.0).otherwise(500.0))
    table = F.struct(box.alias("bbox"), F.array(F.lit(10.0), F.lit(50.0)).alias("col_x"), grid.alias("rows"), F.lit("").alias("source_engine"), F.when(k % 2 == 0, 0.0).alias("structure_confidence"))
    none = F.array().cast(T.ArrayType(geometry.TABLE))
    return o.select("doc_id", "page_no", F.lit(800.0).alias("height"), F.when(k % 13 == 0, none).otherwise(F.array(table)).alias("tables"))


@query("""WITH p AS (SELECT o_custkey AS doc_id, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS page_no, sum((o_orderkey % 13 = 0)::INT) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS bare FROM orders),
t AS (SELECT *, lag(k % 5 > 0) OVER w AS low, lag(bare) OVER w AS was FROM p WHERE k % 13 <> 0 AND k % 11 <> 0 WINDOW w AS (PARTITION BY doc_id ORDER BY page_no)),
r AS (SELECT *, sum(CASE WHEN k % 3 > 0 AND low AND was = bare THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY page_no) AS run FROM t)
SELECT doc_id, CAST(run - 1 AS INT) AS table_seq, CAST(min(page_no) AS INT) AS page_start, CAST(max(page_no) AS INT) AS page_end, CAST(count(*) + 1 AS INT) AS n_rows, CASE WHEN arg_min(k, page_no) % 2 = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS structure_confidence FROM r GROUP BY doc_id, run""")
def stitched_tables(spark, d):
    return geometry.stitch(_table_pages(spark, d)).select("doc_id", "table_seq", F.col("page_start").cast("int").alias("page_start"), F.col("page_end").cast("int").alias("page_end"), F.size("rows").alias("n_rows"), "structure_confidence")


def _text_pages(spark, d):
    """Pages of conversations: a running head, the turn's text, a page number at the foot."""
    c = base(spark, d, "conversations").select(F.col("conv_id").alias("doc_id"), (F.col("turn") + 1).cast("int").alias("page_no"), F.regexp_replace("text", r"\s+", " ").alias("t"))
    n = F.col("page_no").cast("string")
    line = lambda text, top: F.struct(text.alias("text"), F.lit(0.0).alias("x0"), F.lit(100.0).alias("x1"), F.lit(top).alias("top"), F.lit(top + 10).alias("bottom"))
    return c.select("doc_id", "page_no", F.lit(800.0).alias("height"), F.array(line(F.concat(F.lit("Report "), n), 10.0), line(F.col("t"), 400.0), line(F.concat(F.lit("- Page "), n, F.lit(" of 9 -")), 780.0)).alias("lines"))


_CONVERSATION = """c AS (SELECT conv_id AS doc_id, turn + 1 AS page_no, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS t, count(*) OVER (PARTITION BY conv_id) AS pages FROM conversations),
l AS (SELECT doc_id, page_no, 0 AS pl, 'Report ' || page_no AS t FROM c WHERE pages < 3 UNION ALL SELECT doc_id, page_no, 1, t FROM c WHERE t <> '')"""


@query(f"""WITH {_CONVERSATION}, p AS (SELECT *, coalesce(sum(regexp_matches(t, '[.!?…。！？」』）)]$')::INT) OVER (PARTITION BY doc_id ORDER BY page_no, pl ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS para FROM l),
q AS (SELECT doc_id, para, string_agg(t, ' ' ORDER BY page_no, pl) AS t FROM p GROUP BY 1, 2) SELECT doc_id, string_agg(t, chr(10) || chr(10) ORDER BY para) AS text FROM q GROUP BY 1""")
def reflowed_text(spark, d):
    return geometry.reflow(_text_pages(spark, d))


@query("""SELECT conv_id AS doc_id, k.key FROM (SELECT conv_id FROM conversations GROUP BY 1 HAVING count(*) >= 3), (SELECT unnest(['report #', '- page # of # -']) AS key) k""")
def running_heads(spark, d):
    pages = _text_pages(spark, d)
    counted = pages.withColumn("pages", F.count(F.lit(1)).over(Window.partitionBy("doc_id")))
    lines = counted.select("doc_id", "height", "pages", F.explode("lines").alias("l")).select("doc_id", "height", "pages", F.col("l.top").alias("top"), S.line_key(F.col("l.text")).alias("key"))
    return geometry.furniture(lines, "doc_id")


def _customer_rows(spark, d):
    """Customers as rows of pages of twenty keys: page, key, and place on the page from 1."""
    page = F.floor(F.col("c_custkey") / 20).alias("page")
    return base(spark, d, "customer").select(page, F.col("c_custkey").alias("k"), "c_name").withColumn("r", F.row_number().over(Window.partitionBy("page").orderBy("k")))


_CUSTOMER_ROWS = "w AS (SELECT c_custkey // 20 AS page, c_custkey AS k, c_name AS name, row_number() OVER (PARTITION BY c_custkey // 20 ORDER BY c_custkey) AS r, count(*) OVER (PARTITION BY c_custkey // 20) AS n FROM customer)"
_WORDS = ["page", "ord", "text", "x0", "x1", "top", "bottom"]


def _words(rows, at: int, text, x: float, step: float, width: float, y):
    """Rows' words (page, ord, text and box) from ``x`` on, ``step`` apart; the place of a row's words begins at ``at``."""
    split = rows.select("page", y.alias("top"), F.posexplode(F.split(text, " ")).alias("i", "text"))
    left = x + step * F.col("i")
    return split.select("page", (at + F.col("top") * 100 + F.col("i")).cast("int").alias("ord"), "text", left.alias("x0"), (left + (F.lit(width) if width else 6.0 * F.length("text"))).alias("x1"), "top", (F.col("top") + 10).alias("bottom"))


@query(f"""WITH {_CUSTOMER_ROWS} SELECT page, CAST(r - 1 AS INT) AS row_idx, c.c AS col_idx, CASE c.c WHEN 0 THEN replace(name, ' ', '_') WHEN 1 THEN CAST(k AS VARCHAR) ELSE CAST(k * 7 AS VARCHAR) END AS text FROM w, (SELECT unnest([0, 1, 2])::INT AS c) c WHERE n >= 4""")
def borderless_tables(spark, d):
    rows, y = _customer_rows(spark, d), 20.0 * F.col("r")
    cells = [_words(rows, 10 * i, text, 50.0 + 200 * i, 0.0, 0.0, y) for i, text in enumerate((F.replace("c_name", F.lit(" "), F.lit("_")), F.col("k").cast("string"), (F.col("k") * 7).cast("string")))]
    found = columns.column_tables(cells[0].unionByName(cells[1]).unionByName(cells[2]), ["page"])
    return geometry.table_cells(found.select("page", F.explode("tables").alias("t")).select("page", F.col("t.rows").alias("rows")))


@query(f"""WITH {_CUSTOMER_ROWS} SELECT page, CAST(0 AS INT) AS at, 'a heading over both columns of page ' || page AS text FROM (SELECT DISTINCT page FROM w WHERE n >= 2) UNION ALL SELECT page, CAST(r AS INT), 'left words of row ' || k FROM w WHERE n >= 2 UNION ALL SELECT page, CAST(n + r AS INT), 'right words of row ' || k FROM w WHERE n >= 2""")
def two_column_lines(spark, d):
    rows, k = _customer_rows(spark, d), F.col("k").cast("string")
    text = lambda side: F.concat(F.lit(f"{side} words of row "), k)
    body = _words(rows, 0, text("left"), 50.0, 30.0, 28.0, 20.0 * F.col("r")).unionByName(_words(rows, 50, text("right"), 300.0, 30.0, 28.0, 20.0 * F.col("r")))
    head = _words(rows.select("page").distinct(), 0, F.concat(F.lit("a heading over both columns of page "), F.col("page").cast("string")), 120.0, 30.0, 28.0, F.lit(5.0))
    out = columns.column_lines(body.unionByName(head), ["page"])
    return out.select("page", F.posexplode("lines").alias("at", "l")).select("page", "at", F.col("l.text").alias("text"))


@query(f"""WITH {_CUSTOMER_ROWS}, l AS (SELECT page, n, 0 AS r, 0 AS side, 'head' AS text FROM w WHERE r = 1 UNION ALL SELECT page, n, r, 1, 'left ' || k FROM w UNION ALL SELECT page, n, r, 2, 'right ' || k FROM w)
SELECT page, CAST(row_number() OVER (PARTITION BY page ORDER BY r > 0, CASE WHEN n >= 3 THEN side ELSE r END, CASE WHEN n >= 3 THEN r ELSE side END) - 1 AS INT) AS at, text FROM l""")
def column_reading_order(spark, d):
    rows = _customer_rows(spark, d)
    line = lambda text, x0, x1, y: F.struct(text.alias("text"), F.lit(x0).alias("x0"), F.lit(x1).alias("x1"), y.alias("top"), (y + 10.0).alias("bottom"))
    y, k = 20.0 * F.col("r"), F.col("k").cast("string")
    both = F.array(line(F.concat(F.lit("left "), k), 0.0, 200.0, y), line(F.concat(F.lit("right "), k), 300.0, 500.0, y))
    pages = rows.groupBy("page").agg(F.flatten(F.collect_list(both)).alias("body")).select("page", F.concat("body", F.array(line(F.lit("head"), 0.0, 500.0, F.lit(2.0)))).alias("lines"))
    return pages.select("page", "lines", F.posexplode(geometry.reading_order("lines")).alias("at", "i")).select("page", "at", F.get("lines", F.col("i"))["text"].alias("text"))


@query("""SELECT o_orderkey, CASE WHEN abs(o_totalprice - 1000) <= abs(o_totalprice - 100000) AND abs(o_totalprice - 1000) <= abs(o_totalprice - 300000) THEN 0 WHEN abs(o_totalprice - 100000) <= abs(o_totalprice - 300000) THEN 1 ELSE 2 END::INT AS column_at FROM orders""")
def nearest_columns(spark, d):
    return base(spark, d, "orders").select("o_orderkey", columns.nearest_column(F.col("o_totalprice"), F.array(F.lit(1000.0), F.lit(100000.0), F.lit(300000.0))).alias("column_at"))


@query("""SELECT p_partkey, regexp_matches(t, '^\\(?-?\\d[\\d,.\\s]*\\)?%?$') AS number FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN '(' || p_size || ',000.5)' WHEN 1 THEN p_size || '%' WHEN 2 THEN p_name ELSE '-' || p_size || ' x' END AS t FROM part)""")
def numeric_cells(spark, d):
    size = F.col("p_size").cast("string")
    text = F.when(F.col("p_size") % 4 == 0, F.concat(F.lit("("), size, F.lit(",000.5)"))).when(F.col("p_size") % 4 == 1, F.concat(size, F.lit("%"))).when(F.col("p_size") % 4 == 2, F.col("p_name")).otherwise(F.concat(F.lit("-"), size, F.lit(" x")))
    return base(spark, d, "part").select("p_partkey", S.is_numeric(text).alias("number"))


@query("""SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 0.5::DOUBLE WHEN s_suppkey % 2 = 0 THEN 0.25::DOUBLE ELSE 1.0::DOUBLE END AS confidence, s_suppkey % 3 = 0 OR s_suppkey % 2 = 0 AS needs_review FROM supplier""")
def table_confidence(spark, d):
    k = F.col("s_suppkey")
    rows = F.array(F.array(F.lit("value"), (k + 1000).cast("string")), F.array(F.lit("other"), F.when(k % 3 == 0, "99999999").otherwise("12")))
    t = base(spark, d, "supplier").select("s_suppkey", rows.alias("rows"), F.when((k % 3 > 0) & (k % 2 == 0), 0.25).otherwise(1.0).alias("structure_confidence"), F.lit(1).alias("page_start"), F.lit(2).alias("page_end"), F.concat(F.lit("12 and "), (k + 1000).cast("string")).alias("raw"))
    return geometry.escalated(geometry.confidence(t, F.col("raw")), F.col("raw"), F.col("raw")).select("s_suppkey", "confidence", "needs_review")


@query("""SELECT s_suppkey, s_suppkey % 3 = 0 AS escalated, CASE WHEN s_suppkey % 3 = 0 THEN 0.06 ELSE 0 END::DOUBLE AS est_cost, CASE WHEN s_suppkey % 6 = 0 THEN 'engine' ELSE 'own' END AS source_engine, s_suppkey % 3 = 0 AND s_suppkey % 6 <> 0 AS needs_review FROM supplier""")
def table_escalation(spark, d):
    k = F.col("s_suppkey")
    rows = F.array(F.array(F.lit("a"), F.when(k % 3 == 0, "77777").otherwise("12")))
    t = base(spark, d, "supplier").select("s_suppkey", rows.alias("rows"), F.lit(1.0).alias("structure_confidence"), F.lit(2).alias("page_start"), F.lit(4).alias("page_end"), F.lit("own").alias("source_engine"), F.lit("12").alias("raw"))
    engine = lambda r, context: F.when(k % 6 == 0, F.array(F.array(F.lit("a"), context)))
    return geometry.escalated(geometry.confidence(t, F.col("raw")), F.col("raw"), F.col("raw"), cost_per_page=0.02, engine=engine, name="engine").select("s_suppkey", "escalated", F.round("est_cost", 4).alias("est_cost"), "source_engine", "needs_review")


@query("""SELECT o_custkey AS doc_id, o_orderkey AS page_no, CASE WHEN o_orderkey % 2 = 0 THEN 'own' WHEN o_orderkey % 3 = 0 THEN 'other' END AS engine FROM orders""")
def filled_pages(spark, d):
    o = base(spark, d, "orders").select(F.col("o_custkey").alias("doc_id"), F.col("o_orderkey").alias("page_no"))
    none = F.array().cast("array<string>")
    pages = o.withColumn("tables", F.when(F.col("page_no") % 2 == 0, F.array(F.lit("own"))).otherwise(none))
    others = o.where("page_no % 3 = 0").withColumn("tables", F.array(F.lit("other")))
    return columns.filled_tables(pages, others).select("doc_id", "page_no", F.get("tables", F.lit(0)).alias("engine"))


@query("""SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN 'pdf' WHEN 1 THEN 'zip' WHEN 2 THEN 'gzip' WHEN 3 THEN 'xml' WHEN 4 THEN 'html' WHEN 5 THEN 'ole' END AS format FROM orders""")
def sniffed_formats(spark, d):
    heads = [b"%PDF-1.7", b"PK\x05\x06" + bytes(18), b"\x1f\x8b\x08", b"  \n<?xml version='1.0'?>", b"<!DOCTYPE html>", bytes.fromhex("D0CF11E0A1B11AE1"), b"plain"]
    content = F.concat(F.element_at(F.array(*map(F.lit, heads)), (F.col("o_orderkey") % 7 + 1).cast("int")), F.when(F.col("o_orderkey") % 7 == 1, F.lit(b"")).otherwise(F.col("o_orderpriority").cast("binary")))
    return base(spark, d, "orders").select("o_orderkey", formats.sniffed(content).alias("format"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS share FROM orders""")
def grounding_share(spark, d):
    k = F.col("o_orderkey")
    number = F.format_number(k + 1000, 0)
    rows = F.when(k % 4 == 0, F.array(F.array(F.lit("a"), number), F.array(F.lit("b 7"), F.lit("56.7%")))).when(k % 4 == 1, F.array(F.array(number, F.lit("(987,654,321)")))).when(k % 4 == 2, F.array(F.array(F.lit("none"), F.lit("5")))).otherwise(F.array(F.array(F.lit("-987654321"), F.lit(None).cast("string"))))
    raw = F.concat(F.lit("total 56.7 of "), (k + 1000).cast("string"))
    return base(spark, d, "orders").select("o_orderkey", geometry.ground_numbers(rows, raw).alias("share"))


@query("""SELECT p_partkey, p_size % 20 < 13 AND p_size % 3 < 2 AS matches, p_size % 5 = 0 AS empty FROM part""")
def column_signatures(spark, d):
    k = F.col("p_size")
    x = F.col("p_retailprice")
    a = F.array(x, x + 50, x + 90)
    b = F.when(k % 3 == 0, F.array(x + k % 20, x + 50)).when(k % 3 == 1, F.array(x - k % 20, x + 50, x + 90, x + 500)).otherwise(F.array(x))
    rows = F.when(k % 5 == 0, F.when(k % 2 == 0, F.array(F.array(F.lit(" "), F.lit("x")), F.array(F.lit(None).cast("string"), F.lit("")))).otherwise(F.array(*[F.array(*[F.lit("x" if i == j == 0 or (i == 1 and j == 1) else "") for j in range(7)]) for i in range(3)]))).otherwise(F.array(F.array(F.lit("a"), F.lit("b"))))
    return base(spark, d, "part").select("p_partkey", geometry.same_columns(a, b).alias("matches"), geometry.too_empty(rows).alias("empty"))


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 2 * 2.0 / 5 WHEN 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS f1 FROM orders""")
def numeric_f1(spark, d):
    from ..operators.metrics import numeric_f1 as f1

    k = F.col("o_orderkey")
    n = F.format_number(k + 100000, 0)
    pred = F.when(k % 4 == 0, F.array(F.array(n, F.lit("x")))).when(k % 4 == 1, F.array(F.array(F.lit("5 and 5"), n))).when(k % 4 == 2, F.array(F.array(F.lit("none")))).otherwise(F.array(F.array(F.lit("none"))))
    gold = F.when(k % 4 == 0, F.array(F.array((k + 100000).cast("string")))).when(k % 4 == 1, F.array(F.array(F.lit("5"), n))).when(k % 4 == 2, F.array(F.array(F.lit("")))).otherwise(F.array(F.array(n)))
    return base(spark, d, "orders").select("o_orderkey", f1(pred, gold).alias("f1"))


@query("""SELECT o_orderkey, printf('%+d', CAST(round_even((o_totalprice - 100000) / 100000 * 100, 0) AS INT)) AS change FROM orders""")
def split_percent(spark, d):
    return base(spark, d, "orders").select("o_orderkey", F.regexp_replace(signals.change(F.col("o_totalprice"), F.lit(100000.0)), "^-0$", "+0").alias("change"))


# -- evaluation ---------------------------------------------------------------------------------------


def _cases(spark, d):
    """A case for each supplier: gold of three rows of two cells; the better of two predictions has as many cells changed as the key says, 0 to 2."""
    k = F.col("s_suppkey")
    gold = F.array(F.array(F.lit("h1"), F.lit("h2")), F.array(F.col("s_name"), F.lit("1")), F.array(F.lit("b"), F.lit("2")))
    near = F.array(F.array(F.lit("H1"), F.lit(" h2 ")), F.array(F.col("s_name"), F.when(k % 3 > 0, "7").otherwise("1")), F.array(F.lit("b"), F.when(k % 3 > 1, "9").otherwise("2")))
    far = F.array(F.array(F.lit("zz"), F.lit("zz")))
    return base(spark, d, "supplier").select(F.col("s_name").alias("name"), (k % 4).cast("string").alias("category"), F.concat(F.lit("One  para.\n \nTwo "), F.col("s_name"), F.lit(" lines.")).alias("text"), F.when(k % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("one para."), F.when(k % 2 == 0, F.concat(F.lit("two "), F.col("s_name"))).otherwise("para. two"))).alias("paragraphs"), F.when(k % 7 == 0, F.array().cast("array<array<array<string>>>")).otherwise(F.array(far, near, far)).alias("pred"), F.array(gold).alias("gold"))


_SCORES = """s AS (SELECT s_suppkey AS k, s_name AS name, CAST(s_suppkey % 4 AS VARCHAR) AS category, CASE WHEN s_suppkey % 7 = 0 THEN 1 - 9 / 10.0 ELSE 1 - (s_suppkey % 3) / 10.0 END::DOUBLE AS teds, CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE 2.0 * (6 - s_suppkey % 3) / 12 END::DOUBLE AS grits,
CASE WHEN s_suppkey % 7 = 0 THEN 0 ELSE 1 - (s_suppkey % 3) / n END::DOUBLE AS numeric_em, CASE WHEN s_suppkey % 5 = 0 THEN NULL WHEN s_suppkey % 2 = 0 THEN 1.0 ELSE 0.5 END::DOUBLE AS continuity FROM (SELECT *, 5.0 AS n FROM supplier))"""


@query(f"WITH {_SCORES} SELECT name, category, round(teds, 6) AS teds, round(grits, 6) AS grits, round(numeric_em, 6) AS numeric_em, continuity FROM s")
def case_scores(spark, d):
    out = evaluation.score_cases(_cases(spark, d))
    return out.select("name", "category", *(F.round(c, 6).alias(c) for c in ("teds", "grits", "numeric_em")), "continuity")


@query(f"""WITH {_SCORES} SELECT category, round(avg(teds), 4) AS teds, round(avg(grits), 4) AS grits, round(avg(numeric_em), 4) AS numeric_em, round(avg(continuity), 4) AS continuity, count(*) AS n_cases FROM s GROUP BY 1
UNION ALL SELECT 'overall', round(avg(teds), 4), round(avg(grits), 4), round(avg(numeric_em), 4), round(avg(continuity), 4), count(*) FROM s""")
def evaluation_report(spark, d):
    return evaluation.roll_up(evaluation.score_cases(_cases(spark, d)))


@query("""WITH t AS (SELECT conv_id, turn, list_transform(string_split_regex(text, '\\n\\s*\\n'), lambda x: lower(trim(regexp_replace(x, '\\s+', ' ', 'g')))) AS mine, lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS a, 'absent here' AS b FROM conversations WHERE text IS NOT NULL)
SELECT conv_id, turn, (len(list_filter(mine, lambda x: contains(x, a))) > 0)::INT / 2 + (len(list_filter(mine, lambda x: contains(x, b))) > 0)::INT / 2 AS share FROM t""")
def paragraphs_recovered(spark, d):
    gold = F.array("text", F.lit("Absent  here"))
    return base(spark, d, "conversations").where("text is not null").select("conv_id", "turn", evaluation.continuity(F.col("text"), gold).alias("share"))


# -- statistics, dates, files ------------------------------------------------------------------------------


@query("""SELECT o_custkey, mode, n / total AS share FROM (SELECT o_custkey, o_orderpriority AS mode, count(*) AS n, sum(count(*)) OVER (PARTITION BY o_custkey) AS total, row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, min(o_orderkey)) AS r FROM orders GROUP BY 1, 2) WHERE r = 1""")
def modal_value(spark, d):
    return stats.first_mode(base(spark, d, "orders"), ["o_custkey"], "o_orderpriority", "o_orderkey")


@query("SELECT l_suppkey, median(l_quantity) AS height, median(l_extendedprice / l_quantity) AS width FROM lineitem GROUP BY 1")
def median_sizes(spark, d):
    return base(spark, d, "lineitem").groupBy("l_suppkey").agg(stats.exact_median(F.col("l_quantity")).alias("height"), stats.exact_median(F.col("l_extendedprice") / F.col("l_quantity")).alias("width"))


@query("SELECT currency, min(coalesce(period_end, printf('%04d-12-31', fiscal_year))) AS first_day, max(coalesce(period_end, printf('%04d-12-31', fiscal_year))) AS last_day FROM financials GROUP BY 1")
def fx_span(spark, d):
    rows = standin(spark, d, "financials").withColumn("day", F.coalesce("period_end", S.year_end(F.col("fiscal_year"))))
    return stats.span(rows, ["currency"], "day")


@query("""WITH f AS (SELECT user_id, event_id, value > 30 AS flag, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS a FROM events), i AS (SELECT *, a - row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM f WHERE flag)
SELECT user_id, min(event_id) AS first_at, max(event_id) AS last_at, count(*) AS length FROM i GROUP BY user_id, g""")
def aligned_islands(spark, d):
    return stats.islands(base(spark, d, "events"), ["user_id"], "event_id", F.col("value") > 30)


@query("""SELECT c_nationkey, string_agg('BodyText/Section' || c_custkey, ',' ORDER BY c_custkey) AS names FROM customer GROUP BY 1""")
def numbered_sections(spark, d):
    names = F.collect_list(F.concat(F.lit("BodyText/Section"), F.col("c_custkey").cast("string")))
    return base(spark, d, "customer").groupBy("c_nationkey").agg(F.array_join(stats.by_number(names), ",").alias("names"))


@query("""SELECT o_custkey, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY coalesce(CASE WHEN o_orderkey % 4 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END, ''), o_orderkey) AS keys FROM orders GROUP BY 1""")
def undated_first(spark, d):
    rows = base(spark, d, "orders").withColumn("day", F.when(F.col("o_orderkey") % 4 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")))
    return rows.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(stats.stable_place("day", "o_orderkey"))), lambda x: x["o_orderkey"].cast("string")), ",").alias("keys"))


@query("""SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS slashed, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day_first, strftime(o_orderdate, '%Y-%m-%d') AS range_end, strftime(CAST(o_orderdate AS DATE) - INTERVAL 2 YEAR, '%Y-%m-%d') AS years_before, 1 / o_totalprice AS inverse FROM orders""")
def feed_dates(spark, d):
    at = F.col("o_orderdate")
    first = F.when(F.col("o_orderkey") % 3 == 0, "31/31/2020 10:00").otherwise(F.date_format(at, "dd/MM/yyyy HH:mm"))
    ranged = F.concat(F.lit("1990.01.01 ~ "), F.date_format(at, "yyyy.MM.dd"))
    return base(spark, d, "orders").select("o_orderkey", S.month_day_year(F.date_format(at, "M/d/yyyy")).alias("slashed"), S.day_first(first).alias("day_first"), S.period_end(ranged).alias("range_end"), S.years_before(F.date_format(at, "yyyy-MM-dd"), 2).alias("years_before"), S.inverse(F.col("o_totalprice")).alias("inverse"))


@query("""SELECT p_partkey, CAST(CASE WHEN p_size % 2 = 0 THEN 2 ELSE 0 END AS INT) AS n_urls, CASE WHEN p_size % 3 > 0 THEN p_name END AS reply FROM part""")
def json_replies(spark, d):
    urls = F.when(F.col("p_size") % 2 == 0, '["a","b"]').otherwise("not json")
    reply = F.when(F.col("p_size") % 3 > 0, F.concat(F.lit("Sure!\n```json\n"), F.to_json(F.struct(F.col("p_name").alias("v"), F.struct(F.lit(1).alias("x")).alias("in"))), F.lit("\n``` ok"))).otherwise("no object")
    return base(spark, d, "part").select("p_partkey", F.size(S.json_strings(urls)).alias("n_urls"), S.reply_json(reply, "v string")["v"].alias("reply"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'pdf' WHEN 1 THEN 'zip' WHEN 2 THEN 'xml' WHEN 3 THEN 'html' WHEN 4 THEN 'txt' ELSE 'html' END AS format, CASE o_orderkey % 6 WHEN 0 THEN 'f' || o_orderkey || '.pdf' WHEN 1 THEN 'document.zip' WHEN 2 THEN 'a b.xml' WHEN 3 THEN 'x.htm.html' WHEN 4 THEN 'doc3.txt' ELSE 'doc3.html' END AS name FROM orders""".replace("'x.htm.html'", "'x.htm'"))
def document_names(spark, d):
    k = F.col("o_orderkey")
    pick = lambda *x: F.element_at(F.array(*x), (k % 6 + 1).cast("int"))
    url = F.concat(F.lit("https://h.example/"), pick(F.concat(F.lit("f"), k.cast("string"), F.lit(".pdf")), F.lit("document.xml"), F.lit("d/a%20b.xml"), F.lit("x.htm?q=1"), F.lit("plain"), F.lit("")))
    kind = pick(F.lit(None), F.lit("application/octet-stream"), F.lit(None), F.lit(None), F.lit("text/plain; charset=x"), F.lit(None))
    content = pick(F.lit(None).cast("binary"), F.lit(b"PK\x05\x06" + bytes(18)), *[F.lit(None).cast("binary")] * 4)
    rows = base(spark, d, "orders").select("o_orderkey", url.alias("url"), formats.format_of(url, kind, content).alias("format"))
    return rows.select("o_orderkey", "format", formats.file_name(F.col("url"), F.lit(3), F.col("format")).alias("name"))


@query("""SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'agent' ELSE 'browser' END AS agent, CASE WHEN page_id % 3 = 1 THEN 'https://www1.hkexnews.hk/' END AS referer FROM pages""")
def request_headers(spark, d):
    k = F.col("page_id")
    url = F.when(k % 3 == 0, "https://www.SEC.gov/x").when(k % 3 == 1, "https://www1.hkexnews.hk/y").otherwise(F.col("url"))
    headers = formats.request_headers(url, "agent", "browser")
    return base(spark, d, "pages").select("page_id", F.element_at(headers, "User-Agent").alias("agent"), F.try_element_at(headers, F.lit("Referer")).alias("referer"))


@query("""SELECT source, min(doc_id) AS doc_id FROM documents WHERE contains(lower(text), 'license') GROUP BY 1""")
def earliest_match(spark, d):
    return signals.first_matches(base(spark, d, "documents"), ["source"], F.contains(F.lower("text"), F.lit("license")), ["doc_id"]).select("source", "doc_id")


@query("""SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY lower(o_orderpriority), printf('%.2f', floor(o_totalprice / 1000)) ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1""")
def first_disclosures(spark, d):
    keys = [F.lower("o_orderpriority"), F.format_string("%.2f", F.floor(F.col("o_totalprice") / 1000).cast("double"))]
    return signals.first_occurrences(base(spark, d, "orders"), keys, ["o_orderdate", "o_orderkey"]).select("o_orderkey")


@query("""WITH g AS (SELECT o_custkey, min(strftime(o_orderdate, '%Y-%m-%d')) FILTER (o_orderstatus = 'F') AS first_draft, min(strftime(o_orderdate, '%Y-%m-%d')) FILTER (o_orderstatus <> 'F') AS first_public, count(*) FILTER (o_orderstatus = 'F') AS drafts FROM orders GROUP BY 1)
SELECT *, date_diff('day', first_draft::DATE, first_public::DATE)::INT AS gap_days FROM g WHERE first_draft <= first_public""")
def review_gaps(spark, d):
    return signals.review_gaps(base(spark, d, "orders"), "o_custkey", F.col("o_orderstatus"), F.date_format("o_orderdate", "yyyy-MM-dd"), ["F"], ["O", "P"])


@query("""SELECT o_orderkey FROM orders WHERE o_orderkey % 4 > 0 AND (contains(lower(o_orderpriority), 'urgent') OR contains(lower(o_orderpriority), 'low'))""")
def types_wanted(spark, d):
    rows = base(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 > 0, F.col("o_orderpriority")).alias("t"))
    return signals.type_filter(signals.type_filter(rows, "t", ["URGENT", "low"]), "t", []).select("o_orderkey")
