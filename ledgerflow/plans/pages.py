"""Queries over recognised pages, detected grids, escalation, archives, saved files, landed feeds, peers and reviews, with SQL for their rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import entities, escalation, grid, ocr, signals
from ..operators.storage import shared_folder, written
from ..sources import archives, sinks
from ..streaming import landing
from . import tables, views
from .catalogue import query
from .standins import base, standin


def _folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


# -- pages ----------------------------------------------------------------------------


@query("""WITH p AS (SELECT coalesce(source, 'none') AS doc_id, doc_id AS page_no, coalesce(text, '') AS t, doc_id % 2 = 0 AS bare FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, bare ORDER BY page_no) AS n FROM p),
l AS (SELECT doc_id, page_no, bare, CASE WHEN NOT bare THEN [t] WHEN n > 50 THEN [] ELSE [x for x in [trim(y, ' ' || chr(9) || chr(13)) for y in string_split(t, chr(10))] if x <> ''] END AS l FROM r)
SELECT doc_id, page_no, len(l)::INT AS n_lines, md5(array_to_string(l, chr(10))) AS digest, CASE WHEN len(l) = 0 THEN NULL WHEN bare THEN 800.0 / len(l) ELSE 12.0 END::DOUBLE AS first_bottom FROM l""")
def recognised_pages(spark, d):
    docs = base(spark, d, "documents").select(F.coalesce("source", F.lit("none")).alias("doc_id"), F.col("doc_id").alias("page_no"), F.coalesce("text", F.lit("")).alias("image"))
    line = F.struct(F.col("image").alias("text"), F.lit(0.0).alias("x0"), F.lit(600.0).alias("x1"), F.lit(0.0).alias("top"), F.lit(12.0).alias("bottom"))
    pages = docs.withColumns({"height": F.lit(800.0), "width": F.lit(600.0), "lines": F.when(F.col("page_no") % 2 > 0, F.array(line))})
    out = ocr.recognised(pages, lambda p: p.select("doc_id", "page_no", F.col("image").alias("text")))
    text = F.array_join(F.transform("lines", lambda x: x["text"]), "\n")
    return out.select("doc_id", "page_no", F.size("lines").alias("n_lines"), F.md5(text.cast("binary")).alias("digest"), F.get("lines", F.lit(0))["bottom"].alias("first_bottom"))


@query("""WITH r AS (SELECT o_custkey AS doc_id, o_orderkey AS k, o_orderpriority AS p FROM orders), w AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS n FROM r WHERE k % 7 > 0)
SELECT doc_id, CAST(n - 1 AS INT) AS row_idx, p || ' x' || k AS label, CASE WHEN k % 5 > 0 THEN CAST(k AS VARCHAR) ELSE '' END AS amount, 'y' || (k % 3) AS mark FROM w""")
def filled_grids(spark, d):
    k = F.col("o_orderkey")
    nth = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    # dealt in a number that stays: a page's words take many times the room of its orders, by which partitions would be merged
    orders = base(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "o_custkey")
    o = orders.withColumn("r", nth)
    # an image at twice the page's size; rows of 15 points every 20, columns at 50-150, 250-300 and 400-450
    box = F.array(*map(F.lit, (100.0, 200.0, 1000.0, 100000.0)))
    row = F.array(F.lit(0.0), 40.0 * F.col("r"), F.lit(900.0), 40.0 * F.col("r") + 30)
    cols = F.array(*(F.array(F.lit(a), F.lit(0.0), F.lit(b), F.lit(9.0)) for a, b in ((0.0, 200.0), (400.0, 500.0), (700.0, 800.0))))
    detected = o.groupBy(F.col("o_custkey").alias("doc_id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("r", row.alias("b")))), lambda x: x["b"]).alias("rows"))
    detected = detected.select("doc_id", F.lit(1).alias("page_no"), F.lit(0).alias("table_no"), box.alias("box"), "rows", cols.alias("cols"), F.lit(2.0).alias("scale"))
    # labels begin before their column and end after it, amounts stand beside theirs, marks before
    y = 100 + 20.0 * F.col("r")
    word = lambda i, text, x: F.struct(F.lit(i).alias("ord"), text.alias("text"), (x - 4.0).alias("x0"), (x + 4.0).alias("x1"), (y + 2).alias("top"), (y + 12).alias("bottom"))
    words = F.filter(F.array(word(0, F.col("o_orderpriority"), F.lit(44.0)), word(1, F.concat(F.lit("x"), k.cast("string")), F.lit(170.0)), word(2, F.when(k % 5 > 0, k.cast("string")), 275.0 + k % 3 * 20), word(3, F.concat(F.lit("y"), (k % 3).cast("string")), F.lit(380.0))), lambda w: w["text"].isNotNull())
    ink = o.where(k % 7 > 0).select(F.col("o_custkey").alias("doc_id"), F.lit(1).alias("page_no"), F.explode(words).alias("w")).select("doc_id", "page_no", "w.*")
    out = grid.filled_grids(ink, detected)
    return out.select("doc_id", F.col("row_idx").cast("int").alias("row_idx"), *(F.get("cells", F.lit(i)).alias(n) for i, n in enumerate(("label", "amount", "mark"))))


_DOUBTS = "SELECT s_nationkey AS doc_id, s_suppkey AS k, CASE WHEN s_suppkey % 11 > 0 THEN (s_suppkey % 10) / 10.0 END::DOUBLE AS c, 0.02 * (1 + s_suppkey % 3) AS price FROM supplier"


def _doubtful(spark, d):
    k = F.col("s_suppkey")
    rows = F.array(F.array(F.lit("total"), (k + 1000).cast("string")), F.array(F.lit("none"), F.lit(None).cast("string")))
    return base(spark, d, "supplier").select("s_suppkey", F.col("s_nationkey").alias("doc_id"), k.alias("table_seq"), F.when(k % 11 > 0, (k % 10) / 10.0).alias("confidence"), F.lit(1).alias("page_start"), (1 + k % 3).alias("page_end"), rows.alias("rows"), F.lit("own").alias("source_engine"), F.concat(F.lit("of 2 pages: "), (k + 2000).cast("string")).alias("raw"))


@query(f"""WITH t AS (SELECT *, coalesce(c, 0) < 0.66 AS low FROM ({_DOUBTS})), s AS (SELECT *, sum(CASE WHEN low THEN price ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY coalesce(c, 0), k ROWS UNBOUNDED PRECEDING) AS spent FROM t)
SELECT k AS s_suppkey, CASE WHEN low THEN price ELSE 0 END::DOUBLE AS cost, low AND round(spent, 6) <= 0.2 AS chosen FROM s""")
def chosen_tables(spark, d):
    out = escalation.chosen(_doubtful(spark, d), budget=0.2)
    return out.select("s_suppkey", F.round("cost", 6).alias("cost"), "chosen")


@query(f"""SELECT k AS s_suppkey, low AS escalated, CASE WHEN low AND k % 4 > 0 THEN 'text-llm' ELSE 'own' END AS source_engine, CASE WHEN low AND k % 4 > 0 THEN CASE WHEN k % 2 = 0 THEN 1.0 ELSE 0.0 END WHEN c IS NULL THEN 0 ELSE c END::DOUBLE AS confidence,
CASE WHEN low AND k % 4 > 0 THEN CASE WHEN k % 2 = 0 THEN CAST(k + 2000 AS VARCHAR) ELSE '99999999' END ELSE CAST(k + 1000 AS VARCHAR) END AS value FROM (SELECT *, coalesce(c, 0) < 0.66 AS low FROM ({_DOUBTS}))""")
def escalation_replies(spark, d):
    def ask(prompts):
        """An engine for the query: it reads its answer off the page's text, or errs, or says nothing of use."""
        out = []
        for p in prompts:
            n = int(p.split("of 2 pages: ")[1].split()[0])
            k = n - 2000
            out.append("I cannot tell." if k % 4 == 0 else 'Here it is:\n```json\n{"rows": [["total", "%s"]]}\n```' % (n if k % 2 == 0 else 99999999))
        return out

    tables_ = escalation.chosen(_doubtful(spark, d)).withColumn("context", F.col("raw"))
    out = escalation.read_again(tables_, escalation.permitted(ask, enabled=True, local_only=False, key="k"))
    return out.select("s_suppkey", "escalated", "source_engine", "confidence", F.get(F.get("rows", F.lit(0)), F.lit(1)).alias("value"))


# -- files ------------------------------------------------------------------------------


@query("SELECT l_suppkey, count(*) AS n, sum(l_quantity) AS quantity, count(DISTINCT l_returnflag) AS flags FROM lineitem GROUP BY 1")
def archived_holdings(spark, d):
    spark.dataSource.register(archives.ZippedTables)
    folder = _folder(spark, "archives")
    rows = base(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity", "l_returnflag")
    rows.write.format("zipped_tables").mode("append").option("member", "INFOTABLE.tsv").save(folder)
    back = spark.read.format("zipped_tables").option("member", "infotable.tsv").schema("l_suppkey string, l_quantity string, l_returnflag string").load(folder)
    return back.groupBy(F.col("l_suppkey").cast("bigint").alias("l_suppkey")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("double")).alias("quantity"), F.countDistinct("l_returnflag").alias("flags"))


@query("SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS size, 'written' AS first, 'kept' AS again FROM documents")
def saved_documents(spark, d):
    docs = base(spark, d, "documents").select(F.coalesce("lang", F.lit("?")).alias("market"), F.coalesce("source", F.lit("none")).alias("symbol"), (F.col("doc_id") % 50).cast("string").alias("filing_id"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.coalesce("text", F.lit("")).cast("binary").alias("content"), F.col("doc_id").alias("doc_seq"))
    root = _folder(spark, "documents")
    first, again = (written(sinks.save_documents(docs, root), "saved") for _ in range(2))
    id_ = F.regexp_extract("name", r"^(\d+)\.txt$", 1).cast("bigint").alias("doc_id")
    return first.select("path", id_, "size", F.col("status").alias("first")).join(again.select("path", F.col("status").alias("again")), "path").drop("path")


@query("""SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS price, arg_max(o_orderstatus, o_orderkey) FILTER (o_orderkey % 3 > 0) AS status, 1::BIGINT AS batches, 0::BIGINT AS again FROM orders GROUP BY 1""")
def landed_upserts(spark, d):
    orders = base(spark, d, "orders")
    schema = StructType.fromDDL("o_custkey bigint, price double, status string")
    at = _folder(spark, "landed")
    table = landing.KeyedTable(spark, f"{at}/table", schema, ["o_custkey"])
    parse = lambda b: b.select("o_custkey", F.col("o_totalprice").alias("price"), F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderstatus")).alias("status"), F.col("o_orderkey").alias("_ord"))
    runs = [landing.feed(spark.readStream.schema(orders.schema).parquet(f"{d}/order[s].parquet"), table, f"{at}/checkpoint", parse, rules={"status": "coalesce_new_old"}) for _ in range(2)]
    return table.read().select("*", *(F.lit(n).cast("bigint").alias(c) for n, c in zip(runs, ("batches", "again"), strict=True)))


@query("""SELECT f.filing_id, CAST(u.seq AS INT) AS doc_seq FROM filings f, (SELECT unnest(range(4)) AS seq) u WHERE u.seq < f.n_urls AND NOT EXISTS (SELECT 1 FROM filing_documents x WHERE x.filing_id = f.filing_id AND x.doc_seq = u.seq)""")
def bucketed_backfill(spark, d):
    have = views.bucketed(standin(spark, d, "filing_documents").select("filing_id", F.col("doc_seq").cast("int").alias("doc_seq")), _folder(spark, "bucketed"), ["filing_id", "doc_seq"])
    return views.missing_documents(standin(spark, d, "filings").where("n_urls > 0").withColumn("seqs", F.sequence(F.lit(0), F.col("n_urls") - 1)), have, ["filing_id"])


# -- peers and reviews --------------------------------------------------------------------


@query("""WITH p AS (SELECT s_suppkey AS k, s_suppkey + 3 AS peer FROM supplier), top AS (SELECT max(s_suppkey) AS m FROM supplier),
known AS (SELECT s_suppkey AS k FROM supplier), made AS (SELECT peer, (SELECT m FROM top) + row_number() OVER (ORDER BY k) AS id FROM p WHERE peer NOT IN (SELECT k FROM known))
SELECT p.k AS company_id, CAST(coalesce(known.k, made.id) AS BIGINT) AS peer_company_id FROM p LEFT JOIN known ON known.k = p.peer LEFT JOIN made ON made.peer = p.peer""")
def peer_companies(spark, d):
    k = F.col("s_suppkey")
    s = base(spark, d, "supplier")
    companies = s.select(k.alias("company_id"), F.col("s_name").alias("name"), F.lit("US").alias("country"))
    listed = s.select(k.alias("security_id"), F.lit("US").alias("market"), F.concat(F.lit("S"), k.cast("string")).alias("symbol"), k.alias("company_id"))
    pairs = s.select(F.lit("US").alias("market"), F.concat(F.lit("S"), k.cast("string")).alias("symbol"), F.concat(F.lit("S"), (k + 3).cast("string")).alias("peer"), k.alias("_ord"))
    xref = tables.create(spark, ["identifier_xref"])["identifier_xref"]
    return entities.peers_with_companies(pairs, companies, xref, listed)[0]


_FORM = "CASE o_orderpriority WHEN '1-URGENT' THEN 'DRS' WHEN '2-HIGH' THEN 'DRS/A' WHEN '3-MEDIUM' THEN 'S-1' WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'F-1/A' ELSE '8-K' END ELSE 'F-1' END"


@query(f"""WITH f AS (SELECT o_custkey, o_orderkey AS ord, {_FORM} AS form, CASE WHEN o_orderkey % 9 > 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders),
g AS (SELECT o_custkey, min(day) FILTER (form IN ('DRS', 'DRS/A')) AS draft, count(*) FILTER (form IN ('DRS', 'DRS/A') AND day IS NOT NULL) AS n,
min_by({{'day': day, 'form': form, 'ord': ord}}, (day, ord)) FILTER (form IN ('S-1', 'S-1/A', 'F-1', 'F-1/A') AND day IS NOT NULL) AS p FROM f GROUP BY 1)
SELECT CAST(o_custkey AS VARCHAR) AS symbol, p.day AS signal_date, 'confidential_review' AS signal_type, 'Confidential DRS review: first draft ' || draft || ' -> first public ' || p.form || ' ' || p.day || ' (' || date_diff('day', draft::DATE, p.day::DATE) || ' days, ' || n || ' draft submission(s) on file)' AS detail, 'u' || p.ord AS url
FROM g WHERE draft IS NOT NULL AND p.day IS NOT NULL AND draft <= p.day""")
def confidential_reviews(spark, d):
    k = F.col("o_orderkey")
    filings = base(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("symbol"), F.expr(_FORM).alias("filing_type"), F.when(k % 9 > 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("filed_date"), F.concat(F.lit("u"), k.cast("string")).alias("url"), k.alias("ord"))
    return signals.confidential_reviews(filings)
