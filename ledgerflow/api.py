"""The engine's commands as functions of a session and its tables.

``Engine`` holds the tables by name, Parquet under one folder or frames in memory,
and offers what a user runs: create, collect, coverage, documents to fetch, links,
comparison, status, guarded queries, statutes and evaluation.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions.scalars import compact_number, normalize_symbol, range_or_default, truncate, window_start
from .operators import entities, evaluation, signals
from .operators.storage import written
from .operators.upsert import replace_partition
from .plans import tables, views
from .sources import documents, routes, sinks, statutes
from .sources.routes import MARKETS, default_source, parser  # noqa: F401  the last two are the user's

#: Coverage types: their table and whether a range of days applies.
COVERAGE = {"actions": ("corporate_actions", True), "metrics": ("daily_metrics", True), "ratios": ("ratios", False), "ownership": ("ownership", False), "insiders": ("insider_trades", True), "institutional": ("institutional_holdings", False), "analyst": ("analyst_estimates", False), "earnings": ("earnings_events", False), "news": ("news", False), "esg": ("esg_scores", False), "index": ("index_membership", False), "demand": ("demand_signals", False)}
CORE = ("master", "prices", "financials", "filings")
#: Accounts that name a company's revenue and net income, in order of preference.
METRICS = {"revenue": ["Revenues", "RevenueFromContractWithCustomerExcludingAssessedTax", "revenue", "매출액", "Revenue", "totalRevenue"], "net_income": ["NetIncomeLoss", "netIncome", "당기순이익", "ProfitLoss"]}
#: A statement with more nodes is refused.
MOST_NODES = 10_000
READS = re.compile(r"(?is)^\s*(?:select|with|explain|show|describe|desc|pragma)\b")
WRITES = re.compile(r"(?i)(?:Insert|Create|Drop|Delete|Update|Merge|Alter|Truncate|Replace|Load|Set[A-Z]|Add[A-Z]|Rename|Overwrite|Append|Write|Refresh|Cache|Uncache|Repair|Analyze)")


def read_only(spark: SparkSession, sql: str) -> None:
    """ValueError unless the statement only reads: by its first word, and by the nodes of its parsed plan, wherever they stand."""
    if not READS.match(sql):
        raise ValueError("only statements that read are run")
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql)
    todo, seen = [plan], 0
    while todo:
        node, seen = todo.pop(), seen + 1
        if seen > MOST_NODES:
            raise ValueError(f"the statement has more than {MOST_NODES} nodes and cannot be judged")
        if WRITES.match(node.nodeName().split(".")[-1]):
            raise ValueError(f"{node.nodeName()} writes")
        if node.getClass().getSimpleName() == "ExplainCommand":
            todo.append(node.logicalPlan())
        for group in (node.children(), node.innerChildren()):
            todo += [c for i in range(group.size()) if hasattr(c := group.apply(i), "nodeName")]


@dataclass
class Engine:
    spark: SparkSession
    tables: dict[str, DataFrame] = field(default_factory=dict)

    def create(self) -> Engine:
        """Empty tables for all that are missing, and every table as a view of its name."""
        missing = [n for n in tables.TABLES if n not in self.tables]
        self.tables = {**tables.create(self.spark, missing), **self.tables} if missing else self.tables
        for name, df in self.tables.items():
            df.createOrReplaceTempView(name)
        return self

    def store(self, folder: str) -> Engine:
        """All tables written under a folder and read from there, so that what made them is not run again."""
        for name, df in self.tables.items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return Engine(self.spark, {name: self.spark.read.schema(df.schema).parquet(f"{folder}/{name}") for name, df in self.tables.items()}).create()

    def write(self, name: str, rows: DataFrame, ordinal: str = "_ord") -> Engine:
        self.tables[name] = tables.write(name, self.tables[name], rows, ordinal)
        self.tables[name].createOrReplaceTempView(name)
        return self

    def load_master(self, records: DataFrame, ordinal: str = "_ord", limit: int | None = None) -> Engine:
        """Records resolved to companies and written with their listings and identifiers; a limit takes the first records."""
        rows = records.orderBy(ordinal).limit(limit) if limit is not None else records
        t = self.tables
        found, companies, xref = entities.resolve(rows, t["companies"], t["identifier_xref"], t["securities"], ordinal)
        full = entities.prepared(rows, ordinal).select("market", "symbol", *(c for c in ("exchange", "security_type", "currency", "isin", "listing_date", "source")), F.coalesce("is_primary", F.lit(0)).alias("is_primary"), F.col("given").alias("_ord")).join(found.select("_ord", "company_id"), "_ord")
        from .operators.upsert import with_ids

        listed = with_ids(t["securities"].select("market", "symbol", "security_id"), full, ["market", "symbol"], "security_id")
        as_table = lambda name, df: df.select(*((F.col(c) if c in df.columns else F.lit(None)).cast(dict(x.rsplit(" ", 1) for x in tables.TABLES[name].columns.split(", "))[c]).alias(c) for c in tables.TABLES[name].names()))
        self.tables |= {"companies": as_table("companies", companies), "identifier_xref": as_table("identifier_xref", xref)}
        return self.write("securities", listed)

    def ensure_master(self, wanted: DataFrame) -> Engine:
        """Placeholders for wanted listings (market, symbol, _ord) that have none."""
        missing = entities.missing_master(wanted, self.tables["securities"])
        return self if missing.isEmpty() else self.load_master(missing)

    def collect(self, data_type: str, landed: dict[tuple[str, str], routes.Landed], markets: tuple[str, ...] = MARKETS, source: str | None = None) -> tuple[DataFrame | None, list[Exception]]:
        """Rows parsed from landed payloads by (market, type), each market by its default source or the one given; ``all`` is the core types. Markets or types that fail are reported beside the rest."""
        types = CORE if data_type == "all" else (data_type,)
        branches = [lambda m=m, t=t: routes.parsed(m, t, landed[m, t], source).withColumn("data_type", F.lit(t)) for m in markets for t in types if (m, t) in landed]
        return signals.isolated(*branches)

    def fx_wanted(self, today: str, start: str | None = None, end: str | None = None) -> DataFrame:
        """Currency, first and last day of the rates to fetch: every currency of listings, prices and financials but the dollar, in order.

        The range asked for, or else five years, is widened for currencies of financials to a year before their first period.
        """
        t = self.tables
        used = [t[n].select("currency") for n in ("securities", "prices", "financials")]
        needed = used[0].unionByName(used[1]).unionByName(used[2]).where("currency is not null and currency not in ('', 'USD')").distinct()
        periods = t["financials"].where("period_end is not null").groupBy("currency").agg(F.min(window_start(F.lit("FY"), F.col("period_end"))).alias("_lo"), F.max("period_end").alias("_hi"))
        lo, hi = range_or_default(start, end, today)
        return needed.join(periods, "currency", "left").select("currency", F.least(F.lit(lo), "_lo").alias("start"), F.greatest(F.lit(hi), "_hi").alias("end")).orderBy("currency")

    def collect_fx(self, charts: DataFrame, source: str = "yfinance") -> Engine:
        """Spot rates from landed charts (base_ccy, payload) and, from all spot rates, the averages of the periods of financials, written."""
        spot = routes.fx_rates(charts).withColumn("source", F.lit(source))
        self.write("fx_rates", spot.withColumn("_ord", F.lit(0)))
        average = views.period_average_fx(self.tables["financials"], self.tables["fx_rates"]).withColumn("source", F.lit("computed"))
        return self.write("fx_rates", average.withColumn("_ord", F.lit(0)))

    def collect_coverage(self, kind: str, landed: dict[str, routes.Landed], today: str, source: str | None = None, start: str | None = None, end: str | None = None) -> dict[str, int]:
        """A coverage type parsed and written for each market that has landed; rows written by market. Listings that are not known get placeholders."""
        out = {}
        for market, what in landed.items():
            rows = routes.parsed(market, kind, what, source).withColumn("symbol", normalize_symbol(F.col("market"), F.col("symbol")))
            rows = written(rows.withColumn("_ord", F.monotonically_increasing_id()), f"coverage-{kind}")
            self.ensure_master(rows.groupBy("market", "symbol").agg(F.min("_ord").alias("_ord")))
            out[market] = self.coverage(kind, rows, start=start, end=end, today=today)
        return out

    def coverage(self, kind: str, rows: DataFrame, ordinal: str = "_ord", start: str | None = None, end: str | None = None, today: str | None = None) -> int:
        """Rows of a coverage type (market, symbol, ...) written to its table; how many were of known listings."""
        name, dated = COVERAGE[kind]
        if dated and today is not None:
            lo, hi = range_or_default(start, end, today)
            day = next(c for c in rows.columns if c.endswith("_date"))
            rows = rows.where(F.col(day).isNull() | F.col(day).between(lo, hi))
        self.tables[name], written = tables.write_coverage(name, self.tables[name], rows, self.tables["securities"], ordinal)
        self.create()
        return written.first()["written"]

    def documents_to_fetch(self) -> DataFrame:
        """Filings with fewer documents than URLs, and of those the URLs (doc_seq, doc_url) that are not there yet."""
        t = self.tables
        urls = F.from_json("doc_urls", "array<string>")
        filings = t["filings"].withColumn("n_urls", F.coalesce(F.size(urls), F.lit(0)))
        pending = views.pending_filings(filings, t["filing_documents"], t["securities"])
        keys = ["company_id", "filing_id", "source"]
        wanted = pending.select(*keys, F.posexplode(F.coalesce(F.nullif(urls, F.array().cast("array<string>")), F.array("url"))).alias("doc_seq", "doc_url"))
        return wanted.join(t["filing_documents"].select(*keys, "doc_seq"), [*keys, "doc_seq"], "left_anti")

    def backfill(self, fetch: Callable[[DataFrame], DataFrame], root: str, **options) -> dict[str, int]:
        """Documents that are missing fetched, saved, read and written; how many came, and how many of them without text.

        ``fetch`` is a job over the wanted documents (company_id, filing_id, source, doc_seq, doc_url, market, symbol) that adds
        content_type and content; what it leaves out is wanted again the next time. Options are those of ``documents.stored``.
        """
        first = Window.partitionBy("company_id").orderBy(F.desc(F.coalesce("is_primary", F.lit(0))), "security_id")
        at = self.tables["securities"].withColumn("_n", F.row_number().over(first)).where("_n = 1").select("company_id", "market", "symbol")
        wanted = self.documents_to_fetch().where("doc_url <> ''").join(at, "company_id", "left")
        wanted = wanted.withColumns({"market": F.coalesce("market", F.lit("NA")), "symbol": F.coalesce("symbol", F.col("company_id").cast("string"))})
        rows, cells = documents.stored(fetch(written(wanted, "wanted")), root, **options)
        rows = written(rows.withColumn("_ord", F.lit(0)), "documents")
        if cells is not None:
            cells = written(cells, "cells")
            self.tables["filing_tables"] = replace_partition(self.tables["filing_tables"], tables.shaped("filing_tables", cells), documents.KEYS)
        self.write("filing_documents", rows)
        return rows.agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("text_chars") == 0).alias("empty")).first().asDict()

    def link(self, members: DataFrame | list[str]) -> int:
        """Listings of a group put on one company: a frame of overrides or MARKET:SYMBOL texts; how many were linked."""
        by_hand = isinstance(members, list)
        rows = entities.tokens(self.spark, members) if by_hand else entities.overrides_of(members)
        t = self.tables
        self.tables["securities"], self.tables["identifier_xref"], links = entities.apply_overrides(rows, t["securities"], t["identifier_xref"], "manual" if by_hand else "override")
        self.create()
        return links.count()

    def find(self, symbols: DataFrame) -> DataFrame:
        """Listings of symbols (symbol, market or null): exact where a market is given, else the primary one of any market."""
        sec = self.tables["securities"]
        given = symbols.where("market is not null").withColumn("_s", normalize_symbol(F.col("market"), F.col("symbol"))).alias("a").join(sec.alias("s"), (F.col("s.market") == F.upper("a.market")) & (F.col("s.symbol") == F.col("_s")))
        codes = F.explode(F.array_distinct(F.array(*(normalize_symbol(F.lit(m), F.col("symbol")) for m in MARKETS))))
        any_ = symbols.where("market is null").withColumn("_s", codes).alias("a").join(sec.alias("s"), F.col("s.symbol") == F.col("_s"))
        w = Window.partitionBy("asked").orderBy(F.desc(F.coalesce("is_primary", F.lit(0))), "security_id")
        both = given.select(F.col("a.symbol").alias("asked"), "s.*").unionByName(any_.select(F.col("a.symbol").alias("asked"), "s.*"))
        return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")

    def compare(self, symbols: list[str], metrics: dict[str, list[str]] | None = None) -> DataFrame:
        """A row for each symbol (a code, or MARKET:CODE) that is listed: last close local and in USD, and the newest annual metrics as text."""
        asked = self.spark.createDataFrame([(s.split(":", 1)[1], s.split(":", 1)[0]) if ":" in s else (s, None) for s in symbols], "symbol string, market string")
        sec = self.find(asked)
        t = self.tables
        close = views.to_usd(views.latest_rows(t["prices"], "security_id", "trade_date"), t["fx_rates"], "close", "close_usd")
        close = close.groupBy("security_id").agg(F.max(F.struct("close", "close_usd", "trade_date", "currency")).alias("p")).select("security_id", F.col("p.close").alias("close"), F.col("p.close_usd").alias("close_usd"), F.col("p.trade_date").alias("trade_date"))
        out = sec.select("asked", "market", "symbol", "company_id", "security_id", "currency").join(close, "security_id", "left").join(t["companies"].select("company_id", "name"), "company_id", "left")
        for name, accounts in (metrics or METRICS).items():
            out = out.join(views.latest_metric(t["financials"], accounts, name), "company_id", "left").withColumn(name, compact_number(F.col(name)))
        return out.drop("company_id", "security_id")

    def status(self, limit: int = 20) -> DataFrame:
        """The newest runs."""
        return self.tables["run_log"].orderBy(F.desc("run_id")).limit(limit).withColumn("message", truncate(F.col("message")))

    def query(self, sql: str) -> DataFrame:
        """The rows of a statement that only reads the tables."""
        read_only(self.spark, sql)
        return self.create().spark.sql(sql)

    def law(self, action: str, landed: DataFrame, *args) -> DataFrame:
        """Statutes parsed by action: search, detail, history, english, compare, raw, raw-item."""
        actions = {"search": statutes.statutes, "detail": statutes.articles, "history": statutes.history, "english": statutes.translations, "compare": statutes.comparison, "raw": statutes.raw_items, "raw-item": statutes.raw_item}
        if action not in actions:
            raise ValueError(f"unknown action {action!r}")
        return actions[action](landed, *args)

    def law_detail(self, details: DataFrame, ordinal: str = "_ord") -> Engine:
        """Details of statutes merged into what is known of them."""
        self.tables["statutes"] = tables.write_detail(self.tables["statutes"], details, ordinal)
        return self.create()

    def evaluate(self, cases: DataFrame | str, read: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """Scores by category of cases, or of the gold cases of a folder read by ``read``, an engine for their documents."""
        if isinstance(cases, str):
            if read is None:
                raise ValueError("gold cases of a folder need an engine that reads their documents")
            cases = evaluation.read_cases(evaluation.gold_cases(self.spark, cases), read)
        return evaluation.roll_up(evaluation.score_cases(cases))

    def save_documents(self, docs: DataFrame, root: str) -> DataFrame:
        """Files of fetched documents (market, symbol, filing_id, name, content, doc_seq), each written once."""
        return sinks.save_documents(docs, root)

    def show(self, df: DataFrame, rows: int = 50) -> None:
        """The first rows as a table of text."""
        print(sinks.text_table(df, rows))
