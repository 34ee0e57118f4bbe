"""The tables by name: their columns, keys and how writes treat a row that is there already."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import upsert

_LOCAL, _KEEP_OLD = "coalesce_new_old", "coalesce_old_new"


@dataclass(frozen=True)
class Table:
    columns: str
    keys: Sequence[str]
    policy: str = "update"
    rules: dict[str, str] = field(default_factory=dict)

    def names(self) -> list[str]:
        return [c.split()[0] for c in self.columns.split(", ")]


def _coverage(columns: str, keys: str) -> Table:
    return Table(columns, keys.split(), "replace")


_FILL = dict.fromkeys("name local_name country sector industry lei cik corp_code isin website".split(), _KEEP_OLD)
_SECURITY = dict.fromkeys("exchange security_type currency isin listing_date".split(), _LOCAL)
TABLES: dict[str, Table] = {
    "companies": Table("company_id bigint, name string, local_name string, country string, sector string, industry string, lei string, cik string, corp_code string, isin string, website string, source string", ["company_id"], "update", _FILL | {"source": "keep"}),
    "securities": Table("security_id bigint, company_id bigint, market string, symbol string, exchange string, security_type string, currency string, isin string, listing_date string, is_primary int, source string", ["market", "symbol"], "update", _SECURITY | {"security_id": "keep", "source": "keep"}),
    "identifier_xref": Table("id_type string, id_value string, company_id bigint, source string", ["id_type", "id_value"], "ignore"),
    "prices": Table("security_id bigint, trade_date string, open double, high double, low double, close double, volume bigint, adj_close double, currency string, source string", ["security_id", "trade_date", "source"]),
    "financials": Table("company_id bigint, fiscal_year int, fiscal_period string, fs_scope string, statement_type string, account string, account_local string, value double, currency string, unit string, period_end string, source string", ["company_id", "fiscal_year", "fiscal_period", "fs_scope", "statement_type", "account", "source"], "update", {"account_local": _LOCAL}),
    "filings": Table("company_id bigint, filing_id string, filed_date string, filing_type string, title string, url string, doc_urls string, source string", ["company_id", "filing_id", "source"]),
    "filing_documents": Table("company_id bigint, filing_id string, source string, doc_seq int, doc_url string, local_path string, doc_format string, file_size bigint, text_content string, text_chars bigint", ["company_id", "filing_id", "source", "doc_seq"]),
    "filing_tables": Table("company_id bigint, filing_id string, source string, doc_seq int, table_seq int, row_idx int, col_idx int, value string, page_start int, page_end int, confidence double, needs_review int, source_engine string", ["company_id", "filing_id", "source", "doc_seq", "table_seq", "row_idx", "col_idx"]),
    "fx_rates": Table("rate_date string, base_ccy string, quote_ccy string, rate_type string, rate double, source string", ["rate_date", "base_ccy", "quote_ccy", "rate_type", "source"]),
    "peers": Table("company_id bigint, peer_company_id bigint, source string", ["company_id", "peer_company_id"], "ignore"),
    "statutes": Table("law_id string, law_serial_no string, name string, name_abbrev string, law_type string, department string, promulgation_date string, promulgation_no string, enforcement_date string, revision_type string, detail_url string, company_id bigint, articles_json string, raw_text string", ["law_id", "law_serial_no"], "update", {"company_id": _LOCAL, "articles_json": _LOCAL, "raw_text": _LOCAL}),
    "statute_details": Table("law_id string, law_serial_no string, name string, department string, promulgation_date string, enforcement_date string, articles_json string, raw_text string", ["law_id", "law_serial_no"], "update", {"name": _LOCAL, "department": _LOCAL, "promulgation_date": _LOCAL, "enforcement_date": _LOCAL}),
    "statute_history": Table("law_id string, law_serial_no string, name string, enforcement_date string, promulgation_date string, revision_type string, status string", ["law_id", "law_serial_no"]),
    "statute_translations": Table("law_id string, law_serial_no string, name_en string, content_en string", ["law_id"], "update", {"law_serial_no": _LOCAL}),
    "statute_comparisons": Table("law_id string, mst string, comparison_type string, article_no string, old_text string, new_text string", ["law_id", "mst", "comparison_type", "article_no"]),
    "law_api_raw": Table("target string, item_key string, title string, payload_json string", ["target", "item_key"], "update", {"title": _LOCAL}),
    "corporate_actions": _coverage("security_id bigint, ex_date string, action_type string, amount double, ratio double, currency string, source string", "security_id ex_date action_type source"),
    "daily_metrics": _coverage("security_id bigint, metric_date string, market_cap double, shares_outstanding double, foreign_own_pct double, currency string, source string", "security_id metric_date source"),
    "ratios": _coverage("company_id bigint, fiscal_year int, fiscal_period string, metric string, value double, source string", "company_id fiscal_year fiscal_period metric source"),
    "ownership": _coverage("company_id bigint, as_of_date string, holder_name string, holder_type string, shares double, pct double, source string", "company_id as_of_date holder_name source"),
    "insider_trades": _coverage("company_id bigint, filed_date string, insider string, relation string, txn_type string, txn_seq int, shares double, price double, filing_id string, source string", "company_id filing_id insider txn_seq source"),
    "institutional_holdings": _coverage("company_id bigint, quarter string, manager string, shares double, value double, source string", "company_id quarter manager source"),
    "analyst_estimates": _coverage("company_id bigint, fiscal_year int, metric string, avg_est double, high_est double, low_est double, num_analysts bigint, source string", "company_id fiscal_year metric source"),
    "earnings_events": _coverage("company_id bigint, event_date string, event_type string, fiscal_period string, eps_estimate double, eps_actual double, source string", "company_id event_date event_type source"),
    "news": _coverage("company_id bigint, published_at string, title string, url string, sentiment double, source string", "company_id published_at title source"),
    "esg_scores": _coverage("company_id bigint, period string, env double, soc double, gov double, total double, source string", "company_id period source"),
    "index_membership": _coverage("company_id bigint, index_name string, added string, removed string, source string", "company_id index_name source"),
    "demand_signals": _coverage("company_id bigint, signal_date string, signal_type string, investor_name string, indicated_amount double, filed_amount double, priced_amount double, price double, shares double, detail string, url string, source string", "company_id signal_date signal_type detail source"),
    "run_log": Table("run_id bigint, started_at string, finished_at string, source string, market string, data_type string, symbols string, status string, rows_written bigint, message string", ["run_id"], "update", dict.fromkeys("started_at source market data_type symbols".split(), _KEEP_OLD)),
}


def create(spark: SparkSession, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Empty tables by name."""
    return {n: spark.createDataFrame([], TABLES[n].columns) for n in names or TABLES}


def shaped(name: str, rows: DataFrame) -> DataFrame:
    """``rows`` with the table's columns in their types; those it lacks are null."""
    types = dict(x.rsplit(" ", 1) for x in TABLES[name].columns.split(", "))
    return rows.select(*((F.col(c) if c in rows.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()))


def write(name: str, old: DataFrame, new: DataFrame, ordinal: str = "_ord") -> DataFrame:
    """``new`` written into the table as its keys and rules say; columns it lacks are null, a peer of itself goes."""
    t = TABLES[name]
    types = dict(x.rsplit(" ", 1) for x in t.columns.split(", "))
    rows = new.select(*(F.col(c).cast(types[c]).alias(c) if c in new.columns else F.lit(None).cast(types[c]).alias(c) for c in t.names()), ordinal)
    if name == "peers":
        rows = rows.where("company_id <> peer_company_id")
    if name == "financials":
        rows = rows.withColumn("statement_type", F.coalesce("statement_type", F.lit("")))
    return upsert(old.select(*t.names()), rows, t.keys, t.policy, t.rules, ordinal).select(*t.names())


def write_detail(statutes: DataFrame, details: DataFrame, ordinal: str = "_ord") -> DataFrame:
    """Details merged into the statutes table: their texts replace, what they lack stays; the link to a company is the statute's own."""
    names = [c for c in TABLES["statutes"].names()]
    types = dict(x.rsplit(" ", 1) for x in TABLES["statutes"].columns.split(", "))
    rows = details.select(*(F.col(c).cast(types[c]).alias(c) if c in details.columns else F.lit(None).cast(types[c]).alias(c) for c in names), ordinal)
    rules = {c: _LOCAL for c in names if c not in ("law_id", "law_serial_no", "articles_json", "raw_text")}
    return upsert(statutes.select(*names), rows, ["law_id", "law_serial_no"], "update", rules, ordinal).select(*names)


def write_coverage(name: str, old: DataFrame, new: DataFrame, securities: DataFrame, ordinal: str = "_ord") -> tuple[DataFrame, DataFrame]:
    """Rows by (market, symbol) written under the table's own id; rows of unknown symbols go. Also the number of rows written, as a table of one row."""
    key = TABLES[name].keys[0]
    rows = new.join(securities.select("market", "symbol", key), ["market", "symbol"])
    return write(name, old, rows, ordinal), rows.agg(F.count(F.lit(1)).alias("written"))


def link_statute(statutes: DataFrame, law_id: str, company_id: int) -> DataFrame:
    """The statute's rows with that company."""
    return statutes.withColumn("company_id", F.when(F.col("law_id") == law_id, F.lit(company_id).cast("bigint")).otherwise(F.col("company_id")))


def log_run(log: DataFrame, event: DataFrame, ordinal: str = "_ord") -> DataFrame:
    """A start or an end of runs written to the log: an end fills what the start left open."""
    return write("run_log", log, event, ordinal)
