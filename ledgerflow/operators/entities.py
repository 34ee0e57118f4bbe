"""Companies behind listings: which record belongs to which company, and links set by hand.

Records are taken in order, depositary receipts last. A record belongs to the company
that first registered its LEI, else its CIK, corporate code or ISIN, else to the first
company of its name and country, else to a new one; then its identifiers are
registered, the first registration of each counting. A receipt goes by its underlying's
ISIN, then listing, then ticker, and never by name. Two companies that come to share
an identifier later stay two: this is not a transitive closure.

No record waits for another in turn. Who registers an identifier first is the least place
among those that have it, so every record's predecessor by identifier, listing or name is a
pointer to an earlier record, found by grouping and joins; its company is the root of the
pointers. Only names depend on what is decided before: a company without name or
country takes them from its later records. So the decisions by name are taken anew, from
the companies as they then stand in time, until none changes. A decision depends on
earlier records alone, so this ends, with the result of taking the records in turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import normalize_symbol, strip
from .storage import roots, written
from .upsert import with_ids

#: Fixed value: identifiers in the order in which they decide.
PRIORITY = ("LEI", "CIK", "CORP_CODE", "ISIN")
RECEIPTS = ("ADR", "GDR")
FILLED = ("name", "local_name", "country", "sector", "industry", "lei", "cik", "corp_code", "isin", "website")
RECORD = "market string, symbol string, security_type string, currency string, exchange string, listing_date string, is_primary int, underlying_isin string, underlying_symbol string, source string, " + ", ".join(f"{c} string" for c in FILLED)
#: Receipts are placed after all other records, companies that were there before them.
_LATE, _EARLY = 1 << 61, 1 << 62


def prepared(records: DataFrame, ordinal: str = "_ord") -> DataFrame:
    """Records with every column of RECORD, symbols normalised, and ``at``, the place at which each is resolved."""
    have = set(records.columns)
    columns = [(F.col(n) if n in have else F.lit(None)).cast(t).alias(n) for n, t in (x.split() for x in RECORD.split(", "))]
    rows = records.select(*columns, F.col(ordinal).cast("long").alias("given")).withColumn("symbol", normalize_symbol(F.col("market"), F.col("symbol")))
    rows = rows.withColumn("receipt", F.coalesce("security_type", F.lit("COMMON")).isin(*RECEIPTS))
    return rows.withColumn("at", F.col("given") + F.when(F.col("receipt"), F.lit(_LATE)).otherwise(F.lit(0)))


def _there(c: str) -> Column:
    return F.coalesce(F.col(c) != "", F.lit(False))


def _company(c: str | Column = "company_id") -> Column:
    """A company that was there, as the node of a pointer: below all places, in the order of ids."""
    return (F.col(c) if isinstance(c, str) else c).cast("long") - F.lit(_EARLY)


def underlyings(rows: DataFrame, xref: DataFrame, listings: DataFrame) -> DataFrame:
    """at and ``up``, whom a receipt follows: its underlying's ISIN as first registered, else that listing's last holder, else a ticker known before."""
    receipts = rows.where("receipt").select("at", "underlying_isin", "underlying_symbol")
    known = lambda kind, name: xref.where(F.col("id_type") == kind).select(F.col("id_value").alias(name), F.col("node").alias("known"))
    isin_first = rows.where(_there("isin")).groupBy(F.col("isin").alias("underlying_isin")).agg(F.min("at").alias("first"))
    by_isin = receipts.where(_there("underlying_isin")).join(known("ISIN", "underlying_isin"), "underlying_isin", "left").join(isin_first, "underlying_isin", "left")
    by_isin = by_isin.select("at", F.coalesce("known", F.when(F.col("first") < F.col("at"), F.col("first"))).alias("isin"))
    split = F.split("underlying_symbol", ":", 2)
    asked = receipts.where(_there("underlying_symbol")).select("at", "underlying_symbol", F.when(F.size(split) == 2, F.get(split, F.lit(0))).alias("market"), F.get(split, F.lit(1)).alias("symbol"))
    # receipts come after all others, so only among themselves it matters who held a listing when
    held = rows.where("not receipt").groupBy("market", "symbol").agg(F.max("at").alias("last"))
    late = rows.where("receipt").select("market", "symbol", "at", F.col("at").alias("holder"), F.lit(None).cast("string").alias("underlying_symbol"))
    before = Window.partitionBy("market", "symbol").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    both = late.unionByName(asked.withColumn("holder", F.lit(None).cast("long"))).withColumn("late", F.last("holder", ignorenulls=True).over(before)).where("underlying_symbol is not null")
    by_listing = both.join(held, ["market", "symbol"], "left").join(listings.select("market", "symbol", F.col("node").alias("listed")), ["market", "symbol"], "left")
    by_listing = by_listing.join(known("TICKER", "underlying_symbol"), "underlying_symbol", "left").select("at", F.coalesce("late", "last", "listed", "known").alias("listing"))
    return receipts.select("at").join(by_isin, "at", "left").join(by_listing, "at", "left").select("at", F.coalesce("isin", "listing").alias("up")).where("up is not null")


def own_ids(rows: DataFrame) -> DataFrame:
    """at, priority, id_type and id_value of the identifiers that each record registers; corporate codes of receipts are their underlyings'."""
    pick = [F.when(_there(k.lower()) & ((F.lit(k) != "CORP_CODE") | F.col("up").isNull()), F.struct(F.lit(i).alias("priority"), F.lit(k).alias("id_type"), F.col(k.lower()).alias("id_value"))) for i, k in enumerate(PRIORITY)]
    return rows.select("at", "up", F.explode(F.array_compact(F.array(*pick))).alias("i")).select("at", "up", "i.*")


def _key(name: Column, country: str) -> Column:
    return F.struct(F.lower(F.coalesce(name, F.lit(""))).alias("name"), F.coalesce(F.concat(F.lit("="), country), F.lit("")).alias("country"))


def phases(companies: DataFrame) -> DataFrame:
    """node, key, after and until: when which name and country are a company's, as both may be filled in later.

    ``companies`` has node, born, name, country, and name_at, later_name, country_at and later_country of what fills them.
    """
    filled = F.least("name_at", "country_at"), F.greatest("name_at", "country_at")
    first = F.struct(F.col("born").alias("after"), filled[0].alias("until"), _key(F.col("name"), "country").alias("key"))
    sooner = lambda a, b, new, old: F.when(F.col(a) < F.col(b), F.col(new)).otherwise(F.col(old))
    between = F.struct(filled[0].alias("after"), filled[1].alias("until"), F.struct(
        F.lower(F.coalesce(sooner("name_at", "country_at", "later_name", "name"), F.lit(""))).alias("name"),
        F.coalesce(F.concat(F.lit("="), sooner("country_at", "name_at", "later_country", "country")), F.lit("")).alias("country"),
    ).alias("key"))
    last = F.struct(filled[1].alias("after"), F.lit(None).cast("long").alias("until"), F.struct(
        F.lower(F.coalesce("name", "later_name", F.lit(""))).alias("name"), F.coalesce(F.concat(F.lit("="), F.coalesce("country", "later_country")), F.lit("")).alias("country"),
    ).alias("key"))
    parts = F.array(first, F.when(F.col("name_at") != F.col("country_at"), between), F.when(filled[1].isNotNull(), last))
    return companies.select("node", "born", F.explode(F.array_compact(parts)).alias("p")).select("node", "born", "p.*")


def by_name(asked: DataFrame, companies: DataFrame) -> DataFrame:
    """at and the first company that has the asked key at that time."""
    spans = phases(companies)
    whole = F.col("until").isNull() & (F.col("after") == F.col("born"))
    # of companies that keep a key from their birth the first is the one to find
    first = spans.where(whole).groupBy("key").agg(F.min("node").alias("node"), F.min("born").alias("after")).withColumn("until", F.lit(None).cast("long"))
    changing = spans.where(~whole).select("key", "node", "after", "until")
    found = asked.join(first.unionByName(changing), "key").where("after < at and (until is null or at <= until)")
    return found.groupBy("at").agg(F.min("node").alias("named"))


def decided(rows: DataFrame, companies: DataFrame, xref: DataFrame, listings: DataFrame, max_rounds: int = 50) -> tuple[DataFrame, DataFrame]:
    """(at, root) of every record, a root being a record's place or a company that was there; and the identifiers registered."""
    up = underlyings(rows, xref, listings)
    led = rows.join(up, "at", "left")
    ids = written(own_ids(led), "own-ids")
    first = written(ids.groupBy("id_type", "id_value").agg(F.min("at").alias("first")).join(xref, ["id_type", "id_value"], "left"), "first-ids")
    met = ids.where("up is null").join(first, ["id_type", "id_value"]).select("at", "priority", F.coalesce("node", F.when(F.col("first") < F.col("at"), F.col("first"))).alias("to")).where("to is not null")
    base = led.join(met.groupBy("at").agg(F.min_by("to", "priority").alias("by_id")), "at", "left")
    base = written(base.select("at", "receipt", "name", "country", F.coalesce("up", "by_id").alias("to")), "by-identifier")
    asked = written(base.where(F.col("to").isNull() & ~F.col("receipt") & _there("name")).select("at", _key(strip(F.col("name")), "country").alias("key")), "by-name")
    there = companies.select(_company().alias("node"), F.lit(-1).cast("long").alias("born"), "name", "country")
    never = {c: F.lit(None).cast(t) for c, t in (("name_at", "long"), ("later_name", "string"), ("country_at", "long"), ("later_country", "string"))}
    made = base.where("to is null").select(F.col("at").alias("node"), F.col("at").alias("born"), "name", "country")
    named = written(by_name(asked, there.unionByName(made).withColumns(never)), "named")
    for _ in range(max_rounds):
        whole = base.join(named, "at", "left").withColumn("to", F.coalesce("to", "named"))
        root = written(roots(whole.select(F.col("at").alias("node"), F.col("to").alias("parent"))).withColumnRenamed("node", "at"), "roots")
        members = root.join(base.select("at", "name", "country"), "at").groupBy(F.col("root").alias("node"))
        at = lambda c: F.min(F.when(F.col(c).isNotNull(), F.col("at")))
        value = lambda c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("at")))
        fills = members.agg(at("name").alias("name_at"), value("name").alias("later_name"), at("country").alias("country_at"), value("country").alias("later_country"))
        now = there.unionByName(whole.where("to is null").select(F.col("at").alias("node"), F.col("at").alias("born"), "name", "country")).join(fills, "node", "left")
        now = now.withColumns({f"{c}_at": F.when(F.col(c).isNull(), F.col(f"{c}_at")) for c in ("name", "country")})
        if now.where("name_at is not null or country_at is not null").isEmpty():
            return root, first  # no company's key changes with time, so the first found are the ones
        again = written(by_name(asked, now), "named")
        if again.exceptAll(named).isEmpty() and named.exceptAll(again).isEmpty():
            return root, first
        named = again
    raise RuntimeError(f"decisions by name still change after {max_rounds} rounds")


def resolve(records: DataFrame, companies: DataFrame, xref: DataFrame, securities: DataFrame, ordinal: str = "_ord") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Records (market, symbol, _ord) with their company_id, and the companies and identifiers after them.

    New companies get the next free ids in the order of the records that made them.
    """
    rows = written(prepared(records, ordinal), "records")
    have = set(companies.columns)
    old = companies.select("company_id", *((F.col(c) if c in have else F.lit(None)).cast("string").alias(c) for c in FILLED))
    known = xref.select("id_type", "id_value", _company().alias("node")).dropDuplicates(["id_type", "id_value"])
    listings = securities.select("market", "symbol", _company().alias("node"))
    root, first = decided(rows, old, known, listings)
    numbers = with_ids(old.select(_company().alias("node"), "company_id"), root.where("at = root").select(F.col("at").alias("node"), F.col("at").alias("_ord")), ["node"], "company_id").select("node", "company_id")
    ids = written(numbers.unionByName(old.select(_company().alias("node"), F.col("company_id").cast("long").alias("company_id"))), "company-ids")
    of = root.join(ids, root["root"] == ids["node"]).select("at", "company_id")
    mine = written(rows.join(of, "at"), "resolved")

    # fields: what was there, then the records in order
    was = old.select(F.lit(-1).cast("long").alias("at"), "company_id", *FILLED)
    touched = mine.select("at", "company_id", *FILLED).unionByName(was.join(mine.select("company_id").distinct(), "company_id", "left_semi").select("at", "company_id", *FILLED))
    after = touched.groupBy("company_id").agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col("at"))).alias(c) for c in FILLED))
    after = after.unionByName(old.join(after.select("company_id"), "company_id", "left_anti").select("company_id", *FILLED))

    tickers = mine.groupBy("market", "symbol").agg(F.min_by("company_id", "at").alias("company_id")).join(securities.select("market", "symbol"), ["market", "symbol"], "left_anti")
    tickers = tickers.select(F.lit("TICKER").alias("id_type"), F.concat_ws(":", "market", "symbol").alias("id_value"), "company_id")
    fresh = first.where("node is null").join(of, F.col("first") == of["at"]).select("id_type", "id_value", "company_id").unionByName(tickers)
    listed = xref.select("id_type", "id_value", F.col("company_id").cast("long").alias("company_id"))
    return mine.select("market", "symbol", F.col("given").alias("_ord"), "company_id"), after, listed.unionByName(fresh.join(listed, ["id_type", "id_value"], "left_anti"))


# -- links set by hand ---------------------------------------------------------------------


def read_overrides(spark, path: str) -> DataFrame:
    """group, market and symbol of curated files, in the order of their names and bytes; rows that lack one go."""
    rows = spark.read.csv(path, header=True, schema="group string, market string, symbol string", enforceSchema=False)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    rows = written(rows.withColumn("_ord", place), "overrides")
    return overrides_of(rows)


def overrides_of(rows: DataFrame) -> DataFrame:
    clean = rows.select(strip(F.col("group")).alias("group"), F.upper(strip(F.col("market"))).alias("market"), strip(F.col("symbol")).alias("symbol"), "_ord")
    clean = clean.where("group <> '' and market <> '' and symbol <> ''")
    return clean.withColumn("symbol", normalize_symbol(F.col("market"), F.col("symbol")))


def tokens(spark, texts: list[str]) -> DataFrame:
    """Listings given as MARKET:SYMBOL, or as a US symbol alone, as one group."""
    split = [t.split(":", 1) if ":" in t else ("US", t) for t in texts]
    return overrides_of(spark.createDataFrame([("link", m, s, i) for i, (m, s) in enumerate(split)], "group string, market string, symbol string, _ord long"))


def apply_overrides(members: DataFrame, securities: DataFrame, xref: DataFrame, source: str = "override") -> tuple[DataFrame, DataFrame, DataFrame]:
    """securities and identifiers after all listings of a group that exist go to the company of the first of them; and those links.

    Groups are taken in the order of their first rows, and each sees the links of
    those before it: its first listing has the company of the last earlier group that holds this
    listing, else its own. That is a pointer from group to group, whose root tells.
    A listing in several groups goes with the last. Groups without a listing that exists change nothing.
    """
    order = members.groupBy("group").agg(F.min("_ord").alias("_at")).select("group", F.struct("_at", "group").alias("node"))
    there = written(members.join(securities.select("market", "symbol", "company_id"), ["market", "symbol"]).join(order, "group"), "members")
    first = there.groupBy("node").agg(F.min_by(F.struct("market", "symbol", "company_id"), "_ord").alias("lead")).select("node", "lead.*")
    held = there.select("market", "symbol", "node").distinct().withColumn("parent", F.lag("node").over(Window.partitionBy("market", "symbol").orderBy("node")))
    leads = written(first.join(held, ["node", "market", "symbol"]).select("node", "parent", "company_id"), "leads")
    target = roots(leads.select("node", "parent")).join(leads.select(F.col("node").alias("root"), F.col("company_id").alias("target")), "root").select("node", "target")
    links = there.join(target, "node").groupBy("market", "symbol").agg(F.max_by("target", "node").alias("target"))
    return _relinked(written(links, "links"), securities, xref, source)


def _relinked(links: DataFrame, securities: DataFrame, xref: DataFrame, source: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    moved = securities.join(links, ["market", "symbol"], "left").withColumn("company_id", F.coalesce("target", "company_id")).drop("target").select(securities.columns)
    ids = links.select(F.lit("TICKER").alias("id_type"), F.concat_ws(":", "market", "symbol").alias("id_value"), F.col("target").alias("company_id"), F.lit(source).alias("source"))
    names = [c for c in xref.columns if c in ids.columns]
    return moved, xref.join(ids, ["id_type", "id_value"], "left_anti").select(names).unionByName(ids.select(names)), links


def missing_master(wanted: DataFrame, securities: DataFrame, ordinal: str = "_ord") -> DataFrame:
    """Placeholder records for the wanted listings (market, symbol) that have none: named by symbol, in the market's currency."""
    from ..sources.landing import market_currency

    rows = wanted.withColumn("symbol", normalize_symbol(F.col("market"), F.col("symbol"))).join(securities.select("market", "symbol"), ["market", "symbol"], "left_anti")
    return rows.select("market", "symbol", F.col("symbol").alias("name"), F.col("market").alias("country"), market_currency(F.col("market")).alias("currency"), F.lit("placeholder").alias("source"), ordinal)


def fill_leis(companies: DataFrame, xref: DataFrame, found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """companies without a LEI with the one ``found`` (company_id, lei) for them, and identifiers in which it replaces what was there."""
    fresh = companies.where("lei is null").select("company_id").join(found, "company_id")
    filled = companies.join(fresh.withColumnRenamed("lei", "_lei"), "company_id", "left").withColumn("lei", F.coalesce("lei", "_lei")).select(companies.columns)
    ids = fresh.groupBy(F.lit("LEI").alias("id_type"), F.col("lei").alias("id_value")).agg(F.max("company_id").alias("company_id"))
    return filled, xref.select("id_type", "id_value", "company_id").join(ids, ["id_type", "id_value"], "left_anti").unionByName(ids)


def peer_edges(pairs: DataFrame, securities: DataFrame) -> DataFrame:
    """Edges between the companies of listings and those of their peers (market, symbol, peer), each once and none to itself."""
    own = securities.select("market", "symbol", "company_id")
    other = own.withColumnsRenamed({"symbol": "peer", "company_id": "peer_company_id"})
    rows = pairs.withColumn("peer", normalize_symbol(F.col("market"), F.col("peer"))).join(own, ["market", "symbol"]).join(other, ["market", "peer"])
    return rows.where("company_id <> peer_company_id").select("company_id", "peer_company_id").distinct()


def peers_with_companies(pairs: DataFrame, companies: DataFrame, xref: DataFrame, securities: DataFrame, ordinal: str = "_ord") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Edges (company_id, peer_company_id) of all pairs (market, symbol, peer), and companies, identifiers and new listings after them.

    A peer that is not listed gets a company of its own, named by its symbol, or the one its name and country lead to.
    """
    wanted = pairs.select("market", F.col("peer").alias("symbol"), ordinal)
    wanted = wanted.withColumn("symbol", normalize_symbol(F.col("market"), F.col("symbol"))).groupBy("market", "symbol").agg(F.min(ordinal).alias(ordinal))
    records = written(missing_master(wanted, securities, ordinal), "unknown-peers")
    found, after, known = resolve(records, companies, xref, securities, ordinal)
    made = written(found.select("market", "symbol", "company_id"), "new-peers")
    listed = securities.select("market", "symbol", "company_id").unionByName(made)
    return peer_edges(pairs, listed), after, known, made


def linked_rank(securities: DataFrame) -> DataFrame:
    """Listings of each company, the primary first."""
    w = Window.partitionBy("company_id").orderBy(F.desc("is_primary"), "security_id")
    return securities.withColumn("rank", F.row_number().over(w))
