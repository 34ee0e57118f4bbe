"""Entity resolution against a plain fold over all records in order."""

import random

import pytest

from ledgerflow.operators import entities as E
from ledgerflow.plans import tables


def fold(records, companies, xref, listings):
    """Every record in turn against one set of dictionaries."""
    companies = {k: dict(v) for k, v in companies.items()}
    xref, listings, out = dict(xref), dict(listings), {}
    for r in sorted(records, key=lambda r: ((r.get("security_type") or "COMMON") in ("ADR", "GDR"), r["_ord"])):
        adr = (r.get("security_type") or "COMMON") in ("ADR", "GDR")
        at, c = (r["market"], r["symbol"]), None
        if adr:
            c = xref.get(("ISIN", r.get("underlying_isin")))
            u = r.get("underlying_symbol")
            if c is None and u:
                c = (listings.get(tuple(u.split(":", 1))) if ":" in u else None) or xref.get(("TICKER", u))
        ids = [(k, r.get(k.lower())) for k in ("LEI", "CIK", "CORP_CODE", "ISIN") if r.get(k.lower())]
        if c is not None:
            ids = [x for x in ids if x[0] != "CORP_CODE"]
        else:
            c = next((xref[x] for x in ids if x in xref), None)
            if c is None and not adr and r.get("name"):
                c = next((k for k, v in sorted(companies.items()) if (v.get("name") or "").lower() == r["name"].strip().lower() and v.get("country") == r.get("country")), None)
        if c is None:
            c = max(companies, default=0) + 1
            companies[c] = {k: r.get(k) for k in E.FILLED}
        else:
            for k in E.FILLED:
                companies[c][k] = companies[c].get(k) if companies[c].get(k) is not None else r.get(k)
        for x in ids:
            xref.setdefault(x, c)
        if at not in listings:
            xref.setdefault(("TICKER", ":".join(at)), c)
        listings[at] = c
        if r.get("isin"):
            xref.setdefault(("ISIN", r["isin"]), c)
        out[r["_ord"]] = c
    return out, companies, xref


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_a_fold(spark, seed):
    r = random.Random(seed)
    pick = lambda p, n, n_max: f"{p}{r.randrange(n_max)}" if r.random() < n else None
    records = []
    for i in range(120):
        kind = r.choice(["COMMON", "COMMON", None, "ADR", "GDR"])
        records.append({"market": "US", "symbol": f"S{r.randrange(90)}", "security_type": kind, "name": pick("Name", 0.8, 60), "country": pick("C", 0.6, 2), "lei": pick("L", 0.2, 30), "cik": pick("K", 0.3, 40), "corp_code": pick("P", 0.1, 20), "isin": pick("I", 0.3, 50), "underlying_isin": pick("I", 0.4, 50) if kind in ("ADR", "GDR") else None, "underlying_symbol": r.choice([None, f"US:S{r.randrange(90)}"]) if kind in ("ADR", "GDR") else None, "_ord": i})
    names = ["market", "symbol", "security_type", "name", "country", "lei", "cik", "corp_code", "isin", "underlying_isin", "underlying_symbol"]
    schema = ", ".join(f"{n} string" for n in names) + ", _ord long"
    old = {i: {"name": f"Name{i}", "country": "C0"} for i in range(1, 8)}
    companies = spark.createDataFrame([(i, v["name"], v["country"]) for i, v in old.items()], "company_id long, name string, country string")
    for c in E.FILLED:
        if c not in companies.columns:
            companies = companies.selectExpr("*", f"cast(null as string) as {c}")
    xref = {("ISIN", "I3"): 2, ("CIK", "K1"): 5, ("TICKER", "US:S4"): 3}
    listings = {("US", "S4"): 3}
    ids = spark.createDataFrame([(k, v, c) for (k, v), c in xref.items()], "id_type string, id_value string, company_id long")
    secs = spark.createDataFrame([(m, s, c) for (m, s), c in listings.items()], "market string, symbol string, company_id long")
    got, after, known = E.resolve(spark.createDataFrame([tuple(x[n] for n in names) + (x["_ord"],) for x in records], schema), companies, ids, secs)
    want, rows, refs = fold(records, {k: {c: v.get(c) for c in E.FILLED} for k, v in old.items()}, xref, listings)
    assert {x["_ord"]: x["company_id"] for x in got.collect()} == want
    assert {x["company_id"]: {c: x[c] for c in E.FILLED} for x in after.collect()} == rows
    assert {(x["id_type"], x["id_value"]): x["company_id"] for x in known.collect()} == refs


def test_receipt_joins_its_underlying(spark):
    schema = "market string, symbol string, name string, security_type string, isin string, underlying_isin string, _ord long"
    rows = spark.createDataFrame([("US", "BABA", "Alibaba ADR", "ADR", "US01", "KYG1", 1), ("HK", "9988", "Alibaba", None, "KYG1", None, 2)], schema)
    empty = tables.create(spark, ["companies", "identifier_xref", "securities"])
    got, companies, _ = E.resolve(rows, empty["companies"], empty["identifier_xref"], empty["securities"])
    assert {(r["symbol"], r["company_id"]) for r in got.collect()} == {("BABA", 1), ("09988", 1)} and companies.count() == 1


def securities(spark):
    return spark.createDataFrame([(1, "US", "A", 10), (2, "HK", "00700", 11), (3, "KR", "005930", 12), (4, "US", "B", 13)], "security_id long, market string, symbol string, company_id long")


def test_overrides_in_order(spark):
    rows = [("g1", "us", " A ", 1), ("g1", "HK", "700", 2), ("g2", "HK", "700", 3), ("g2", "KR", "5930", 4), ("g3", "US", "none", 5), ("", "US", "B", 6)]
    members = E.overrides_of(spark.createDataFrame(rows, "group string, market string, symbol string, _ord long"))
    xref = spark.createDataFrame([("TICKER", "HK:00700", 11, "x")], "id_type string, id_value string, company_id long, source string")
    moved, ids, links = E.apply_overrides(members, securities(spark), xref)
    assert {r["symbol"]: r["company_id"] for r in moved.collect()} == {"A": 10, "00700": 10, "005930": 10, "B": 13}
    assert {r["id_value"]: (r["company_id"], r["source"]) for r in ids.collect()} == {"US:A": (10, "override"), "HK:00700": (10, "override"), "KR:005930": (10, "override")} and links.count() == 3


def test_links_and_placeholders(spark):
    moved, _, links = E.apply_overrides(E.tokens(spark, ["zz", "HK:700", "B"]), securities(spark), spark.createDataFrame([], "id_type string, id_value string, company_id long"), "manual")
    assert {r["symbol"]: r["company_id"] for r in moved.collect()}["B"] == 11 and links.count() == 2
    wanted = spark.createDataFrame([("KR", "5930", 1), ("KR", "660", 2)], "market string, symbol string, _ord long")
    assert [(r["symbol"], r["currency"], r["source"]) for r in E.missing_master(wanted, securities(spark)).collect()] == [("000660", "KRW", "placeholder")]
