"""The gold matrix: seven cases in three languages."""

from ledgerflow.operators import gold


def test_every_case_is_read_whole(spark):
    pages, answers = gold.cases(spark)
    got = {r["category"]: r for r in gold.score(pages, answers).collect()}
    assert set(got) == {f"{p}/{k}" for p in ("US/en", "KR/ko", "HK/zh") for k in ("table", "prose")} | {"US/en/split-table", "overall"}
    for name, r in got.items():
        if name.endswith("table"):
            assert (r["teds"], r["grits"], r["numeric_em"], r["continuity"]) == (1.0, 1.0, 1.0, None), name
        elif name.endswith("prose"):
            assert (r["teds"], r["continuity"]) == (None, 1.0), name
    assert got["overall"]["n_cases"] == 7 and pages.where("doc_id = 'en-split'").count() == 3


def test_damage_shows(spark):
    pages, answers = gold.cases(spark)
    got = {r["category"]: r for r in gold.score(pages.where("page_no = 1"), answers).collect()}
    assert got["US/en/split-table"]["teds"] < 0.6 and got["US/en/table"]["teds"] == 1.0 and got["KR/ko/prose"]["continuity"] < 1
