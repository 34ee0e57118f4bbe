"""Statutes and other legal texts from a service whose JSON has no settled shape.

Its root may be wrapped in one key, a list of one may be a bare object, and keys
differ by category. ``repaired`` brings that into one shape first, in Arrow batches
of Python, since keys are data there; everything after it is column expressions.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from ..functions.scalars import strip

HOST = "https://www.law.go.kr"
#: Keys of a title in order of preference, and what ends a key that may hold one.
TITLE_KEYS = ("사건명", "법령명한글", "법령명", "행정규칙명", "자치법규명", "조약명", "별표명", "서식명", "제목")
TITLE_ENDS = ("명", "제목")
KEY_PARTS = ("일련번호", "ID", "번호")
#: Rows that leave Python at once.
SLICE = 1000


def objects(value: object) -> list[dict]:
    """The objects of a value that is one, a list of them, or neither."""
    return [v for v in value if isinstance(v, dict)] if isinstance(value, list) else [value] if isinstance(value, dict) else []


def parsed(text: str | None) -> dict:
    """The object of a payload, out of its one wrapping key if it has one; an empty one for anything else."""
    try:
        found = json.loads(text or "")
    except ValueError:
        return {}
    if not isinstance(found, dict):
        return {}
    inner = next(iter(found.values())) if len(found) == 1 else None
    return inner if isinstance(inner, dict) else found


def listed(root: dict, names: tuple[str, ...] = ()) -> list[dict]:
    """The items of a result: under one of ``names``, else the first list of objects, else the first object with four keys or more."""
    for name in names:
        if name in root:
            return objects(root[name])
    lists = (v for v in root.values() if isinstance(v, list) and v and isinstance(v[0], dict))
    single = ([v] for v in root.values() if isinstance(v, dict) and len(v) >= 4)
    return next(lists, None) or next(single, [])


def _texts(node: dict) -> Iterator[str]:
    for key in ("항내용", "호내용", "목내용"):
        if node.get(key):
            yield str(node[key]).strip()
    for key in ("항", "호", "목"):
        for child in objects(node.get(key)):
            yield from _texts(child)


def _articles(root: dict) -> list[dict]:
    jo = root.get("조문")
    out = []
    for unit in objects(jo.get("조문단위") if isinstance(jo, dict) else jo):
        parts = [str(unit["조문내용"]).strip()] if unit.get("조문내용") else []
        content = "\n".join(p for p in [*parts, *_texts(unit)] if p)
        if unit.get("조문여부") == "조문" and (content or unit.get("조문번호")):
            out.append({"no": str(unit.get("조문번호") or ""), "title": unit.get("조문제목") or None, "content": content})
    return out


def _raw(item: dict) -> dict:
    """Key, title and text of an item of any category."""
    filled = {k: v for k, v in item.items() if v not in (None, "")}
    key = next((v for part in KEY_PARTS for k, v in filled.items() if part in k), None)
    if key is None:
        key = hashlib.sha1(json.dumps(item, ensure_ascii=False, sort_keys=True).encode()).hexdigest()[:16]
    title = next((str(item[k]) for k in TITLE_KEYS if item.get(k)), None)
    if title is None:
        title = max((v for k, v in filled.items() if isinstance(v, str) and k.endswith(TITLE_ENDS)), key=len, default=None)
    return {"key": str(key), "title": title, "payload": json.dumps(item, ensure_ascii=False)}


_RAW = T.StructType([T.StructField(n, T.StringType()) for n in ("key", "title", "payload")])
_ARTICLE = T.StructType([T.StructField(n, T.StringType()) for n in ("no", "title", "content")])
SHAPES: dict[str, tuple[T.DataType, Callable[[dict], object]]] = {
    "items": (T.ArrayType(T.StringType()), lambda root: (json.dumps(x, ensure_ascii=False) for x in listed(root, ("law", "Law")))),
    "articles": (T.ArrayType(_ARTICLE), _articles),
    "raw": (T.ArrayType(_RAW), lambda root: (_raw(x) for x in listed(root))),
    "one": (T.ArrayType(_RAW), lambda root: [_raw(root)]),
    "root": (T.StringType(), lambda root: json.dumps(root, ensure_ascii=False)),
}


def repaired(payload: Column, shape: str) -> Column:
    """A payload in one of SHAPES."""
    kind, get = SHAPES[shape]

    def run(texts: pd.Series) -> pd.Series:
        found = (get(parsed(t)) for t in texts)
        return pd.Series([x if isinstance(x, str) else list(x) for x in found], dtype=object)

    return F.pandas_udf(run, kind)(payload)


def unfolded(df: DataFrame, keep: list[str], shape: str) -> DataFrame:
    """A row for each element of payloads in one of the SHAPES that are lists: ``keep``, ``ord`` and ``x``; one payload is open at a time, and rows leave in slices."""
    kind, get = SHAPES[shape]
    rows = df.select(*keep, "payload")
    schema = T.StructType([*(rows.schema[k] for k in keep), T.StructField("ord", T.IntegerType()), T.StructField("x", kind.elementType)])
    element = to_arrow_type(kind.elementType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, ords, found = [], [], []
            for i, text in enumerate(batch.column("payload")):
                for n, x in enumerate(get(parsed(text.as_py()))):
                    at.append(i), ords.append(n), found.append(x)
                    if len(at) == SLICE:
                        yield _slice(batch, at, ords, found)
                        at, ords, found = [], [], []
            if at:
                yield _slice(batch, at, ords, found)

    def _slice(batch: pa.RecordBatch, at: list[int], ords: list[int], found: list) -> pa.RecordBatch:
        kept = batch.select(keep).take(pa.array(at, pa.int32()))
        return pa.RecordBatch.from_arrays([*kept.columns, pa.array(ords, pa.int32()), pa.array(found, element)], names=schema.names)

    return rows.mapInArrow(run, schema)


def _pick(*names: str) -> Column:
    return F.coalesce(*(F.nullif(F.get_json_object("item", f"$['{n}']"), F.lit("")) for n in names))


def _entries(df: DataFrame, keep: list[str]) -> DataFrame:
    rows = unfolded(df, keep, "items").withColumnRenamed("x", "item")
    return rows.select(*keep, "ord", "item", _pick("법령ID").alias("law_id"), _pick("법령일련번호").alias("law_serial_no")).where("law_id is not null and law_serial_no is not null")


def statutes(df: DataFrame, keep: list[str]) -> DataFrame:
    """Statutes of a search; items without id or serial number go, links become whole."""
    link = _pick("법령상세링크")
    return _entries(df, keep).select(*keep, "ord", "law_id", "law_serial_no", F.coalesce(_pick("법령명한글", "법령명"), F.lit("")).alias("name"), _pick("법령약칭명").alias("name_abbrev"), _pick("법령구분명").alias("law_type"), _pick("소관부처명").alias("department"), _pick("공포일자").alias("promulgation_date"), _pick("공포번호").alias("promulgation_no"), _pick("시행일자").alias("enforcement_date"), _pick("제개정구분명").alias("revision_type"), F.when(link.startswith("/"), F.concat(F.lit(HOST), link)).otherwise(link).alias("detail_url"))


def articles(df: DataFrame, keep: list[str]) -> DataFrame:
    """Articles of a statute's text in order, without headings of parts; an article's text is its own with that of its clauses."""
    return unfolded(df, keep, "articles").withColumnRenamed("x", "a").select(*keep, "ord", F.col("a.no").alias("article_no"), F.col("a.title").alias("article_title"), F.col("a.content").alias("content"))


def exact_names(queries: DataFrame, found: DataFrame) -> DataFrame:
    """For each query (query, law_id or null) the registered name to ask for: the first statute found with that id, else the first found, else the query."""
    hits = queries.join(found.select("query", "ord", F.col("law_id").alias("_id"), "name"), "query", "left")
    order = F.struct(F.coalesce(F.col("_id") != F.col("law_id"), F.lit(False)), F.coalesce("ord", F.lit(0)))
    best = hits.groupBy("query", "law_id").agg(F.min_by("name", order).alias("name"))
    return best.select("query", "law_id", F.coalesce("name", "query").alias("name"))


def history(df: DataFrame) -> DataFrame:
    """Versions of statutes (query, law_id, payload), of that law alone where one is asked for."""
    rows = _entries(df.withColumnRenamed("law_id", "_asked"), ["query", "_asked"]).where("_asked is null or _asked = law_id")
    return rows.select("query", "ord", "law_id", "law_serial_no", F.coalesce(_pick("법령명한글", "법령명"), F.lit("")).alias("name"), _pick("시행일자").alias("enforcement_date"), _pick("공포일자").alias("promulgation_date"), _pick("제개정구분명").alias("revision_type"), _pick("현행연혁코드").alias("status"))


def translations(df: DataFrame, keep: list[str]) -> DataFrame:
    """English name and text, the articles' texts one a line; null where there is none."""
    root = df.select(*keep, repaired(F.col("payload"), "root").alias("item"))
    jo = F.get_json_object("item", "$.JoSection.Jo")
    listed_ = F.when(F.trim(jo).startswith("["), F.from_json(jo, "array<struct<joCts: string>>")).otherwise(F.array(F.from_json(jo, "joCts string")))
    texts = F.filter(F.transform(listed_, lambda a: a["joCts"]), lambda t: t.isNotNull() & (t != ""))
    return root.select(*keep, F.get_json_object("item", "$.InfSection.lsId").alias("law_id"), F.coalesce(F.get_json_object("item", "$.InfSection.lsNmEng"), F.lit("")).alias("name_en"), F.nullif(F.array_join(texts, "\n"), F.lit("")).alias("content_en"))


def comparison(df: DataFrame, keep: list[str]) -> DataFrame:
    """Old and new text of each article by a full outer join on its number, ordered by the number's length and text; of a repeated number the last."""
    root = df.select(*keep, repaired(F.col("payload"), "root").alias("item"))

    def side(name: str, out: str) -> DataFrame:
        found = F.get_json_object("item", f"$['{name}']['조문']")
        listed_ = F.when(F.trim(found).startswith("["), F.from_json(found, "array<struct<no: string, content: string>>")).otherwise(F.array(F.from_json(found, "no string, content string")))
        rows = root.select(*keep, F.posexplode(listed_).alias("ord", "a")).where("a is not null")
        return rows.groupBy(*keep, F.coalesce("a.no", F.lit("None")).alias("article_no")).agg(F.max_by(F.struct(F.col("a.content").alias("c")), "ord").alias("x")).select(*keep, "article_no", F.col("x.c").alias(out))

    both = side("구조문목록", "old_text").join(side("신조문목록", "new_text"), [*keep, "article_no"], "full_outer")
    return both.where("old_text is not null or new_text is not null").orderBy(*keep, F.length("article_no"), "article_no")


def raw_items(df: DataFrame, keep: list[str]) -> DataFrame:
    """Items of any category by key and title, their JSON kept."""
    return unfolded(df, keep, "raw").withColumnRenamed("x", "i").select(*keep, "ord", F.col("i.key").alias("item_key"), "i.title", F.col("i.payload").alias("payload_json"))


def raw_item(df: DataFrame, keep: list[str], hint: str | None = None) -> DataFrame:
    """The one item of each payload; its key is the id it was asked by, where there is one."""
    rows = df.select(*keep, *([hint] if hint and hint not in keep else []), F.get(repaired(F.col("payload"), "one"), F.lit(0)).alias("i"))
    key = F.coalesce(F.nullif(strip(F.col(hint).cast("string")), F.lit("")), "i.key") if hint else F.col("i.key")
    return rows.select(*keep, key.alias("item_key"), "i.title", F.col("i.payload").alias("payload_json"))
