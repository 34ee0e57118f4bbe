"""Scores of extracted tables and text against gold ones."""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def numeric_f1(pred: Column, gold: Column) -> Column:
    """F1 over the multisets of digit strings; two empty sides score 1, one empty side 0."""

    def numbers(grid: Column) -> Column:
        tokens = F.flatten(F.transform(F.flatten(grid), lambda c: F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"(\d[\d,]*\.?\d*)"), F.lit(1))))
        return F.transform(tokens, lambda t: F.regexp_replace(t, r"\D", ""))

    p, g = numbers(pred), numbers(gold)
    count = lambda a, x: F.size(F.filter(a, lambda y: y == x))
    shared = F.aggregate(F.array_distinct(p), F.lit(0), lambda s, x: s + F.least(count(p, x), count(g, x)))
    return F.when((F.size(p) == 0) & (F.size(g) == 0), F.lit(1.0)).otherwise(F.coalesce(F.try_divide(2.0 * shared, F.size(p) + F.size(g)), F.lit(0.0)))


def _normal(grid: list) -> list[list[str]]:
    return [[re.sub(r"\s+", " ", "" if c is None else str(c)).strip().lower() for c in r] for r in grid]


def _align(a: list, b: list, drop, add, pair) -> float:
    """Least cost of aligning two sequences in order."""
    row = np.concatenate([[0.0], np.cumsum([add(y) for y in b])])
    for x in a:
        new = [row[0] + drop(x)]
        for j, y in enumerate(b):
            new.append(min(row[j + 1] + drop(x), new[-1] + add(y), row[j] + pair(x, y)))
        row = np.array(new)
    return float(row[-1])


def teds(pred: list, gold: list) -> float:
    """Tree-edit similarity of two tables as rows of cells."""
    a, b = _normal(pred), _normal(gold)
    if not a and not b:
        return 1.0
    node, one = (lambda r: 1 + len(r)), (lambda _: 1)
    cost = _align(a, b, node, node, lambda x, y: _align(x, y, one, one, lambda c, d: int(c != d)))
    return 1.0 - cost / (1 + max(sum(map(node, a)), sum(map(node, b))))


def grits_con(pred: list, gold: list) -> float:
    """F score of the cells that the best ordered alignment of rows has in common."""
    a, b = _normal(pred), _normal(gold)
    cells = sum(map(len, a)), sum(map(len, b))
    if not all(cells):
        return float(not any(cells))
    zero = lambda _: 0
    common = -_align(a, b, zero, zero, lambda x, y: _align(x, y, zero, zero, lambda c, d: -int(c == d)))
    return 2 * common / sum(cells)


@F.pandas_udf(DoubleType())
def teds_column(pred: pd.Series, gold: pd.Series) -> pd.Series:
    return pd.Series([teds(a, b) for a, b in zip(pred, gold, strict=True)])


@F.pandas_udf(DoubleType())
def grits_column(pred: pd.Series, gold: pd.Series) -> pd.Series:
    return pd.Series([grits_con(a, b) for a, b in zip(pred, gold, strict=True)])
