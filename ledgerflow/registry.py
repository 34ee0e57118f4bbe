"""All queries of the library with the SQL that gives the same rows."""

from __future__ import annotations

from .plans import catalogue, feeds, more, pages  # noqa: F401  the last three register their queries


def queries() -> dict[str, catalogue.Query]:
    return dict(catalogue.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(catalogue.SQL)
