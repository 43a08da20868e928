"""All core queries and their SQL."""

from __future__ import annotations

from clipwright.plans import curation, exchange, profiles, skewed, voices

MODULES = (skewed, curation, profiles, voices, exchange)


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
