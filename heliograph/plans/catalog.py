"""The queries of the reference's own operators and their SQL."""

from __future__ import annotations

from heliograph.plans import lifecycle, profiles, records, relational, retrieval, texts

_MODULES = [retrieval, relational, lifecycle, texts, records, profiles]


def queries():
    return {k: v for m in _MODULES for k, v in m.QUERIES.items()}


def oracle_sql():
    return {k: v for m in _MODULES for k, v in m.SQL.items()}
