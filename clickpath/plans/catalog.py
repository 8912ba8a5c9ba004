"""Every registered query of the session engine and its SQL."""

from __future__ import annotations

from .oracle import oracle_sql as _tables_sql
from .queries import QUERIES as _TABLE_QUERIES
from .stream_oracle import stream_oracle_sql
from .stream_queries import STREAM_QUERIES

QUERIES = _TABLE_QUERIES | STREAM_QUERIES


def oracle_sql() -> dict[str, str]:
    return _tables_sql() | stream_oracle_sql()
