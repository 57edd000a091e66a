"""All queries of the library and their SQL, by name."""

from __future__ import annotations

from seriesloom.plans import audit_queries, base, match_queries, quality_queries, series_queries, source_queries  # noqa: F401

FLAGSHIP = "series_monthly_state"
QUERIES, SQL = base.QUERIES, base.SQL
