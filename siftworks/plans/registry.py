"""Every query of the engine by name, with the SQL that says the same."""

from __future__ import annotations

from . import fixtures, queries, state_queries

QUERIES: dict = {**queries.QUERIES, **state_queries.QUERIES, **fixtures.QUERIES}
ORACLES: dict[str, str] = {**queries.ORACLES, **state_queries.ORACLES, **fixtures.ORACLES}
