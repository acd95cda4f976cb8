"""Registered queries and their SQL."""

from __future__ import annotations

from anemora.queries import archives, places, problems, weather

MODULES = [problems, weather, places, archives]


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.ORACLES.items()}
