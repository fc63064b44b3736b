"""All core queries and their SQL."""

from __future__ import annotations

from tidemark.plans import backtest, features, ingest, market_problems, pit, reports

MODULES = [market_problems, features, pit, backtest, reports, ingest]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def oracles() -> dict:
    return {k: v for m in MODULES for k, v in m.ORACLES.items()}
