"""All registered queries. Importing a query module registers what it holds."""

from __future__ import annotations

from presspulse.plans import q_articles, q_daily, q_features, q_forecast, q_market, q_scorers
from presspulse.plans.registry import ORACLES, QUERIES

MODULES = (q_market, q_articles, q_daily, q_features, q_forecast, q_scorers)

__all__ = ["MODULES", "ORACLES", "QUERIES"]
