"""Named query catalogue (Spark builders + DuckDB oracle SQL)."""

from stockpulse.plans import catalogue, q_checks, q_customers, q_features, q_forecast, q_store, q_views  # noqa: F401  (registration)
from stockpulse.plans.catalogue import REGISTRY, Query, finish, run, wrap_sql
from stockpulse.plans.oracle_base import BASE_CTES


def all_ctes():
    return list(BASE_CTES) + q_customers.CTES + q_forecast.CTES + q_views.CTES + q_checks.CTES


__all__ = ["REGISTRY", "Query", "finish", "run", "wrap_sql", "all_ctes"]
