"""Driver queries over the supplied tables, each with its DuckDB oracle."""

from quarry.plans import (clean_plans, learn_plans, similar_plans, source_plans, stream_plans,  # noqa: F401
                          table_plans, text_plans)
from quarry.plans.registry import REGISTRY


def queries():
    return {name: e.build for name, e in REGISTRY.items()}


def oracle_sql():
    return {name: e.sql for name, e in REGISTRY.items() if e.sql}
