"""Collects the driver queries and their oracle SQL from the plan modules."""

from __future__ import annotations


DAILY = ("attributed_campaign_blend", "attributed_spend_blend", "regional_commerce_forecast", "subsource_stack")
SUNDAY = ("app_install_blend",)


def _load():
    from blendwise.plans import (  # noqa: F401  (each module registers its queries)
        operator_queries, operator_queries2, operator_queries3, operator_queries4, report_queries,
        report_queries2, report_queries3, report_queries4)
    from blendwise.plans.oracle import SQL
    from blendwise.plans.queries import RANGE, RANGED
    for name in RANGED:  # a report over a range is the rows of the whole report that touch it
        first, last = (f"DATE '{d}'" for d in RANGE)
        if name in DAILY:
            low = first
        else:
            week = f"CAST(date_trunc('week', {first} + 1) AS DATE) - 1" if name in SUNDAY else f"date_trunc('week', {first})"
            low = f"CASE date_granularity WHEN 'week' THEN {week} ELSE date_trunc(date_granularity, {first}) END"
        SQL[f"{name}_range"] = f"SELECT * FROM ({SQL[name]}) r WHERE date <= {last} AND date >= {low}"


def queries():
    _load()
    from blendwise.plans.queries import QUERIES
    return dict(QUERIES)


def oracle_sql():
    _load()
    from blendwise.plans.oracle import SQL
    return dict(SQL)
