"""Collects the named queries and their oracle SQL from the plan modules."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

PLAN_MODULES = [
    "cartwheel.plans.ingest",
    "cartwheel.plans.analytics",
    "cartwheel.plans.orders_export",
    "cartwheel.plans.constraints",
    "cartwheel.plans.marketplace",
    "cartwheel.plans.clickstream",
    "cartwheel.plans.click_refresh",
    "cartwheel.plans.warehouse",
    "cartwheel.plans.history",
    "cartwheel.plans.incremental",
]


def _modules():
    return [importlib.import_module(m) for m in PLAN_MODULES]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for mod in _modules():
        for name, fn in mod.QUERIES.items():
            assert name not in out, name
            out[name] = fn
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for mod in _modules():
        out.update(getattr(mod, "ORACLE", {}))
    return out
