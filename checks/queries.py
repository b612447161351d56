"""The registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.kpi_sql import kpi_sql
from checks import store_queries  # noqa: F401  registers its queries
from checks.operator_queries import EXTRA_VIEWS, QUERIES
from checks.sql_text import with_views
from fleetgauge.plans.registry import BY_NAME, compute_one
from fleetgauge.sources.fixtures import AS_OF, driver_sources

Query = Callable[[SparkSession, str], DataFrame]


def _kpi(name: str) -> Query:
    return lambda spark, sf_dir: compute_one(driver_sources(spark, sf_dir), AS_OF, name)


def _operator(name: str) -> Query:
    return lambda spark, sf_dir: QUERIES[name][0](driver_sources(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {n: _kpi(n) for n in BY_NAME} | {n: _operator(n) for n in QUERIES}


def oracle_sql() -> dict[str, str]:
    kpis = {n: with_views(kpi_sql(n)) for n in BY_NAME}
    return kpis | {n: with_views(sql, EXTRA_VIEWS) for n, (_, sql) in QUERIES.items()}
