"""Registered queries against their SQL counterparts, and the shape of their plans."""

from __future__ import annotations

import pytest

from checks.compare import compare, duck
from checks.operator_queries import QUERIES
from checks.queries import oracle_sql, queries
from fleetgauge.plans.registry import BY_NAME
from fleetgauge.sources import fixtures
from tests.conftest import SF_DIR

# plans that write shared frames first
SLOW = {"run_report", "run_report_r026"}
# One per shape; `python -m checks.compare` runs them all.
SAMPLE = [
    "compliance_total", "compliance_failed", "kpi_assets", "never_seen", "acc_manufacturer", "fresh_model", "acc_mac",
    "fresh_user", "acc_os", "fresh_entity", "acc_responsible", "fresh_building", "fresh_all_30c", "support_error",
    "os_name", "os_support_class", "patch_targeted", "patch_total_connected",
    "sql_text_kpi", "sql_file_kpi", "sql_report_directory", "recompute_day", "recompute_month", "retention_daily",
    "ledger_pending_daily", "ledger_pending_monthly", "purge_day_only", "run_report_r014", "filter_not_in", "col_contains_col",
    "join_left_org", "join_two_roles", "latest_per_key", "latest_per_norm_key", "assign_ids", "org_dimension", "os_clean",
    "os_parts", "regex_replace_first", "case_nested", "asset_latest", "campaign_membership", "attribute_codes", "unit_upsert",
    "kpi_upsert", "root_label", "shared_label", "daily_fact", "monthly_avg", "monthly_labelled",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows_as_sql(spark, con, name):
    verdict, _, _ = compare(spark, con, SF_DIR, queries()[name], oracle_sql()[name])
    assert verdict == "ok"


def test_every_query_has_a_counterpart():
    assert set(queries()) == set(oracle_sql()) == set(BY_NAME) | set(QUERIES)


@pytest.fixture(scope="module")
def without_broadcasts(spark):
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    fixtures._OPEN.pop(spark, None)  # frames planned before keep their plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    fixtures._OPEN.pop(spark, None)


@pytest.mark.parametrize("name", [n for n in SAMPLE if n not in SLOW])
def test_plan_stays_distributed(without_broadcasts, name):
    """Without broadcasts, as with large tables: no cross or nested-loop join, no Python."""
    plan = queries()[name](without_broadcasts, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BroadcastExchange", "PythonUDF", "InPandas"):
        assert word not in plan


def test_scans_read_only_what_is_needed(spark):
    plan = queries()["kpi_assets"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan and "c_acctbal" not in plan
    agent = queries()["acc_manufacturer"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "p_brand" not in agent and "l_suppkey" not in agent
