"""The physical plans: one scan where one is enough, pruned columns, no cross joins."""

import re
from datetime import date

import pytest

from loadstar.operators.bootstrap import carrier_bootstrap
from loadstar.plans.catalog import QUERIES
from tests.small import make_star, shipment

# Fact scans beyond one, and why.
SCANS = {
    "zscore_otp_anomalies": 2,  # weekly OTP, then the flagged weeks' shipments
    "dq_report": 2,  # checks of single rows, then the keys
    "grown_v_weekly_kpis": 0,  # stored parts serve these
    "grown_v_carrier_scorecard": 0,
    "grown_v_lane_performance": 0,
    "grown_v_shipper_costtoserve": 0,
    "active_parties_month": 0,
    "health_filtered": 2,  # health, and pricing advice
}
ONE_SCAN = [
    "q01_top10_lanes_by_volume",
    "q02_otp_by_carrier_tier",
    "q03_dwell_percentiles_by_carrier",
    "q10_dwell_outliers_by_lane",
    "q19_trailer_utilization_by_service",
    "v_carrier_scorecard",
    "carrier_filtered",
    "dq_fk_orphans",
    "q23_carrier_concentration",
    "q24_shipper_volume_pareto",
    "q29_lanes_dwell_spike",
    "q32_chi_square",
    "q33_mann_whitney",
    "q34_null_audit",
    "v_shipper_health",
    "iqr_cost_anomalies",
    "pricing_recommendations",
    "exec_kpi_period_delta",
    "global_rank",
    "classify_shipper_tier",
]


def final_plan(df):
    """Formatted plan after execution: final trees only, and node details."""
    df.collect()
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    blocks = re.split(r"(?:Subquery:\d+)", text)
    trees = "".join(b.split("== Initial Plan ==")[0].split("\n(1) ")[0] for b in blocks)
    return trees, text


def fact_scans(df):
    trees, text = final_plan(df)
    scans = []
    for number in set(re.findall(r"Scan parquet\s+\((\d+)\)", trees)):
        detail = re.search(rf"\n\({number}\) Scan parquet.*?\n\n", text, re.S).group(0)
        if "fact_shipment" in detail:
            scans.append(detail)
    return scans


@pytest.mark.parametrize("name", ONE_SCAN)
def test_reads_the_fact_once(name, stored):
    # an empty result may let Spark drop the whole plan
    assert len(fact_scans(QUERIES[name](stored))) <= 1


@pytest.mark.parametrize("name", sorted(SCANS))
def test_reads_the_fact_no_more_than_needed(name, stored):
    assert len(fact_scans(QUERIES[name](stored))) <= SCANS[name]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python(name, stored):
    plan = QUERIES[name](stored)._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert word not in plan


def test_only_needed_columns_are_read(stored):
    (scan,) = fact_scans(QUERIES["q09_defect_reason_pareto"](stored))
    assert "ReadSchema: struct<defect_flag:boolean,defect_reason:string>" in scan


def test_recent_days_prune_months(stored):
    (scan,) = fact_scans(QUERIES["v_anomaly_flags"](stored))
    assert "GreaterThanOrEqual(shipment_date_key,20241217)" in scan
    assert "(ship_month" in scan.split("PartitionFilters")[1].split("\n")[0]


def test_draws_are_made_inside_tasks(spark):
    """Resamples leave a task as sums: nothing is joined with draws, and no row is a draw."""
    star = make_star(spark, [shipment(i, date(2024, 1, 5)) for i in range(40)])
    trees, _ = final_plan(carrier_bootstrap(star, reps=20, draw=10))
    above = trees.split("MapInArrow")[0]
    assert "MapInArrow" in trees and "Join" not in above and "Generate" not in above
