"""The datasets behind the dashboard pages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstar.functions.measures import gather, kpi, merge, part_aggregates
from loadstar.functions.numeric import percent, rounded
from loadstar.operators.network import by_week
from loadstar.operators.pricing import pricing_recommendations
from loadstar.operators.shippers import shipper_health
from loadstar.operators.views import anomaly_summary, carrier_scorecard, lane_performance
from loadstar.star import Star, lane_label, shipped_since


def _matching(df: DataFrame, **wanted: str | None) -> DataFrame:
    """Rows where every given column has its wanted value; None means any."""
    conditions = [F.col(c) == v for c, v in wanted.items() if v is not None]
    return df.where(reduce(Column.__and__, conditions)) if conditions else df


def kpi_period_delta(
    star: Star, *, as_of: date | None = None, days: int = 30
) -> DataFrame:
    """Four KPIs of the last ``days`` days, of the days before, and the change."""
    today = star.resolve_as_of(as_of)
    kpis = ["otp_rate", "avg_dwell", "defect_rate", "avg_cost"]
    halves = (
        star.last_days(today, 2 * days)
        .groupBy(shipped_since(today - timedelta(days=days)).alias("is_current"))
        .agg(*part_aggregates(kpis))
        .select(
            "is_current",
            percent(kpi("otp_rate")).alias("otp"),
            rounded(kpi("avg_dwell"), 1).alias("dwell"),
            percent(kpi("defect_rate"), 2).alias("defect"),
            rounded(kpi("avg_cost")).alias("cost"),
        )
    )
    names = ["otp", "dwell", "defect", "cost"]
    sides = halves.agg(
        *[F.max(F.when(F.col("is_current"), F.col(n))).alias(n) for n in names],
        *[F.max(F.when(~F.col("is_current"), F.col(n))).alias(f"prior_{n}") for n in names],
    )
    changes = [
        rounded(F.col(n) - F.col(f"prior_{n}"), 2).alias(f"{n}_delta") for n in names
    ]
    return sides.select(*sides.columns, *changes)


def weekly_otp_trailing(
    star: Star, *, weeks: int = 26, week_key: str = "iso"
) -> DataFrame:
    """The last ``weeks`` weeks of network OTP."""
    return (
        by_week(star, ["otp_rate"], week_key)
        .orderBy(F.desc("year"), F.desc("week_of_year"))
        .limit(weeks)
        .select("week_start", (kpi("otp_rate") * 100).alias("otp_pct"))
        .orderBy("week_start")
    )


def top_issues(
    star: Star,
    *,
    as_of: date | None = None,
    days: int = 14,
    otp_max: float = 0.80,
    limit: int = 5,
) -> DataFrame:
    """The worst carrier-lanes of the period."""
    return anomaly_summary(
        star, as_of=as_of, days=days, otp_max=otp_max, limit=limit
    ).select(
        "carrier_name",
        "carrier_tier",
        "lane_label",
        F.col("avg_otp_pct").alias("avg_otp"),
        F.col("total_volume").alias("volume"),
    )


def health_filtered(
    star: Star,
    *,
    as_of: date | None = None,
    vendor_type: str | None = None,
    ship_volume_tier: str | None = None,
    industry_segment: str | None = None,
    limit: int = 50,
) -> DataFrame:
    """The healthiest shippers under optional filters, with any pricing advice."""
    star, today = star.at(as_of)
    health = _matching(
        shipper_health(star, as_of=today),
        vendor_type=vendor_type,
        ship_volume_tier=ship_volume_tier,
        industry_segment=industry_segment,
    )
    best = health.orderBy(F.desc("shipper_health_score"), "shipper_id").limit(limit)
    advice = pricing_recommendations(star, as_of=today).select(
        "shipper_id", "recommendation", "pct_change", "driver_1"
    )
    return (
        best.join(advice, "shipper_id", "left")
        .select(
            "shipper_id",
            "shipper_name",
            "vendor_type",
            "ship_volume_tier",
            "total_shipments",
            "otd_rate",
            "avg_cost_per_shipment",
            "growth_rate",
            "service_score",
            "cost_score",
            "growth_score",
            "reliability_score",
            "shipper_health_score",
            "recommendation",
            "pct_change",
            "driver_1",
        )
        .orderBy(F.desc("shipper_health_score"), "shipper_id")
    )


def lane_otp_pivot(star: Star, *, nodes: Sequence[str] | None = None) -> DataFrame:
    """Origin rows x destination-node columns of OTP %.

    A table's columns must be named before it is computed, so the caller names the
    ``nodes`` wanted. Without them the result stays long: one row per origin and node.
    """
    lanes = gather(star.fact, ["lane_id"], ["otp_rate"]).join(star.lane, "lane_id")
    cells = merge(lanes, ["origin_city", "dest_fc_id"], ["otp_rate"])
    rows = cells.select(
        F.col("origin_city").alias("origin"),
        "dest_fc_id",
        percent(kpi("otp_rate")).alias("otp"),
    )
    if nodes is None:
        return rows.orderBy("origin", "dest_fc_id")
    return (
        rows.groupBy("origin")
        .pivot("dest_fc_id", list(nodes))
        .agg(F.first("otp"))
        .orderBy("origin")
    )


def lane_best_worst(star: Star, *, limit: int = 10) -> DataFrame:
    """The lanes with the highest and the lowest OTP; busier lanes win ties."""
    columns = [
        "origin_city",
        "dest_fc_id",
        "shipment_count",
        "otp_rate",
        "avg_cost_per_mile",
    ]
    lanes = lane_performance(star)

    def side(name: str, first: Column) -> DataFrame:
        ends = lanes.orderBy(first, F.desc("shipment_count"), "lane_id").limit(limit)
        return ends.select(F.lit(name).alias("side"), *columns)

    return side("best", F.desc("otp_rate")).unionByName(
        side("worst", F.asc("otp_rate"))
    )


def carrier_filtered(star: Star, *, tier: str | None = None) -> DataFrame:
    """The carrier scorecard, optionally of one tier."""
    return _matching(carrier_scorecard(star), carrier_tier=tier).select(
        "carrier_name",
        "carrier_tier",
        "shipment_count",
        "otp_rate",
        "otd_rate",
        "dwell_p90",
        "defect_rate",
        "avg_cost_per_mile",
    )


def carrier_lane_mix(
    star: Star, *, carrier_name: str | None = None, limit: int = 15
) -> DataFrame:
    """The busiest lanes of one carrier, or of every carrier."""
    kpis = ["n", "otp_rate", "cpm"]
    pairs = (
        gather(star.fact, ["carrier_id", "lane_id"], kpis)
        .join(_matching(star.carrier, carrier_name=carrier_name), "carrier_id")
        .join(star.lane, "lane_id")
        .withColumn("lane", lane_label())
    )
    busiest = Window.partitionBy("carrier_name").orderBy(F.desc("n"), "lane")
    return (
        merge(pairs, ["carrier_name", "lane"], kpis)
        .withColumn("place", F.row_number().over(busiest))
        .where(F.col("place") <= limit)
        .select(
            "carrier_name",
            "lane",
            F.col("n").alias("volume"),
            percent(kpi("otp_rate")).alias("otp_pct"),
            rounded(kpi("cpm"), 2).alias("cpm"),
        )
        .orderBy("carrier_name", F.desc("volume"), "lane")
    )


def carrier_defects(star: Star, *, carrier_name: str | None = None) -> DataFrame:
    """Defects by reason for one carrier, or for every carrier."""
    defects = gather(
        star.fact.where("defect_flag"), ["carrier_id", "defect_reason"], ["n"]
    ).join(_matching(star.carrier, carrier_name=carrier_name), "carrier_id")
    return (
        merge(defects, ["carrier_name", "defect_reason"], ["n"])
        .withColumnRenamed("n", "defect_count")
        .orderBy("carrier_name", F.desc("defect_count"), "defect_reason")
    )


def busiest_lanes(star: Star, *, limit: int = 50) -> DataFrame:
    return (
        gather(star.fact, ["lane_id"], ["n"])
        .join(star.lane, "lane_id")
        .select("lane_id", lane_label().alias("lane_label"), F.col("n").alias("shipment_count"))
        .orderBy(F.desc("shipment_count"), "lane_id")
        .limit(limit)
    )


def tier_overview(star: Star) -> DataFrame:
    kpis = ["n", "otp_rate", "defect_rate", "cpm"]
    carriers = gather(star.fact, ["carrier_id"], kpis).join(star.carrier, "carrier_id")
    return (
        merge(carriers, ["carrier_tier"], kpis)
        .select(
            "carrier_tier",
            F.col("n").alias("shipments"),
            percent(kpi("otp_rate")).alias("otp_pct"),
            percent(kpi("defect_rate"), 2).alias("defect_pct"),
            rounded(kpi("cpm"), 2).alias("cost_per_mile"),
        )
        .orderBy(F.desc("otp_pct"), "carrier_tier")
    )


def filter_values(star: Star) -> DataFrame:
    """The choices of each shipper filter."""
    fields = ["vendor_type", "ship_volume_tier", "industry_segment"]
    return (
        star.shipper.select(*fields)
        .distinct()
        .unpivot([], fields, "field", "value")
        .distinct()
        .orderBy("field", "value")
    )
