"""Lane and node operators."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstar.functions.measures import gather, gather_from, kpi, linked, merge, sketched
from loadstar.functions.numeric import percent, ratio, rounded
from loadstar.operators.ordered import percentiles
from loadstar.schema import BENCHMARK_CPM
from loadstar.star import Star, lane_label, shipped_since

# Texts that appear in results.
ABOVE_BENCHMARK = "Above benchmark"
BELOW_BENCHMARK = "Below benchmark"
CONSIDER_FTL = "Consider FTL conversion"
EVALUATE_INTERMODAL = "Evaluate intermodal conversion"


def _per_lane(star: Star, kpis: list[str]) -> DataFrame:
    return gather(star.fact, ["lane_id"], kpis).join(star.lane, "lane_id")


def _service_lanes(star: Star, service: str, kpis: list[str]) -> DataFrame:
    """Parts per lane for one service."""
    wanted = star.service.where(F.col("service_name") == service)
    parts = gather(star.fact, ["lane_id", "service_type_id"], kpis)
    return merge(
        parts.join(wanted, "service_type_id", "left_semi"), ["lane_id"], kpis
    ).join(star.lane, "lane_id")


def positive_dwell(fact: DataFrame, key: str, *extra: Column) -> DataFrame:
    """A foreign key with dwell minutes, NULL unless positive, per shipment."""
    minutes = F.when(F.col("dwell_minutes") > 0, F.col("dwell_minutes"))
    return linked(fact, key).select(key, *extra, minutes.alias("minutes"), F.lit(1).alias("shipments"))


def top_lanes_by_volume(star: Star, *, limit: int = 10) -> DataFrame:
    lanes = _per_lane(star, ["shipment_count", "otp_rate", "avg_cost"])
    return (
        lanes.select(
            "lane_id",
            F.concat_ws(", ", "origin_city", "origin_state").alias("origin"),
            F.col("dest_fc_id").alias("destination"),
            "distance_miles",
            "lane_type",
            kpi("shipment_count").alias("shipment_count"),
            percent(kpi("otp_rate")).alias("otp_pct"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost"),
        )
        .orderBy(F.desc("shipment_count"), "lane_id")
        .limit(limit)
    )


def dwell_outliers_by_lane(
    star: Star, *, p99_min: float = 180, approx: bool = False
) -> DataFrame:
    """Lanes whose 99th percentile of positive dwell exceeds ``p99_min``.

    ``approx`` takes the percentiles from mergeable sketches instead of sorting the values.
    """
    shares = {"dwell_p50": 0.50, "dwell_p90": 0.90, "dwell_p99": 0.99}
    if approx:
        sketches = gather_from(star, ["lane_id"], ["n", "dwell_kll"])
        dwell = sketched(sketches, ["lane_id"], "dwell_kll", shares)
    else:
        minutes = positive_dwell(star.fact, "lane_id")
        dwell = percentiles(minutes, ["lane_id"], "minutes", "shipments", shares)
    lane = F.concat(
        F.concat_ws(", ", "origin_city", "origin_state"),
        F.lit(" -> "),
        F.col("dest_fc_id"),
    )
    return (
        dwell.where(F.col("dwell_p99") > p99_min)
        .join(star.lane, "lane_id")
        .select(
            "lane_id",
            lane.alias("lane"),
            "lane_type",
            F.col("row_count").alias("shipment_count"),
            rounded("dwell_p50", 1).alias("dwell_p50"),
            rounded("dwell_p90", 1).alias("dwell_p90"),
            rounded("dwell_p99", 1).alias("dwell_p99"),
        )
        .orderBy(F.desc("dwell_p99"), "lane_id")
    )


def profitability_vs_benchmark(
    star: Star, *, benchmark_cpm: float = BENCHMARK_CPM, min_shipments: int = 100
) -> DataFrame:
    """Observed cost per mile against a benchmark rate, per lane."""
    benchmark = F.lit(float(benchmark_cpm))
    lanes = _per_lane(star, ["shipment_count", "cpm"])
    return (
        lanes.where(kpi("shipment_count") >= min_shipments)
        .select(
            "lane_id",
            lane_label().alias("lane"),
            "lane_type",
            "distance_miles",
            kpi("shipment_count").alias("shipment_count"),
            rounded(kpi("cpm"), 2).alias("observed_cpm"),
            benchmark.alias("benchmark_cpm"),
            percent((benchmark - kpi("cpm")) / benchmark).alias(
                "profitability_index_pct"
            ),
            F.when(kpi("cpm") > benchmark, ABOVE_BENCHMARK)
            .otherwise(BELOW_BENCHMARK)
            .alias("cost_status"),
        )
        .orderBy("profitability_index_pct", "lane_id")
    )


def haul_economics(star: Star) -> DataFrame:
    """Short, mid and long haul side by side."""
    kpis = [
        "shipment_count",
        "avg_cost",
        "cpm",
        "accessorial_share",
        "otp_rate",
        "defect_rate",
        "avg_utilization",
    ]
    lane_miles = F.sum(F.col("distance_miles") * F.col("n")).alias("lane_miles")
    return (
        merge(_per_lane(star, kpis), ["lane_type"], kpis, lane_miles)
        .select(
            "lane_type",
            kpi("shipment_count").alias("shipment_count"),
            rounded(ratio("lane_miles", "n")).alias("avg_distance"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost_per_shipment"),
            rounded(kpi("cpm"), 2).alias("avg_cpm"),
            percent(kpi("accessorial_share")).alias("accessorial_share_pct"),
            percent(kpi("otp_rate")).alias("otp_pct"),
            percent(kpi("defect_rate"), 2).alias("defect_rate_pct"),
            percent(kpi("avg_utilization")).alias("avg_utilization_pct"),
        )
        .orderBy("avg_distance")
    )


def underutilized_lanes(
    star: Star, *, min_shipments: int = 50, limit: int = 20
) -> DataFrame:
    lanes = _per_lane(star, ["shipment_count", "avg_utilization", "avg_cost", "cpm"])
    return (
        lanes.where(kpi("shipment_count") >= min_shipments)
        .select(
            "lane_id",
            lane_label().alias("lane"),
            "lane_type",
            kpi("shipment_count").alias("shipment_count"),
            percent(kpi("avg_utilization")).alias("avg_utilization_pct"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost_per_shipment"),
            rounded(kpi("cpm"), 2).alias("avg_cpm"),
        )
        .orderBy("avg_utilization_pct", "lane_id")
        .limit(limit)
    )


def modal_mismatch_candidates(
    star: Star,
    *,
    min_util: float = 0.70,
    min_weight: float = 30000,
    min_shipments: int = 20,
    service: str = "LTL",
) -> DataFrame:
    """Lanes of one service whose loads look like full truckloads."""
    kpis = ["shipment_count", "avg_utilization", "avg_weight", "avg_pallets", "avg_cost"]
    lanes = _service_lanes(star, service, kpis)
    return (
        lanes.where(
            (kpi("avg_utilization") > min_util)
            & (kpi("avg_weight") > min_weight)
            & (kpi("shipment_count") >= min_shipments)
        )
        .select(
            "lane_id",
            lane_label().alias("lane"),
            kpi("shipment_count").alias("ltl_shipment_count"),
            percent(kpi("avg_utilization")).alias("avg_utilization_pct"),
            rounded(kpi("avg_weight")).alias("avg_weight_lbs"),
            rounded(kpi("avg_pallets"), 1).alias("avg_pallets"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost_ltl"),
            F.lit(CONSIDER_FTL).alias("recommendation"),
        )
        .orderBy(F.desc("avg_utilization_pct"), "lane_id")
    )


def intermodal_candidates(
    star: Star,
    *,
    min_miles: float = 1500,
    min_shipments: int = 100,
    saving: float = 0.20,
    service: str = "FTL",
    limit: int = 15,
) -> DataFrame:
    """Long lanes of one service with the saving a cheaper mode would bring."""
    kpis = ["shipment_count", "cpm", "avg_miles"]
    lanes = _service_lanes(star, service, kpis)
    saved = (
        kpi("cpm") * F.lit(saving) * kpi("avg_miles") * kpi("shipment_count")
    )
    return (
        lanes.where(F.col("distance_miles") > min_miles)
        .where(kpi("shipment_count") >= min_shipments)
        .select(
            "lane_id",
            lane_label().alias("lane"),
            "distance_miles",
            kpi("shipment_count").alias("ftl_volume"),
            rounded(kpi("cpm"), 2).alias("current_cpm"),
            rounded(kpi("cpm") * F.lit(1 - saving), 2).alias("est_intermodal_cpm"),
            # settle the floating product first: whole cents make exact halves common
            rounded(rounded(saved, 6)).alias("est_annual_savings"),
            F.lit(EVALUATE_INTERMODAL).alias("recommendation"),
        )
        .orderBy(F.desc("est_annual_savings"), "lane_id")
        .limit(limit)
    )


def origin_state_volume(star: Star) -> DataFrame:
    kpis = ["shipment_count", "otp_rate", "avg_cost", "total_cost"]
    # one row per lane goes in, so the lane count needs no distinct
    lanes = F.count(F.lit(1)).alias("lane_count")
    return (
        merge(_per_lane(star, kpis), ["origin_state"], kpis, lanes)
        .select(
            "origin_state",
            "lane_count",
            kpi("shipment_count").alias("shipment_count"),
            percent(kpi("otp_rate")).alias("otp_pct"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost_per_shipment"),
            rounded(kpi("total_cost")).alias("total_cost"),
        )
        .orderBy(F.desc("shipment_count"), "origin_state")
    )


def inbound_node_balance(star: Star) -> DataFrame:
    """Volume share and service level per destination node."""
    kpis = ["shipment_count", "otp_rate", "avg_dwell", "avg_cost"]
    lanes = _per_lane(star, kpis)
    total = lanes.agg(F.sum("n")).scalar()
    return (
        merge(lanes, ["dest_fc_id", "dest_city", "dest_state"], kpis)
        .select(
            "dest_fc_id",
            F.concat_ws(", ", "dest_city", "dest_state").alias("fc_location"),
            kpi("shipment_count").alias("shipment_count"),
            percent(ratio("n", total)).alias("volume_share_pct"),
            percent(kpi("otp_rate")).alias("otp_pct"),
            rounded(kpi("avg_dwell"), 1).alias("avg_dwell"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost_per_shipment"),
        )
        .orderBy(F.desc("shipment_count"), "dest_fc_id")
    )


def dwell_spikes(
    star: Star,
    *,
    as_of: date | None = None,
    days: int = 14,
    ratio_min: float = 1.5,
    min_volume: int = 10,
) -> DataFrame:
    """Lanes whose recent dwell p90 exceeds ``ratio_min`` times the earlier p90.

    Both periods come from one pass: the period is part of the percentile key.
    """
    star, today = star.at(as_of)
    start = today - timedelta(days=days)
    recent = shipped_since(start).alias("is_recent")
    p90 = percentiles(
        positive_dwell(star.fact, "lane_id", recent),
        ["lane_id", "is_recent"],
        "minutes",
        "shipments",
        {"p90": 0.90},
    )
    sides = p90.groupBy("lane_id").agg(
        F.max(F.when(~F.col("is_recent"), F.col("p90"))).alias("baseline_dwell_p90"),
        F.max(F.when(F.col("is_recent"), F.col("p90"))).alias("recent_dwell_p90"),
        F.max(F.when(F.col("is_recent"), F.col("row_count"))).alias("recent_volume"),
    )
    base, now = F.col("baseline_dwell_p90"), F.col("recent_dwell_p90")
    return (
        sides.where((now > base * F.lit(ratio_min)) & (F.col("recent_volume") >= min_volume))
        .join(star.lane, "lane_id")
        .select(
            "lane_id",
            lane_label().alias("lane"),
            "baseline_dwell_p90",
            "recent_dwell_p90",
            percent(ratio(now - base, base)).alias("pct_change"),
            "recent_volume",
        )
        .orderBy(F.desc("pct_change"), "lane_id")
        .drop("lane_id")
    )


def lane_primary_carrier(star: Star) -> DataFrame:
    """The carrier with most shipments on each lane, with its OTP and cost there."""
    kpis = ["shipment_count", "otp_rate", "avg_cost"]
    pairs = gather(star.fact, ["lane_id", "carrier_id"], kpis)
    # largest volume first, smallest carrier id on ties
    best = F.max_by(
        F.struct("carrier_id", "n", "on_time", "cost_sum"),
        F.struct(F.col("n"), -F.col("carrier_id")),
    )
    return (
        pairs.groupBy("lane_id")
        .agg(best.alias("best"))
        .select("lane_id", "best.*")
        .join(star.carrier, "carrier_id")
        .select(
            "lane_id",
            "carrier_id",
            "carrier_name",
            "carrier_tier",
            F.col("n").alias("vol"),
            percent(kpi("otp_rate")).alias("otp"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost"),
        )
        .orderBy("lane_id")
    )
