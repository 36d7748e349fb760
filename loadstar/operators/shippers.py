"""Shipper operators."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstar.functions.measures import gather, kpi, linked, merge, part_aggregates
from loadstar.functions.numeric import clamp, percent, ratio, rounded, settled
from loadstar.operators.ordered import cumulative_top
from loadstar.star import Star, shipped_since

HEALTH_WEIGHTS = {
    "service": 0.30,
    "cost": 0.25,
    "growth": 0.20,
    "reliability": 0.15,
    "tenure": 0.10,
}


def _per_shipper(star: Star, kpis: list[str]) -> DataFrame:
    return gather(star.fact, ["shipper_id"], kpis).join(star.shipper, "shipper_id")


def top_shippers_cost_to_serve(star: Star, *, limit: int = 20) -> DataFrame:
    kpis = ["shipment_count", "total_cost", "avg_cost", "cpm", "otd_rate", "defect_rate"]
    keys = ["shipper_name", "vendor_type", "ship_volume_tier", "industry_segment"]
    return (
        merge(_per_shipper(star, kpis), keys, kpis)
        .select(
            *keys,
            kpi("shipment_count").alias("shipment_count"),
            rounded(kpi("total_cost"), 2).alias("total_cost"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost_per_shipment"),
            rounded(kpi("cpm"), 2).alias("avg_cpm"),
            percent(kpi("otd_rate")).alias("otd_pct"),
            percent(kpi("defect_rate"), 2).alias("defect_rate_pct"),
        )
        .orderBy(F.desc("total_cost"), "shipper_name")
        .limit(limit)
    )


def shipper_volume_pareto(star: Star, *, limit: int = 50) -> DataFrame:
    """Largest shippers with share and running share of all shipments.

    Unlike a running sum over tied values, the running share here follows the
    row position, so it grows with every row.
    """
    keys = ["shipper_name", "ship_volume_tier"]
    volumes = merge(_per_shipper(star, ["n"]), keys, ["n"]).withColumnRenamed(
        "n", "shipment_count"
    )
    top = cumulative_top(volumes, "shipment_count", limit, keys)
    so_far = F.sum("shipment_count").over(
        Window.orderBy("position").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
    )
    return top.orderBy("position").select(
        F.col("position").alias("rank"),
        *keys,
        "shipment_count",
        percent(ratio("shipment_count", "overall"), 2).alias("pct_of_total"),
        percent(ratio(so_far, "overall")).alias("cumulative_pct"),
    )


def volume_growth(
    star: Star, as_of: date, days: int, *parts: Column
) -> DataFrame:
    """Per shipper: volume of the last ``days`` and of the ``days`` before.

    ``parts`` are further aggregates of the same pass over the fact.
    """
    recent = shipped_since(as_of - timedelta(days=days))
    prior = shipped_since(as_of - timedelta(days=2 * days)) & ~recent
    return linked(star.fact, "shipper_id").groupBy("shipper_id").agg(
        *parts,
        F.count_if(recent).alias("vol_recent"),
        F.count_if(prior).alias("vol_prior"),
    )


def growth_rate() -> Column:
    """Relative change between the two periods, 0 without earlier volume."""
    change = F.col("vol_recent") - F.col("vol_prior")
    return F.when(F.col("vol_prior") > 0, ratio(change, "vol_prior")).otherwise(
        F.lit(0.0)
    )


def months_between_starts(first: Column, last: date) -> Column:
    """Month boundaries between two dates (31 Jan to 1 Feb is one)."""
    return (
        F.lit(last.year * 12 + last.month) - F.year(first) * 12 - F.month(first)
    )


def shipper_health(
    star: Star,
    *,
    as_of: date | None = None,
    weights: dict[str, float] | None = None,
    tenure_cap_months: int = 24,
    growth_days: int = 90,
) -> DataFrame:
    """Composite shipper score from 0 to 100, with its five components.

    One pass over the fact gathers service, cost, growth and reliability; the
    tier benchmark is a roll-up of the same per-shipper rows.
    """
    star, today = star.at(as_of)
    share = {**HEALTH_WEIGHTS, **(weights or {})}
    kpis = ["shipment_count", "otd_rate", "defect_free_rate", "avg_cost", "on_time"]
    shippers = volume_growth(star, today, growth_days, *part_aggregates(kpis)).join(
        star.shipper, "shipper_id"
    )
    # Always true, but it keeps every gathered column in use below the benchmark:
    # both branches then need the same shuffle, and the fact is read once.
    counted = F.greatest("n", "delivered_on_time", "defects", "on_time", "vol_recent", "vol_prior")
    benchmark = merge(
        shippers.where(counted >= 0), ["ship_volume_tier"], ["avg_cost"]
    ).select("ship_volume_tier", kpi("avg_cost").alias("tier_avg_cost"))
    # sample deviation of a 0/1 flag from its counts; NULL for a single shipment
    spread = F.sqrt(
        ratio(
            F.col("on_time").cast("double") * (F.col("n") - F.col("on_time")),
            F.col("n").cast("double") * (F.col("n") - 1),
        )
    )
    excess = ratio(F.col("avg_cost_per_shipment") - F.col("tier_avg_cost"), "tier_avg_cost")
    months = months_between_starts(F.col("onboarding_date"), today).cast("double")
    scores = {
        "service_score": (F.col("otd_rate") * 0.6 + F.col("defect_free_rate") * 0.4)
        * 100,
        "cost_score": clamp((F.lit(1.0) - excess) * 100, 0.0, 100.0),
        "growth_score": clamp(F.lit(50.0) + F.col("growth_rate") * 100, 0.0, 100.0),
        "reliability_score": clamp((F.lit(1.0) - spread * 2) * 100, 0.0, 100.0),
        "tenure_score": F.least(F.lit(100.0), months / F.lit(float(tenure_cap_months)) * 100),
    }
    composite = sum(
        (F.lit(share[name]) * F.col(f"{name}_score") for name in HEALTH_WEIGHTS),
        F.lit(0.0),
    )
    return (
        shippers.withColumns(
            {
                "total_shipments": F.col("n"),
                "otd_rate": kpi("otd_rate"),
                "defect_free_rate": kpi("defect_free_rate"),
                "avg_cost_per_shipment": kpi("avg_cost"),
                "growth_rate": growth_rate(),
            }
        )
        .join(benchmark, "ship_volume_tier")
        .withColumns(scores)
        .select(
            "shipper_id",
            "shipper_name",
            "vendor_type",
            "ship_volume_tier",
            "industry_segment",
            "total_shipments",
            "otd_rate",
            "defect_free_rate",
            "avg_cost_per_shipment",
            F.col("vol_recent").alias("vol_last_90d"),
            F.col("vol_prior").alias("vol_prior_90d"),
            "growth_rate",
            *[settled(name).alias(name) for name in scores],
            settled(composite).alias("shipper_health_score"),
        )
        .orderBy(F.desc("shipper_health_score"), "shipper_id")
    )


def classify_shipper_tier(star: Star, *, top: int = 20, mid: int = 80) -> DataFrame:
    """Volume tier of every shipper from its actual rank by shipments.

    Only the ``top + mid`` leaders need a position; everyone else is long tail,
    so no window ever spans all shippers.
    """
    volumes = gather(star.fact, ["shipper_id"], ["n"]).withColumnRenamed(
        "n", "shipment_count"
    )
    order = [F.desc("shipment_count"), F.asc("shipper_id")]
    leaders = (
        volumes.orderBy(*order)
        .limit(top + mid)
        .select(
            "shipper_id",
            F.row_number().over(Window.orderBy(*order)).alias("position"),
        )
    )
    return volumes.join(leaders, "shipper_id", "left").select(
        "shipper_id",
        "shipment_count",
        F.when(F.col("position") <= top, "Top20")
        .when(F.col("position").isNotNull(), "Mid")
        .otherwise("LongTail")
        .alias("volume_tier"),
    )
