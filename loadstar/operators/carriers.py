"""Carrier operators."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstar.functions.measures import gather, gather_from, kpi, merge, sketched
from loadstar.functions.numeric import percent, ratio, rounded
from loadstar.operators.lanes import positive_dwell
from loadstar.operators.ordered import cumulative_top, global_rank, percentiles
from loadstar.star import Star, lane_label, shipped_since


def _per_carrier(star: Star, kpis: list[str]) -> DataFrame:
    return gather(star.fact, ["carrier_id"], kpis).join(star.carrier, "carrier_id")


def otp_rank_within_tier(star: Star) -> DataFrame:
    """Carriers ranked by on-time pickup inside their tier (ties share a rank)."""
    kpis = ["shipment_count", "otp_rate"]
    keys = ["carrier_tier", "carrier_name", "target_otp_pct"]
    carriers = merge(_per_carrier(star, kpis), keys, kpis).withColumn(
        "otp_rate", kpi("otp_rate")
    )
    ranked = global_rank(
        carriers,
        "otp_rate",
        keys=["carrier_tier"],
        descending=True,
        name="rank_within_tier",
    )
    return ranked.select(
        "carrier_tier",
        "carrier_name",
        kpi("shipment_count").alias("shipment_count"),
        percent("otp_rate").alias("otp_pct"),
        (F.col("target_otp_pct") * 100).alias("target_otp_pct"),
        "rank_within_tier",
    ).orderBy("carrier_tier", "rank_within_tier", "carrier_name")


def dwell_percentiles_by_carrier(star: Star, *, approx: bool = False) -> DataFrame:
    """Median, p90 and p99 of positive dwell per carrier name.

    ``approx`` takes them from mergeable sketches instead of sorting the values.
    """
    keys = ["carrier_name", "carrier_tier"]
    shares = {"dwell_p50": 0.50, "dwell_p90": 0.90, "dwell_p99": 0.99}
    if approx:
        sketches = gather_from(star, ["carrier_id"], ["n", "dwell_kll"])
        dwell = sketched(sketches.join(star.carrier, "carrier_id"), keys, "dwell_kll", shares)
    else:
        named = (
            positive_dwell(star.fact, "carrier_id")
            .groupBy("carrier_id", "minutes")
            .agg(F.sum("shipments").alias("shipments"))
            .join(star.carrier, "carrier_id")
        )
        dwell = percentiles(named, keys, "minutes", "shipments", shares)
    return dwell.select(
        "carrier_name",
        "carrier_tier",
        F.col("row_count").alias("shipment_count"),
        rounded("dwell_p50", 1).alias("dwell_p50"),
        rounded("dwell_p90", 1).alias("dwell_p90"),
        rounded("dwell_p99", 1).alias("dwell_p99"),
    ).orderBy(F.desc("dwell_p90"), "carrier_name")


def dwell_rank_errors(star: Star, *, bound: float = 0.01) -> DataFrame:
    """How far the sketched dwell percentiles of each carrier are from their exact ranks.

    The error of a percentile is the distance, as a share of the carrier's values, from the
    wanted rank to the nearest rank at which the sketched value stands.
    """
    shares = {"p50": 0.50, "p90": 0.90, "p99": 0.99}
    sketches = gather_from(star, ["carrier_id"], ["n", "dwell_kll"])
    found = sketched(sketches, ["carrier_id"], "dwell_kll", shares)
    minutes = positive_dwell(star.fact, "carrier_id").where(F.col("minutes").isNotNull())
    counts = minutes.groupBy("carrier_id", "minutes").agg(F.sum("shipments").alias("shipments"))
    total = F.sum("shipments")
    errors = {}
    for name, p in shares.items():
        below = ratio(F.sum(F.when(F.col("minutes") < F.col(name), F.col("shipments")).otherwise(0)), total)
        upto = ratio(F.sum(F.when(F.col("minutes") <= F.col(name), F.col("shipments")).otherwise(0)), total)
        errors[name] = F.greatest(below - F.lit(p), F.lit(p) - upto, F.lit(0.0)).alias(f"{name}_error")
    # few rows of a carrier put whole percents between neighbouring ranks
    slack = F.lit(bound) + ratio(F.lit(1.0), F.col("shipments"))
    return (
        counts.join(found, "carrier_id")
        .groupBy("carrier_id")
        .agg(total.alias("shipments"), *errors.values())
        .select(
            "carrier_id",
            "shipments",
            (F.greatest(*[F.col(f"{n}_error") for n in shares]) <= slack).alias("within_bound"),
        )
    )


def carrier_lane_otp_matrix(
    star: Star, *, min_shipments: int = 50, limit: int = 50
) -> DataFrame:
    """The worst carrier x lane-label cells by on-time pickup."""
    kpis = ["shipment_count", "otp_rate", "cpm"]
    pairs = (
        gather(star.fact, ["carrier_id", "lane_id"], kpis)
        .join(star.carrier, "carrier_id")
        .join(star.lane, "lane_id")
        .withColumn("lane", lane_label("->"))
    )
    return (
        merge(pairs, ["carrier_name", "carrier_tier", "lane"], kpis)
        .where(kpi("shipment_count") >= min_shipments)
        .select(
            "carrier_name",
            "carrier_tier",
            "lane",
            kpi("shipment_count").alias("shipment_count"),
            percent(kpi("otp_rate")).alias("otp_pct"),
            rounded(kpi("cpm"), 2).alias("cost_per_mile"),
        )
        .orderBy("otp_pct", "carrier_name", "lane")
        .limit(limit)
    )


def cost_per_mile_by_tier(star: Star) -> DataFrame:
    kpis = ["shipment_count", "cpm", "cpm_min", "cpm_max", "total_cost"]
    return (
        merge(_per_carrier(star, kpis), ["carrier_tier"], kpis)
        .select(
            "carrier_tier",
            kpi("shipment_count").alias("shipment_count"),
            rounded(kpi("cpm"), 2).alias("avg_cost_per_mile"),
            rounded("cpm_min", 2).alias("min_cpm"),
            rounded("cpm_max", 2).alias("max_cpm"),
            rounded(kpi("total_cost"), 2).alias("total_spend"),
        )
        .orderBy("avg_cost_per_mile", "carrier_tier")
    )


def accessorial_share_by_carrier(star: Star) -> DataFrame:
    """Accessorial spend over total spend (a ratio of sums) per carrier."""
    kpis = ["shipment_count", "total_accessorial", "total_cost", "accessorial_of_total"]
    return (
        merge(_per_carrier(star, kpis), ["carrier_name", "carrier_tier"], kpis)
        .select(
            "carrier_name",
            "carrier_tier",
            kpi("shipment_count").alias("shipment_count"),
            rounded(kpi("total_accessorial"), 2).alias("total_accessorial"),
            rounded(kpi("total_cost"), 2).alias("total_cost"),
            percent(kpi("accessorial_of_total")).alias("accessorial_pct"),
        )
        .orderBy(F.desc("accessorial_pct"), "carrier_name")
    )


def carrier_concentration(star: Star, *, limit: int = 10) -> DataFrame:
    """Largest carriers by volume with their running share of the network."""
    kpis = ["shipment_count"]
    keys = ["carrier_name", "carrier_tier"]
    volumes = merge(_per_carrier(star, kpis), keys, kpis).withColumnRenamed(
        "n", "shipment_count"
    )
    top = cumulative_top(volumes, "shipment_count", limit, keys)
    return top.orderBy("position").select(
        *keys,
        "shipment_count",
        percent(ratio("shipment_count", "overall")).alias("volume_share_pct"),
        percent(ratio("running", "overall")).alias("cumulative_share_pct"),
    )


def otp_decline(
    star: Star, *, as_of: date | None = None, days: int = 28, drop: float = 0.05
) -> DataFrame:
    """Carriers whose OTP fell by more than ``drop`` against the period before."""
    star, today = star.at(as_of)
    fact = star.last_days(today, 2 * days)
    late_half = shipped_since(today - timedelta(days=days))

    def rate(period: Column) -> Column:
        return ratio(
            F.count_if(period & F.col("on_time_pickup")), F.count_if(period)
        )

    halves = fact.groupBy("carrier_id").agg(
        rate(~late_half).alias("prior"), rate(late_half).alias("last")
    )
    change = F.col("last") - F.col("prior")
    return (
        halves.where(change < F.lit(-drop))
        .join(star.carrier, "carrier_id")
        .select(
            "carrier_name",
            "carrier_tier",
            percent("prior").alias("otp_prior_4w_pct"),
            percent("last").alias("otp_last_4w_pct"),
            percent(change).alias("change_pp"),
        )
        .orderBy("change_pp", "carrier_name")
    )
