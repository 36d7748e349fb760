"""The tables behind the report pack."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstar.functions.measures import gather, kpi, merge
from loadstar.functions.numeric import percent, rounded
from loadstar.operators.network import by_day
from loadstar.star import Star

# Labels that appear in results.
STANDARD_ACCESSORIAL = "Standard"
GOOD_BAND, FAIR_BAND, POOR_BAND = "green", "yellow", "red"


def kpi_snapshot(star: Star) -> DataFrame:
    kpis = ["shipment_count", "otp_rate", "defect_rate", "avg_cost", "avg_dwell"]
    return gather(star.fact, [], kpis).select(
        kpi("shipment_count").alias("shipments"),
        percent(kpi("otp_rate")).alias("otp"),
        percent(kpi("defect_rate"), 2).alias("defect"),
        rounded(kpi("avg_cost"), 2).alias("avg_cost"),
        rounded(kpi("avg_dwell"), 1).alias("avg_dwell"),
    )


def carrier_month(star: Star) -> DataFrame:
    """Carrier x calendar month: OTP, defects, cost per mile."""
    kpis = ["otp_rate", "defect_rate", "cpm"]
    months = merge(by_day(star, kpis, ["carrier_id"]), ["carrier_id", "month"], kpis)
    keys = ["carrier_name", "carrier_tier", "month"]
    return (
        merge(months.join(star.carrier, "carrier_id"), keys, kpis)
        .select(
            *keys,
            percent(kpi("otp_rate")).alias("otp_pct"),
            percent(kpi("defect_rate"), 2).alias("defect_pct"),
            rounded(kpi("cpm"), 2).alias("cpm"),
        )
        .orderBy("carrier_tier", "carrier_name", "month")
    )


def lane_heatmap(star: Star) -> DataFrame:
    """Origin x destination OTP with its colour band (90 and 80 percent)."""
    kpis = ["otp_rate", "n"]
    lanes = gather(star.fact, ["lane_id"], kpis).join(star.lane, "lane_id")
    cells = merge(lanes, ["origin_city", "dest_fc_id"], kpis).withColumn(
        "otp_pct", percent(kpi("otp_rate"))
    )
    band = (
        F.when(F.col("otp_pct") >= 90, GOOD_BAND)
        .when(F.col("otp_pct") >= 80, FAIR_BAND)
        .otherwise(POOR_BAND)
    )
    return cells.select(
        "origin_city",
        "dest_fc_id",
        "otp_pct",
        F.col("n").alias("volume"),
        band.alias("band"),
    ).orderBy("otp_pct", "origin_city", "dest_fc_id")


def shipper_service_cost(star: Star, *, tier: str = "Top20") -> DataFrame:
    """Cost to serve of one volume tier by service."""
    kpis = ["total_cost", "shipment_count", "avg_cost"]
    wanted = star.shipper.where(F.col("ship_volume_tier") == tier)
    cells = (
        gather(star.fact, ["shipper_id", "service_type_id"], kpis)
        .join(wanted, "shipper_id")
        .join(star.service, "service_type_id")
    )
    keys = ["shipper_name", "ship_volume_tier", "service_name"]
    return (
        merge(cells, keys, kpis)
        .select(
            *keys,
            rounded(kpi("total_cost"), 2).alias("total_cost"),
            kpi("shipment_count").alias("shipment_count"),
            rounded(kpi("avg_cost"), 2).alias("cps"),
        )
        .orderBy(F.desc("total_cost"), "shipper_name", "service_name")
    )


def accessorial_drivers(star: Star) -> DataFrame:
    """Accessorial spend by reason and calendar month."""
    kpis = ["total_accessorial", "shipment_count"]
    days = by_day(star, kpis, ["defect_reason"])
    reason = F.coalesce("defect_reason", F.lit(STANDARD_ACCESSORIAL))
    return (
        merge(days.withColumn("reason", reason), ["reason", "month"], kpis)
        .select(
            "reason",
            "month",
            rounded(kpi("total_accessorial"), 2).alias("total_accessorial"),
            kpi("shipment_count").alias("shipment_count"),
        )
        .orderBy(F.desc("total_accessorial"), "reason", "month")
    )


def daily_trend(star: Star, *, days: int = 90) -> DataFrame:
    """The latest ``days`` ship days."""
    kpis = ["shipment_count", "otp_rate", "defect_rate", "avg_cost", "avg_dwell"]
    return (
        by_day(star, kpis)
        .orderBy(F.desc("date"))
        .limit(days)
        .select(
            "date",
            kpi("shipment_count").alias("shipments"),
            percent(kpi("otp_rate")).alias("otp_pct"),
            percent(kpi("defect_rate"), 2).alias("defect_pct"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost"),
            rounded(kpi("avg_dwell"), 1).alias("avg_dwell"),
        )
    )
