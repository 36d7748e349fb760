"""The six analytical views and the tables built from them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstar.functions.calendar import week_year
from loadstar.functions.measures import gather, gather_from, kpi, merge, parts_of, sketched
from loadstar.functions.numeric import percent, ratio, rounded, settled
from loadstar.operators import shippers
from loadstar.operators.network import by_day, by_week
from loadstar.operators.ordered import percentiles
from loadstar.star import Star, lane_label


def carrier_scorecard(star: Star, *, approx: bool = False) -> DataFrame:
    """KPIs and dwell percentiles of every carrier, the latter from sketches with ``approx``."""
    kpis = [
        "shipment_count",
        "otp_rate",
        "otd_rate",
        "defect_rate",
        "avg_utilization",
        "cpm",
        "avg_cost",
        "total_cost",
    ]
    shares = {"dwell_p50": 0.50, "dwell_p90": 0.90}
    if approx:
        cells = gather_from(star, ["carrier_id"], [*kpis, "dwell_kll"])
        dwell = sketched(cells, ["carrier_id"], "dwell_kll", shares)
    else:
        # One pass per carrier and dwell value serves the percentiles and the KPIs. The
        # condition always holds, but it keeps all parts in use on both branches, so
        # that they share the shuffle.
        cells = gather_from(star, ["carrier_id", "dwell_minutes"], kpis)
        used = [F.col(p).cast("double") for p in parts_of(kpis)]
        cells = cells.where(F.greatest(F.lit(0.0), *used) >= 0)
        minutes = F.when(F.col("dwell_minutes") > 0, F.col("dwell_minutes"))
        cells = cells.withColumn("minutes", minutes)
        dwell = percentiles(cells, ["carrier_id"], "minutes", "n", shares)
    return (
        merge(cells, ["carrier_id"], kpis)
        .join(dwell, "carrier_id")
        .join(star.carrier, "carrier_id")
        .select(
            "carrier_id",
            "carrier_name",
            "carrier_tier",
            "equipment_type",
            "contract_type",
            "target_otp_pct",
            kpi("shipment_count").alias("shipment_count"),
            kpi("otp_rate").alias("otp_rate"),
            kpi("otd_rate").alias("otd_rate"),
            "dwell_p50",
            "dwell_p90",
            kpi("defect_rate").alias("defect_rate"),
            kpi("avg_utilization").alias("avg_utilization"),
            kpi("cpm").alias("avg_cost_per_mile"),
            kpi("avg_cost").alias("avg_cost_per_shipment"),
            kpi("total_cost").alias("total_cost"),
        )
        .orderBy("carrier_tier", F.desc("otp_rate"), "carrier_id")
    )


def lane_performance(star: Star) -> DataFrame:
    kpis = [
        "shipment_count",
        "otp_rate",
        "otd_rate",
        "avg_dwell",
        "defect_rate",
        "avg_utilization",
        "avg_cost",
        "cpm",
        "total_cost",
    ]
    return (
        gather_from(star, ["lane_id"], kpis)
        .join(star.lane, "lane_id")
        .select(
            "lane_id",
            "origin_city",
            "origin_state",
            "dest_fc_id",
            "distance_miles",
            "lane_type",
            kpi("shipment_count").alias("shipment_count"),
            kpi("otp_rate").alias("otp_rate"),
            kpi("otd_rate").alias("otd_rate"),
            kpi("avg_dwell").alias("avg_dwell_minutes"),
            kpi("defect_rate").alias("defect_rate"),
            kpi("avg_utilization").alias("avg_utilization"),
            kpi("avg_cost").alias("avg_cost_per_shipment"),
            kpi("cpm").alias("avg_cost_per_mile"),
            kpi("total_cost").alias("total_cost"),
        )
        .orderBy(F.desc("shipment_count"), "lane_id")
    )


def weekly_kpis(star: Star, *, week_key: str = "iso") -> DataFrame:
    kpis = [
        "shipment_count",
        "otp_rate",
        "otd_rate",
        "avg_dwell",
        "defect_rate",
        "avg_utilization",
        "avg_cost",
        "cpm",
        "total_cost",
    ]
    return (
        by_week(star, kpis, week_key)
        .select(
            "year",
            "week_of_year",
            "week_start",
            kpi("shipment_count").alias("shipment_count"),
            kpi("otp_rate").alias("otp_rate"),
            kpi("otd_rate").alias("otd_rate"),
            kpi("avg_dwell").alias("avg_dwell"),
            kpi("defect_rate").alias("defect_rate"),
            kpi("avg_utilization").alias("avg_utilization"),
            kpi("avg_cost").alias("avg_cost_per_shipment"),
            kpi("cpm").alias("avg_cost_per_mile"),
            kpi("total_cost").alias("total_cost"),
        )
        .orderBy("year", "week_of_year")
    )


def shipper_cost_to_serve(star: Star) -> DataFrame:
    kpis = [
        "shipment_count",
        "total_cost",
        "avg_cost",
        "cpm",
        "cost_per_pallet",
        "accessorial_share",
        "otd_rate",
        "defect_rate",
    ]
    return (
        gather_from(star, ["shipper_id"], kpis)
        .join(star.shipper, "shipper_id")
        .select(
            "shipper_id",
            "shipper_name",
            "vendor_type",
            "ship_volume_tier",
            kpi("shipment_count").alias("shipment_count"),
            kpi("total_cost").alias("total_cost"),
            kpi("avg_cost").alias("avg_cost_per_shipment"),
            kpi("cpm").alias("avg_cost_per_mile"),
            kpi("cost_per_pallet").alias("avg_cost_per_pallet"),
            kpi("accessorial_share").alias("accessorial_share"),
            kpi("otd_rate").alias("otd_rate"),
            kpi("defect_rate").alias("defect_rate"),
        )
        .orderBy(F.desc("total_cost"), "shipper_id")
    )


def active_parties(star: Star, *, level: str = "month") -> DataFrame:
    """Carriers, lanes and shippers that shipped, per day, week, month, year or in all.

    All levels merge the same distinct-count sketches of single days.
    """
    kpis = ["shipment_count", "active_carriers", "active_lanes", "active_shippers"]
    levels = {
        "day": ["date"],
        "week": ["iso_year", "week_of_year"],
        "month": ["year", "month"],
        "year": ["year"],
        "network": [],
    }
    days = by_day(star, kpis).withColumn("iso_year", week_year("iso"))
    keys = levels[level]
    rows = merge(days, keys, kpis).select(*keys, *[kpi(k).alias(k) for k in kpis])
    return rows.orderBy(*keys) if keys else rows


def anomaly_flags(
    star: Star, *, as_of: date | None = None, days: int = 14
) -> DataFrame:
    """Carrier x lane x day service and cost over the last ``days`` days."""
    kpis = ["shipment_count", "otp_rate", "cpm"]
    recent = star.last_days(star.resolve_as_of(as_of), days)
    return (
        gather(recent, ["carrier_id", "lane_id", "shipment_date_key"], kpis)
        .join(star.date, F.col("shipment_date_key") == F.col("date_key"))
        .join(star.carrier, "carrier_id")
        .join(star.lane, "lane_id")
        .select(
            "carrier_id",
            "carrier_name",
            "carrier_tier",
            "lane_id",
            lane_label().alias("lane_label"),
            "date",
            kpi("otp_rate").alias("daily_otp"),
            kpi("cpm").alias("daily_cpm"),
            kpi("shipment_count").alias("daily_volume"),
        )
        .orderBy(F.desc("date"), "daily_otp", "carrier_id", "lane_id")
    )


def anomaly_summary(
    star: Star,
    *,
    as_of: date | None = None,
    days: int = 14,
    otp_max: float = 0.80,
    limit: int = 20,
) -> DataFrame:
    """Carrier-lanes whose mean daily OTP over the period is below ``otp_max``."""
    keys = ["carrier_name", "carrier_tier", "lane_label"]
    mean_otp = F.avg("daily_otp")
    cells = (
        anomaly_flags(star, as_of=as_of, days=days)
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("flagged_days"),
            mean_otp.alias("mean_otp"),
            F.avg("daily_cpm").alias("mean_cpm"),
            F.sum("daily_volume").alias("total_volume"),
        )
    )
    return (
        cells.where(settled("mean_otp") < otp_max)
        .select(
            *keys,
            "flagged_days",
            percent("mean_otp").alias("avg_otp_pct"),
            rounded("mean_cpm", 2).alias("avg_cpm"),
            "total_volume",
        )
        .orderBy("avg_otp_pct", *keys)
        .limit(limit)
    )


def all_views(
    star: Star, *, as_of: date | None = None, week_key: str = "calendar"
) -> dict[str, DataFrame]:
    """The six views; weeks pair the calendar year with the ISO week unless told else."""
    star, today = star.at(as_of)
    return {
        "v_carrier_scorecard": carrier_scorecard(star),
        "v_lane_performance": lane_performance(star),
        "v_weekly_kpis": weekly_kpis(star, week_key=week_key),
        "v_shipper_costtoserve": shipper_cost_to_serve(star),
        "v_shipper_health": shippers.shipper_health(star, as_of=today),
        "v_anomaly_flags": anomaly_flags(star, as_of=today),
    }


def export_kpi_tables(
    star: Star, path: str, *, as_of: date | None = None, week_key: str = "iso"
) -> list[str]:
    """Write the weekly, carrier, lane and shipper tables as CSV folders."""
    from loadstar.sources.warehouse import write_csv

    star, as_of = star.at(as_of)
    tables = {
        "weekly_kpis": weekly_kpis(star, week_key=week_key),
        "carrier_scorecard": carrier_scorecard(star),
        "lane_performance": lane_performance(star),
        "shipper_health": shippers.shipper_health(star, as_of=as_of),
    }
    for name, table in tables.items():
        write_csv(table, f"{path}/{name}")
    return [f"{path}/{name}" for name in tables]


def bi_extract(star: Star, *, as_of: date | None = None, days: int = 60) -> DataFrame:
    """Shipments of the last ``days`` days joined with all their dimensions."""
    return (
        star.last_days(star.resolve_as_of(as_of), days)
        .join(star.date, F.col("shipment_date_key") == F.col("date_key"))
        .join(star.carrier, "carrier_id")
        .join(star.lane.drop("distance_miles"), "lane_id")
        .join(star.shipper, "shipper_id")
        .join(star.service, "service_type_id")
        .select(
            "shipment_id",
            "date",
            "carrier_name",
            "carrier_tier",
            "origin_city",
            "origin_state",
            "dest_fc_id",
            "lane_type",
            "shipper_name",
            "vendor_type",
            "service_name",
            "on_time_pickup",
            "on_time_delivery",
            "dwell_minutes",
            "defect_flag",
            "defect_reason",
            "trailer_utilization_pct",
            "distance_miles",
            "total_cost_usd",
            ratio("total_cost_usd", "distance_miles").alias("cost_per_mile"),
        )
    )
