"""Network-wide operators: calendar trends, cost structure, Pareto tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstar.functions.calendar import week_year
from loadstar.functions.measures import gather, gather_from, kpi, linked, merge, sketched
from loadstar.functions.numeric import percent, ratio, rounded, settled
from loadstar.operators.ordered import percentiles, running_totals
from loadstar.schema import DAY_NAMES, NETWORK_OTP_TARGET_PCT, PEAK_MONTHS
from loadstar.star import Star

# Texts that appear in results.
CASCADE_LABEL = "Late pickup -> Late delivery cascade"
PEAK_LABEL = "Q4 (Peak)"
OFF_PEAK_LABEL = "Non-Q4"
NO_DEFECT_LABEL = "No defect (standard accessorial)"
EARLY_ARRIVAL_NOTE = (
    "Early arrivals before appointment window. Clipped or filtered in analysis."
)


def by_day(star: Star, kpis: Iterable[str], keys: Sequence[str] = ()) -> DataFrame:
    """Parts per ship day (and ``keys``) with the calendar columns beside them."""
    parts = gather_from(star, [*keys, "shipment_date_key"], kpis)
    return parts.join(star.date, F.col("shipment_date_key") == F.col("date_key"))


def by_week(
    star: Star, kpis: Iterable[str], week_key: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Parts per week (and ``keys``) with the first ship day as ``week_start``."""
    kpis = list(kpis)
    days = by_day(star, kpis, keys).withColumn("year", week_year(week_key))
    start = F.min("date").alias("week_start")
    return merge(days, [*keys, "year", "week_of_year"], kpis, start)


def period_label() -> Column:
    return F.when(F.col("month").isin(list(PEAK_MONTHS)), PEAK_LABEL).otherwise(
        OFF_PEAK_LABEL
    )


def defect_trend_monthly(star: Star) -> DataFrame:
    kpis = ["shipment_count", "defect_rate"]
    return (
        merge(by_day(star, kpis), ["year", "month"], kpis)
        .select(
            "year",
            "month",
            kpi("shipment_count").alias("total_shipments"),
            F.col("defects").alias("defect_count"),
            percent(kpi("defect_rate"), 2).alias("defect_rate_pct"),
        )
        .orderBy("year", "month")
    )


def otp_by_weekday(star: Star) -> DataFrame:
    kpis = ["shipment_count", "otp_rate", "defect_rate", "avg_dwell"]
    names = F.array(*[F.lit(name) for name in DAY_NAMES])
    return (
        merge(by_day(star, kpis), ["day_of_week"], kpis)
        .select(
            "day_of_week",
            F.get(names, F.col("day_of_week")).alias("day_name"),
            kpi("shipment_count").alias("shipment_count"),
            percent(kpi("otp_rate")).alias("otp_pct"),
            percent(kpi("defect_rate"), 2).alias("defect_rate_pct"),
            rounded(kpi("avg_dwell"), 1).alias("avg_dwell_min"),
        )
        .orderBy("day_of_week")
    )


def weekly_otp_vs_target(
    star: Star,
    *,
    window_rows: int = 4,
    target_pct: float = NETWORK_OTP_TARGET_PCT,
    week_key: str = "iso",
) -> DataFrame:
    """Weekly OTP, its moving average and the target. One row per week."""
    kpis = ["shipment_count", "otp_rate"]
    trailing = Window.orderBy("year", "week_of_year").rowsBetween(1 - window_rows, 0)
    return (
        by_week(star, kpis, week_key)
        .select(
            "year",
            "week_of_year",
            "week_start",
            kpi("shipment_count").alias("shipment_count"),
            percent(kpi("otp_rate")).alias("otp_pct"),
            percent(F.avg(kpi("otp_rate")).over(trailing)).alias("rolling_4w_avg_pct"),
            F.lit(float(target_pct)).alias("network_target_pct"),
        )
        .orderBy("year", "week_of_year")
    )


def otp_week_over_week(star: Star, *, week_key: str = "iso") -> DataFrame:
    """Weekly OTP and its change, both on the rounded percentage."""
    kpis = ["otp_rate"]
    order = Window.orderBy("year", "week_of_year")
    weekly = by_week(star, kpis, week_key).withColumn(
        "otp_pct", percent(kpi("otp_rate"))
    )
    previous = F.lag("otp_pct").over(order)
    return weekly.select(
        "year",
        "week_of_year",
        "week_start",
        "otp_pct",
        previous.alias("prev_week_otp"),
        rounded(F.col("otp_pct") - previous, 1).alias("wow_change_pp"),
    ).orderBy("year", "week_of_year")


def late_pickup_cascade(star: Star) -> DataFrame:
    """How late pickups and late deliveries go together, where pickup is known."""
    pickup, delivery = F.col("on_time_pickup"), F.col("on_time_delivery")
    counts = star.fact.where(F.col("pickup_actual_ts").isNotNull()).agg(
        F.count(F.lit(1)).alias("total_shipments"),
        F.count_if(~pickup & ~delivery).alias("late_pickup_late_delivery"),
        F.count_if(~pickup & delivery).alias("late_pickup_ontime_delivery"),
        F.count_if(pickup & ~delivery).alias("ontime_pickup_late_delivery"),
        F.count_if(pickup & delivery).alias("ontime_pickup_ontime_delivery"),
    )

    def late_share(late: str, on_time: str) -> Column:
        return percent(ratio(F.col(late), F.col(late) + F.col(on_time)))

    return counts.select(
        F.lit(CASCADE_LABEL).alias("analysis"),
        *counts.columns,
        late_share("late_pickup_late_delivery", "late_pickup_ontime_delivery").alias(
            "pct_late_pickup_leads_to_late_delivery"
        ),
        late_share(
            "ontime_pickup_late_delivery", "ontime_pickup_ontime_delivery"
        ).alias("pct_ontime_pickup_still_late_delivery"),
    )


def _pareto(categories: DataFrame, size: str) -> DataFrame:
    """``categories`` with share and running share (ties together) of ``size``.

    The column that names the category is free text, so its values may be many:
    running sums are taken per distinct size, in buckets.
    """
    sums = running_totals(
        categories.withColumn("_size", F.col(size)), [], size, "_size", descending=True
    )
    so_far = (F.col("weight_before") + F.col("weight_here")).alias("_so_far")
    sums = sums.select(F.col(size).alias("_at"), so_far, F.col("weight_total").alias("_total"))
    return (
        categories.join(sums, F.col(size) == F.col("_at"))
        .withColumn("pct_of_total", percent(ratio(size, "_total")))
        .withColumn("cumulative_pct", percent(ratio("_so_far", "_total")))
    )


def defect_reason_pareto(star: Star) -> DataFrame:
    reasons = (
        star.fact.where(F.col("defect_flag") & F.col("defect_reason").isNotNull())
        .groupBy("defect_reason")
        .agg(F.count(F.lit(1)).alias("defect_count"))
    )
    return _pareto(reasons, "defect_count").select(
        "defect_reason", "defect_count", "pct_of_total", "cumulative_pct"
    ).orderBy(F.desc("defect_count"), "defect_reason")


def accessorial_pareto(star: Star) -> DataFrame:
    """Accessorial spend by defect reason with share and running share."""
    kpis = ["shipment_count", "total_accessorial", "avg_accessorial"]
    reason = F.coalesce("defect_reason", F.lit(NO_DEFECT_LABEL)).alias("reason")
    charged = star.fact.where(F.col("accessorial_cost_usd") > 0)
    reasons = gather(
        charged.select(reason, "accessorial_cost_usd"), ["reason"], kpis
    )
    return _pareto(reasons, "accessorial_sum").select(
        "reason",
        kpi("shipment_count").alias("shipment_count"),
        kpi("total_accessorial").alias("total_accessorial"),
        rounded(kpi("avg_accessorial"), 2).alias("avg_accessorial"),
        "pct_of_total",
        "cumulative_pct",
    ).orderBy(F.desc("total_accessorial"), "reason")


def seasonal_cost_lift(star: Star) -> DataFrame:
    """Peak quarter against the rest of the year."""
    kpis = [
        "shipment_count",
        "avg_cost",
        "cpm",
        "avg_linehaul",
        "avg_accessorial",
        "otp_rate",
    ]
    days = by_day(star, kpis).withColumn("period", period_label())
    return (
        merge(days, ["period"], kpis)
        .select(
            "period",
            kpi("shipment_count").alias("shipment_count"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost_per_shipment"),
            rounded(kpi("cpm"), 2).alias("avg_cpm"),
            rounded(kpi("avg_linehaul"), 2).alias("avg_linehaul"),
            rounded(kpi("avg_accessorial"), 2).alias("avg_accessorial"),
            percent(kpi("otp_rate")).alias("otp_pct"),
        )
        .orderBy("period")
    )


def _per_service(star: Star, kpis: list[str]) -> DataFrame:
    parts = gather(star.fact, ["service_type_id"], kpis)
    return merge(parts.join(star.service, "service_type_id"), ["service_name"], kpis)


def cost_per_pallet_by_service(star: Star) -> DataFrame:
    kpis = [
        "shipment_count",
        "cost_per_pallet",
        "avg_cost",
        "avg_pallets",
        "avg_utilization",
    ]
    return (
        _per_service(star, kpis)
        .select(
            "service_name",
            kpi("shipment_count").alias("shipment_count"),
            rounded(kpi("cost_per_pallet"), 2).alias("avg_cost_per_pallet"),
            rounded(kpi("avg_cost"), 2).alias("avg_cost_per_shipment"),
            rounded(kpi("avg_pallets"), 1).alias("avg_pallets_per_shipment"),
            percent(kpi("avg_utilization")).alias("avg_utilization_pct"),
        )
        .orderBy("avg_cost_per_pallet")
    )


def utilization_by_service(star: Star, *, approx: bool = False) -> DataFrame:
    """Mean, quartiles and under-half share of trailer utilisation per service.

    ``approx`` takes the quartiles from mergeable sketches instead of sorting the values.
    """
    fill = (
        linked(star.fact, "service_type_id")
        .groupBy("service_type_id", "trailer_utilization_pct")
        .agg(F.count(F.lit(1)).alias("shipments"))
        .join(star.service.where(F.col("service_name").isNotNull()), "service_type_id")
    )
    shares = {"p25": 0.25, "p50": 0.50, "p75": 0.75}
    if approx:
        sketches = gather_from(star, ["service_type_id"], ["n", "util_kll"])
        named = sketches.join(star.service, "service_type_id")
        quartiles = sketched(named, ["service_name"], "util_kll", shares)
    else:
        quartiles = percentiles(
            fill, ["service_name"], "trailer_utilization_pct", "shipments", shares
        )
    # the same counts per distinct value also give the means
    value, n = F.col("trailer_utilization_pct"), F.col("shipments")
    known = F.when(value.isNotNull(), n)
    totals = fill.groupBy("service_name").agg(
        F.sum(n).alias("shipment_count"),
        ratio(F.sum(value * n), F.sum(known)).alias("mean"),
        ratio(F.coalesce(F.sum(F.when(value < 0.5, n)), F.lit(0)), F.sum(n)).alias("low"),
    )
    return (
        totals.join(quartiles, "service_name")
        .select(
            "service_name",
            "shipment_count",
            percent("mean").alias("avg_utilization_pct"),
            percent("p25").alias("util_p25"),
            percent("p50").alias("util_p50"),
            percent("p75").alias("util_p75"),
            percent("low").alias("pct_under_50"),
        )
        .orderBy("avg_utilization_pct", "service_name")
    )


def negative_dwell_audit(star: Star) -> DataFrame:
    parts = gather(star.fact, [], ["n", "early_n", "early_sum", "early_min"])
    return parts.select(
        F.col("early_n").alias("negative_dwell_count"),
        F.col("n").alias("total_shipments"),
        percent(ratio("early_n", "n"), 3).alias("negative_dwell_pct"),
        rounded("early_min", 1).alias("most_negative_minutes"),
        rounded(ratio("early_sum", "early_n"), 1).alias("avg_negative_minutes"),
        F.lit(EARLY_ARRIVAL_NOTE).alias("handling_note"),
    )


def network_kpis(star: Star, *, exclude_unknown_pickup: bool = False) -> DataFrame:
    """Nine network measures in one row.

    ``exclude_unknown_pickup`` leaves shipments without a pickup time out of the
    on-time pickup rate; all other measures keep them.
    """
    otp = "otp_known_rate" if exclude_unknown_pickup else "otp_rate"
    kpis = [
        "shipment_count",
        otp,
        "otd_rate",
        "avg_dwell",
        "defect_rate",
        "avg_utilization",
        "avg_cost",
        "cpm",
        "total_cost",
    ]
    return gather(star.fact, [], kpis).select(
        kpi("shipment_count").alias("total_shipments"),
        percent(kpi(otp)).alias("otp_pct"),
        percent(kpi("otd_rate")).alias("otd_pct"),
        rounded(kpi("avg_dwell"), 1).alias("avg_dwell"),
        percent(kpi("defect_rate"), 2).alias("defect_rate_pct"),
        percent(kpi("avg_utilization")).alias("avg_utilization_pct"),
        rounded(kpi("avg_cost"), 2).alias("avg_cost_per_shipment"),
        rounded(kpi("cpm"), 2).alias("avg_cpm"),
        rounded(kpi("total_cost")).alias("total_cost"),
    )


def mom_cost_change(star: Star) -> DataFrame:
    """Total cost per month and its change on the month before, in percent."""
    kpis = ["total_cost"]
    monthly = merge(by_day(star, kpis), ["year", "month"], kpis).withColumn(
        "total_cost", kpi("total_cost")
    )
    previous = F.lag("total_cost").over(Window.orderBy("year", "month"))
    return monthly.select(
        "year",
        "month",
        "total_cost",
        previous.alias("prev_month_cost"),
        settled(ratio(F.col("total_cost") - previous, previous) * 100).alias(
            "mom_change_pct"
        ),
    ).orderBy("year", "month")
