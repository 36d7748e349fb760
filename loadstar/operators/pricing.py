"""Pricing recommendations for the largest shippers."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstar.functions.measures import kpi, part_aggregates
from loadstar.functions.numeric import half_even, ratio
from loadstar.operators.shippers import growth_rate, volume_growth
from loadstar.schema import BENCHMARK_CPM
from loadstar.star import Star

# Actions and driver texts that appear in results.
HOLD = "Hold"
RENEGOTIATE = "Renegotiate Up"
DISCOUNT = "Volume Discount"
NO_DRIVER = "Metrics within normal range"
DRIVER_UNPROFITABLE = ("Unprofitable: cost exceeds revenue by ", "%")
DRIVER_DECLINE = ("Volume declining ", "% (90d vs prior 90d)")
DRIVER_OTD = ("Below-target OTD: ", "%")
DRIVER_DEFECT = ("Elevated defect rate: ", "%")
DRIVER_GROWTH = ("Strong growth (+", "%) with high OTD (", "%)")


def _text(value: Column, digits: int) -> Column:
    """Fixed decimals, ties to even, no thousands separators."""
    return F.translate(F.format_number(value, digits), ",", "")


def _limited(value: Column, low: float, high: float) -> Column:
    return F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), value))


@dataclass(frozen=True)
class Limits:
    """Where the rules begin, and the least and most percent they change a rate by."""

    decline: float = -0.20
    growth: float = 0.10
    good_service: float = 0.92
    poor_service: float = 0.85
    defects: float = 0.03
    increase: tuple[float, float] = (3, 15)
    decline_discount: tuple[float, float] = (2, 8)
    growth_discount: tuple[float, float] = (2, 5)


def pricing_recommendations(
    star: Star,
    *,
    as_of: date | None = None,
    top: int = 20,
    benchmark_cpm: float = BENCHMARK_CPM,
    markup: float = 1.08,
    limits: Limits = Limits(),
) -> DataFrame:
    """Action, size and up to two drivers for the ``top`` shippers by volume.

    Revenue is taken as benchmark rate x markup x miles. A loss asks for a rate
    increase; otherwise a falling volume, or strong growth with good service,
    earns a discount. One pass over the fact gathers metrics and growth alike.
    """
    star, today = star.at(as_of)
    kpis = [
        "shipment_count",
        "avg_cost",
        "cpm",
        "total_cost",
        "avg_miles",
        "otd_rate",
        "defect_rate",
    ]
    shippers = (
        volume_growth(star, today, 90, *part_aggregates(kpis))
        .join(star.shipper, "shipper_id")
        .orderBy(F.desc("n"), "shipper_id")
        .limit(top)
    )
    revenue = (
        F.lit(float(benchmark_cpm)) * F.lit(float(markup)) * kpi("avg_miles") * F.col("n")
    )
    growth, otd, defect = F.col("growth_rate"), F.col("otd_rate"), F.col("defect_rate")
    gap, profitable = F.col("cost_gap_pct"), F.col("is_profitable")
    declining = growth < limits.decline
    rewarded = profitable & ~declining & (growth > limits.growth) & (otd > limits.good_service)
    drivers = F.array_compact(
        F.array(
            F.when(
                ~profitable,
                F.concat(
                    F.lit(DRIVER_UNPROFITABLE[0]),
                    _text(gap, 0),
                    F.lit(DRIVER_UNPROFITABLE[1]),
                ),
            ),
            F.when(
                declining,
                F.concat(
                    F.lit(DRIVER_DECLINE[0]),
                    _text(growth * 100, 0),
                    F.lit(DRIVER_DECLINE[1]),
                ),
            ),
            F.when(
                otd < limits.poor_service,
                F.concat(
                    F.lit(DRIVER_OTD[0]), _text(otd * 100, 1), F.lit(DRIVER_OTD[1])
                ),
            ),
            F.when(
                defect > limits.defects,
                F.concat(
                    F.lit(DRIVER_DEFECT[0]),
                    _text(defect * 100, 1),
                    F.lit(DRIVER_DEFECT[1]),
                ),
            ),
            F.when(
                rewarded,
                F.concat(
                    F.lit(DRIVER_GROWTH[0]),
                    _text(growth * 100, 0),
                    F.lit(DRIVER_GROWTH[1]),
                    _text(otd * 100, 0),
                    F.lit(DRIVER_GROWTH[2]),
                ),
            ),
        )
    )
    action = (
        F.when(~profitable, RENEGOTIATE)
        .when(declining | rewarded, DISCOUNT)
        .otherwise(HOLD)
    )
    change = (
        F.when(~profitable, _limited(gap / 2, *limits.increase))
        .when(declining, -_limited(F.abs(growth) * 10, *limits.decline_discount))
        .when(rewarded, -_limited(growth * 20, *limits.growth_discount))
        .otherwise(F.lit(0.0))
    )
    return (
        shippers.select(
            "shipper_id",
            "shipper_name",
            "vendor_type",
            F.col("n").alias("shipment_count"),
            kpi("avg_cost").alias("avg_cost"),
            kpi("cpm").alias("cpm"),
            kpi("otd_rate").alias("otd_rate"),
            kpi("defect_rate").alias("defect_rate"),
            growth_rate().alias("growth_rate"),
            (revenue > kpi("total_cost")).alias("is_profitable"),
            (ratio(kpi("total_cost") - revenue, revenue) * 100).alias("cost_gap_pct"),
        )
        .withColumn("drivers", drivers)
        .select(
            "shipper_id",
            "shipper_name",
            "vendor_type",
            "shipment_count",
            half_even("avg_cost", 2).alias("avg_cost_per_shipment"),
            half_even("cpm", 2).alias("avg_cpm"),
            half_even("otd_rate", 4).alias("otd_rate"),
            half_even("defect_rate", 4).alias("defect_rate"),
            half_even("growth_rate", 4).alias("growth_rate"),
            "is_profitable",
            action.alias("recommendation"),
            half_even(change, 1).alias("pct_change"),
            F.coalesce(F.get("drivers", F.lit(0)), F.lit(NO_DRIVER)).alias("driver_1"),
            F.coalesce(F.get("drivers", F.lit(1)), F.lit("")).alias("driver_2"),
        )
        .orderBy(F.desc("shipment_count"), "shipper_id")
    )
