"""Calendar helpers: the date dimension, week keys, on-time flags."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar.schema import (
    MID_HAUL_MAX_MILES,
    ON_TIME_TOLERANCE_MINUTES,
    PEAK_MONTHS,
    SHORT_HAUL_MAX_MILES,
)


def day_literal(day: date) -> Column:
    return F.lit(day.isoformat()).cast("date")


def dim_date(
    spark: SparkSession, start: date, end: date, holidays: Collection[date] = ()
) -> DataFrame:
    """One row per day from ``start`` to ``end``, both included."""
    days = spark.range((end - start).days + 1).select(
        F.date_add(day_literal(start), F.col("id").cast("int")).alias("date")
    )
    day, month = F.col("date"), F.month("date")
    holiday = day.isin(list(holidays)) if holidays else F.lit(False)
    return days.select(
        (F.year(day) * 10000 + month * 100 + F.dayofmonth(day)).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        month.alias("month"),
        F.weekofyear(day).alias("week_of_year"),
        F.weekday(day).alias("day_of_week"),
        (F.weekday(day) >= 5).alias("is_weekend"),
        holiday.alias("is_holiday"),
        month.isin(list(PEAK_MONTHS)).alias("is_peak_season"),
    )


def week_year(week_key: str) -> Column:
    """The year that goes with ``week_of_year``.

    ``iso``: the ISO week-year, under which weeks sort in time order.
    ``calendar``: the calendar year, which puts 30 December into week 1 of the
    year that is about to end.
    """
    if week_key == "iso":
        return F.extract(F.lit("yearofweek"), F.col("date")).cast("int")
    if week_key == "calendar":
        return F.col("year")
    raise ValueError(f"week_key must be 'iso' or 'calendar', not {week_key!r}")


def classify_lane(miles: Column) -> Column:
    return (
        F.when(miles <= SHORT_HAUL_MAX_MILES, "Short")
        .when(miles <= MID_HAUL_MAX_MILES, "Mid")
        .otherwise("Long")
    )


def on_time(
    actual: str, appointment: str, tolerance_minutes: int = ON_TIME_TOLERANCE_MINUTES
) -> Column:
    """Arrived no later than the appointment plus the tolerance; NULL if unknown."""
    grace = F.make_dt_interval(mins=F.lit(tolerance_minutes))
    return F.col(actual) <= F.col(appointment) + grace


def derive_on_time(
    fact: DataFrame, *, tolerance_minutes: int = ON_TIME_TOLERANCE_MINUTES
) -> DataFrame:
    """Both on-time flags recomputed from the timestamps."""
    return fact.withColumns(
        {
            "on_time_pickup": on_time(
                "pickup_actual_ts", "pickup_appt_ts", tolerance_minutes
            ),
            "on_time_delivery": on_time(
                "delivery_actual_ts", "delivery_appt_ts", tolerance_minutes
            ),
        }
    )
