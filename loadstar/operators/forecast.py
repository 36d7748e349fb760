"""Time series and their forecasts, many series at once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstar.functions.measures import kpi
from loadstar.functions.numeric import settled
from loadstar.operators.network import by_day, by_week
from loadstar.star import Star


def otp_weekly_series(
    star: Star, *, keys: Sequence[str] = (), week_key: str = "iso"
) -> DataFrame:
    """Weekly OTP of the network, or per ``keys`` (such as lane or carrier id)."""
    return by_week(star, ["otp_rate"], week_key, keys).select(
        *keys, "year", "week_of_year", "week_start", kpi("otp_rate").alias("otp")
    )


def cost_daily_series(star: Star, *, keys: Sequence[str] = ()) -> DataFrame:
    """Total cost per day of the network, or per ``keys``."""
    return by_day(star, ["total_cost"], keys).select(
        *keys, "date", kpi("total_cost").alias("daily_cost")
    )


def _report(value: Column) -> Column:
    """Six decimals; settled first, as sums of cents often end in an exact half."""
    return settled(settled(value, 8), 6)


def without_gaps(
    series: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    *,
    every: int = 1,
    missing: float | None = None,
    until: date | None = None,
) -> DataFrame:
    """``keys, time, value`` with a row for every step from a series' start to ``until``.

    Steps are ``every`` days apart. All series end on the same day, by default the last
    that any of them has: one that stopped earlier has empty steps from there on. A step
    without a row, or with a NULL value, gets ``missing``; without that, the value of the
    step before it.
    """
    ends = series.groupBy(*keys).agg(
        F.min(time).alias("_first"), F.max(time).alias("_last")
    )
    last = ends.agg(F.max("_last")).scalar() if until is None else F.lit(until)
    ends = ends.withColumn("_end", last).where(F.col("_first") <= F.col("_end"))
    steps = F.sequence("_first", "_end", F.expr(f"INTERVAL {int(every)} DAYS"))
    calendar = ends.select(*keys, F.explode(steps).alias(time))
    known = series.select(*keys, time, value)
    filled = calendar.join(known, [*keys, time], "left")
    if missing is not None:
        return filled.withColumn(value, F.coalesce(value, F.lit(missing)))
    before = (
        Window.partitionBy(*keys)
        .orderBy(time)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return filled.withColumn(value, F.last(value, ignorenulls=True).over(before))


def series_forecast(
    series: DataFrame,
    keys: Sequence[str],
    time: str,
    value: str,
    *,
    period: int,
    horizon: int,
    min_history: int,
    ci: float = 0.95,
    every: int = 1,
    missing: float | None = None,
    until: date | None = None,
) -> DataFrame:
    """Seasonal random walk with drift: ``step``, ``forecast``, ``lower``, ``upper``.

    The forecast repeats the last season, moved by the mean change from one
    season to the next; the interval widens with the square root of the seasons
    ahead. Steps are ``every`` days apart, and gaps are filled first, up to one last
    step ``until`` for all series (see ``without_gaps``): a season is a stretch of time
    and not of rows, and step 1 is the same day in every series. Series shorter than ``min_history`` steps are left out. A window holds one series,
    one row per time step; all series run in parallel.
    """
    order = Window.partitionBy(*keys).orderBy(time)
    whole = Window.partitionBy(*keys)
    series = without_gaps(
        series, keys, time, value, every=every, missing=missing, until=until
    )
    changes = series.select(
        *keys,
        F.col(value).alias("y"),
        F.row_number().over(order).alias("t"),
        (F.col(value) - F.lag(value, period).over(order)).alias("change"),
    )
    fitted = changes.select(
        *keys,
        "y",
        "t",
        F.count(F.lit(1)).over(whole).alias("n"),
        F.avg("change").over(whole).alias("drift"),
        F.stddev_samp("change").over(whole).alias("sigma"),
    )
    place = F.col("t") - (F.col("n") - F.lit(period))
    last_season = (
        fitted.where((F.col("n") >= max(min_history, period + 2)) & (place >= 1))
        .withColumn("place", place.cast("int"))
        .where(F.col("place") <= horizon)
    )
    z = NormalDist().inv_cdf(0.5 + ci / 2)
    seasons = ((F.col("step") - F.col("place")) / period + 1).cast("double")
    middle = F.col("y") + seasons * F.col("drift")
    margin = F.lit(z) * F.col("sigma") * F.sqrt(seasons)
    steps = F.explode(F.sequence(F.col("place"), F.lit(horizon), F.lit(period)))
    return (
        last_season.withColumn("step", steps)
        .select(
            *keys,
            "step",
            _report(middle).alias("forecast"),
            _report(middle - margin).alias("lower"),
            _report(middle + margin).alias("upper"),
        )
        .orderBy(*keys, "step")
    )


def forecast_otp(
    star: Star,
    *,
    as_of: date | None = None,
    keys: Sequence[str] = (),
    horizon: int = 4,
    period: int = 4,
    min_history: int = 20,
    ci: float = 0.95,
    week_key: str = "iso",
) -> DataFrame:
    """Weekly OTP, ``horizon`` weeks ahead, for the network or per ``keys``.

    A week without shipments keeps the rate of the week before. Week 1 follows the week
    of ``as_of``, and nothing shipped later is seen.
    """
    until = as_of and as_of - timedelta(days=as_of.weekday())
    if as_of is not None:
        star, _ = star.at(as_of)
    weeks = otp_weekly_series(star, keys=keys, week_key=week_key)
    monday = F.trunc("week_start", "week")
    found = series_forecast(
        weeks.withColumn("week_start", monday),
        keys,
        "week_start",
        "otp",
        period=period,
        horizon=horizon,
        min_history=min_history,
        ci=ci,
        every=7,
        until=until,
    )
    return found.withColumnsRenamed(
        {
            "step": "week",
            "forecast": "otp_forecast",
            "lower": "otp_lower",
            "upper": "otp_upper",
        }
    )


def forecast_cost(
    star: Star,
    *,
    as_of: date | None = None,
    keys: Sequence[str] = (),
    horizon: int = 28,
    period: int = 7,
    min_history: int = 30,
    ci: float = 0.95,
) -> DataFrame:
    """Daily total cost, ``horizon`` days ahead, for the network or per ``keys``.

    A day without shipments costs nothing. Day 1 follows ``as_of``, and nothing shipped
    later is seen.
    """
    if as_of is not None:
        star, _ = star.at(as_of)
    found = series_forecast(
        cost_daily_series(star, keys=keys),
        keys,
        "date",
        "daily_cost",
        period=period,
        horizon=horizon,
        min_history=min_history,
        ci=ci,
        missing=0.0,
        until=as_of,
    )
    return found.withColumnsRenamed(
        {
            "step": "day",
            "forecast": "cost_forecast",
            "lower": "cost_lower",
            "upper": "cost_upper",
        }
    )
