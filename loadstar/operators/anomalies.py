"""Anomaly detectors, reason hints and the rows of the daily briefing."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadstar.functions.calendar import day_literal
from loadstar.functions.measures import gather, kpi, merge
from loadstar.functions.numeric import half_even, percent, ratio, rounded, settled
from loadstar.operators.network import by_week
from loadstar.operators.ordered import percentiles
from loadstar.schema import NETWORK_OTP_TARGET_PCT
from loadstar.star import Star, lane_label

# Texts that appear in results.
HINT_ACCESSORIAL = "Spike in detention accessorials"
HINT_SPOT = "Spot-tier reliance surge"
HINT_DEFECT = "Carrier-specific defect cluster"
HINT_COLLAPSE = "OTP collapse on weekday lanes"
HINT_IMPROVED = "Unusual OTP improvement"


def _severity(size: Column, high: float, medium: float) -> Column:
    return F.when(size > high, "HIGH").when(size > medium, "MEDIUM").otherwise("LOW")


def zscore_flags(
    star: Star,
    *,
    window: int = 8,
    min_n: int = 5,
    z_max: float = 2.5,
    high: float = 3.5,
    medium: float = 3.0,
    week_key: str = "iso",
) -> DataFrame:
    """Lane-weeks whose OTP is far from the ``window`` qualifying weeks before.

    Weeks with fewer than ``min_n`` shipments are dropped first, so the window
    counts qualifying weeks. A lane's window holds one row per week.
    """
    weeks = qualifying_weeks(star, min_n=min_n, week_key=week_key)
    return _scored(weeks, window).transform(_flags, z_max, high, medium)


def qualifying_weeks(star: Star, *, min_n: int = 5, week_key: str = "iso") -> DataFrame:
    """``lane_id, year, week_of_year, week_start, otp`` of weeks with enough shipments."""
    weekly = by_week(star, ["shipment_count", "otp_rate"], week_key, ["lane_id"])
    return weekly.where(F.col("n") >= min_n).select(
        "lane_id", "year", "week_of_year", "week_start", kpi("otp_rate").alias("otp")
    )


def _scored(weeks: DataFrame, window: int) -> DataFrame:
    """Weeks with a full window before them and their z-score against it."""
    before = (
        Window.partitionBy("lane_id")
        .orderBy("year", "week_of_year")
        .rowsBetween(-window, -1)
    )
    return (
        weeks.withColumns(
            {
                "expected": F.avg("otp").over(before),
                "spread": F.stddev_samp("otp").over(before),
                "weeks": F.count("otp").over(before),
            }
        )
        .where((F.col("weeks") == window) & (settled("spread") > 0))
        .withColumn("z", ratio(F.col("otp") - F.col("expected"), "spread"))
    )


def _flags(scored: DataFrame, z_max: float, high: float, medium: float) -> DataFrame:
    size = settled(F.abs("z"))
    return scored.where(size > z_max).select(
        "lane_id",
        "week_start",
        "year",
        "week_of_year",
        half_even("otp", 4).alias("otp_observed"),
        half_even("expected", 4).alias("otp_expected"),
        half_even("z", 3).alias("z_score"),
        _severity(size, high, medium).alias("severity"),
    )


def last_weeks(weeks: DataFrame, *, window: int = 8) -> DataFrame:
    """The state that later weeks need: each lane's last ``window`` qualifying weeks."""
    latest = Window.partitionBy("lane_id").orderBy(F.desc("year"), F.desc("week_of_year"))
    ranked = weeks.withColumn("_nth", F.row_number().over(latest))
    return ranked.where(F.col("_nth") <= window).drop("_nth")


def zscore_next(
    state: DataFrame,
    weeks: DataFrame,
    *,
    window: int = 8,
    z_max: float = 2.5,
    high: float = 3.5,
    medium: float = 3.0,
) -> tuple[DataFrame, DataFrame]:
    """Flags of new ``weeks``, from them and the carried ``state`` alone, and the next state.

    ``weeks`` are qualifying weeks, all later than those of the state. At most ``window``
    rows of each lane are carried, so a refresh reads the new weeks of the fact and no others.
    """
    known = state.withColumn("_new", F.lit(False)).unionByName(
        weeks.withColumn("_new", F.lit(True))
    )
    flags = _scored(known, window).where("_new").transform(_flags, z_max, high, medium)
    return flags, last_weeks(known.drop("_new"), window=window)


def anomaly_reason_hints(
    anomalies: DataFrame,
    star: Star,
    *,
    acc: float = 0.30,
    spot: float = 0.20,
    defect: float = 0.60,
    mode: str = "reference",
) -> DataFrame:
    """``anomalies`` with a ``reason_hint`` from the shipments behind each one.

    Every flagged lane-week becomes its seven lane-days, which are joined to the
    fact's totals per lane, day and carrier. ``mode='reference'`` raises
    the Spot hint whenever a Spot carrier moved anything; ``mode='share'``
    compares the Spot share of the week's volume with ``spot``.
    """
    if mode not in ("reference", "share"):
        raise ValueError(f"mode must be 'reference' or 'share', not {mode!r}")
    week = ["lane_id", "week_start"]
    offset = F.explode(F.sequence(F.lit(0), F.lit(6)))
    day = F.date_add("week_start", F.col("offset"))
    lane_days = (
        anomalies.select(*week)
        .distinct()
        .withColumn("offset", offset)
        .select(
            *week,
            F.date_format(day, "yyyyMMdd").cast("int").alias("shipment_date_key"),
        )
    )
    kpis = ["shipment_count", "accessorial_share", "defect_rate"]
    cells = gather(star.fact, ["lane_id", "shipment_date_key", "carrier_id"], kpis)
    tiers = merge(
        cells.join(lane_days, ["lane_id", "shipment_date_key"]).join(
            star.carrier.select("carrier_id", "carrier_tier"), "carrier_id"
        ),
        [*week, "carrier_tier"],
        kpis,
    )
    spot_n = F.sum(F.when(F.col("carrier_tier") == "Spot", F.col("n")).otherwise(0))
    spot_share = (
        F.when(spot_n > 0, F.lit(1.0)).otherwise(0.0)
        if mode == "reference"
        else ratio(spot_n, F.sum("n"))
    )
    detail = tiers.groupBy(*week).agg(
        F.avg(kpi("accessorial_share")).alias("_acc"),
        F.max(kpi("defect_rate")).alias("_defect"),
        spot_share.alias("_spot"),
    )
    hints = F.concat_ws(
        "; ",
        F.when(settled("_acc") > acc, HINT_ACCESSORIAL),
        F.when(F.col("_spot") > spot, HINT_SPOT),
        F.when(F.col("_defect") > defect, HINT_DEFECT),
    )
    fallback = F.when(F.col("z_score") < 0, HINT_COLLAPSE).otherwise(HINT_IMPROVED)
    return (
        anomalies.join(detail, week, "left")
        .withColumn("reason_hint", F.when(hints != "", hints).otherwise(fallback))
        .drop("_acc", "_defect", "_spot")
    )


def zscore_otp_anomalies(
    star: Star,
    *,
    window: int = 8,
    min_n: int = 5,
    z_max: float = 2.5,
    week_key: str = "iso",
    mode: str = "reference",
) -> DataFrame:
    """Flagged lane-weeks with severity and reason hint, in lane and time order."""
    flags = zscore_flags(
        star, window=window, min_n=min_n, z_max=z_max, week_key=week_key
    )
    return (
        anomaly_reason_hints(flags, star, mode=mode)
        .select(
            "lane_id",
            "week_start",
            "year",
            "week_of_year",
            "otp_observed",
            "otp_expected",
            "z_score",
            "severity",
            "reason_hint",
        )
        .orderBy("lane_id", "year", "week_of_year")
    )


def iqr_cost_anomalies(star: Star, *, k: float = 1.5, min_n: int = 3) -> DataFrame:
    """Carrier-days whose cost per mile lies above the upper fence of the haul type.

    The fence is Q3 + ``k`` x IQR over all carrier-days of a lane type; the
    quartiles are exact and spread over value buckets, not one task per type.
    """
    kpis = ["shipment_count", "cpm"]
    cells = gather(
        star.fact.where(F.col("distance_miles") > 0),
        ["carrier_id", "lane_id", "shipment_date_key"],
        kpis,
    )
    types = star.lane.select("lane_id", "lane_type").where(F.col("lane_type").isNotNull())
    keys = ["carrier_id", "lane_type", "shipment_date_key"]
    daily = (
        merge(cells.join(types, "lane_id"), keys, kpis)
        .where(F.col("n") >= min_n)
        .withColumn("cpm", kpi("cpm"))
    )
    quartiles = percentiles(
        daily.withColumn("_one", F.lit(1)),
        ["lane_type"],
        "cpm",
        "_one",
        {"q1": 0.25, "q3": 0.75},
    )
    fences = quartiles.select(
        "lane_type",
        (F.col("q3") + F.lit(float(k)) * (F.col("q3") - F.col("q1"))).alias("fence"),
    )
    return (
        daily.join(fences, "lane_type")
        .where(F.col("cpm") > F.col("fence"))
        .join(star.carrier, "carrier_id")
        .join(star.date, F.col("shipment_date_key") == F.col("date_key"))
        .select(
            "carrier_id",
            "carrier_name",
            "lane_type",
            "date",
            half_even("cpm", 2).alias("daily_cpm"),
            half_even("fence", 2).alias("upper_fence"),
            half_even(ratio(F.col("cpm") - F.col("fence"), "fence") * 100, 1).alias(
                "excess_pct"
            ),
            F.col("n").alias("volume"),
        )
        .orderBy("lane_type", "carrier_id", "date")
    )


def anomalies_filtered(
    zscores: DataFrame, *, severity: str | None = None, limit: int = 50
) -> DataFrame:
    """The latest z-score anomalies, optionally of one severity."""
    rows = zscores if severity is None else zscores.where(F.col("severity") == severity)
    return rows.orderBy(F.desc("week_start"), "lane_id").limit(limit)


def cost_anomalies_filtered(
    outliers: DataFrame, *, lane_type: str | None = None, limit: int = 50
) -> DataFrame:
    """The latest cost anomalies, optionally of one lane type."""
    rows = (
        outliers
        if lane_type is None
        else outliers.where(F.col("lane_type") == lane_type)
    )
    return rows.orderBy(F.desc("date"), "carrier_id", "lane_type").limit(limit)


def anomaly_count(
    zscores: DataFrame, outliers: DataFrame, *, as_of: date, days: int = 14
) -> DataFrame:
    """Flags raised in the last ``days`` days, one row per detector."""
    period = day_literal(as_of - timedelta(days=days)), day_literal(as_of)
    counted = F.count(F.lit(1)).alias("anomaly_count")
    lane_weeks = zscores.where(F.col("week_start").between(*period)).agg(counted)
    carrier_days = outliers.where(F.col("date").between(*period)).agg(counted)
    return lane_weeks.select(F.lit("zscore").alias("detector"), "anomaly_count").union(
        carrier_days.select(F.lit("iqr").alias("detector"), "anomaly_count")
    )


def briefing_rows(
    star: Star,
    *,
    as_of: date | None = None,
    days: int = 7,
    zscore_limit: int = 10,
    iqr_limit: int = 5,
    week_key: str = "iso",
) -> DataFrame:
    """What the daily briefing reports, as rows.

    Sections: ``headline`` (network OTP and cost of the last ``days`` days),
    ``zscore`` and ``iqr`` (the latest flags of each detector).
    """
    star, today = star.at(as_of)
    recent = gather(star.last_days(today, days), [], ["otp_rate", "avg_cost"])

    def rows(source: DataFrame, section: str, subject, day, value, against, score, note):
        return source.select(
            F.lit(section).alias("section"),
            subject.alias("subject"),
            day.alias("day"),
            value.cast("double").alias("value"),
            against.cast("double").alias("against"),
            score.cast("double").alias("score"),
            note.alias("note"),
        )

    lines = F.array(
        F.struct(
            F.lit("network OTP %").alias("subject"),
            percent(kpi("otp_rate")).alias("value"),
            F.lit(NETWORK_OTP_TARGET_PCT).alias("against"),
        ),
        F.struct(
            F.lit("average cost per shipment").alias("subject"),
            rounded(kpi("avg_cost")).alias("value"),
            F.lit(None).cast("double").alias("against"),
        ),
    )
    headline = rows(
        recent.select(F.inline(lines)),
        "headline",
        F.col("subject"),
        day_literal(today),
        F.col("value"),
        F.col("against"),
        F.lit(None),
        F.lit(None).cast("string"),
    )
    flags = anomalies_filtered(
        zscore_otp_anomalies(star, week_key=week_key), limit=zscore_limit
    ).join(star.lane, "lane_id")
    outliers = cost_anomalies_filtered(iqr_cost_anomalies(star), limit=iqr_limit)
    return (
        headline.unionByName(
            rows(
                flags,
                "zscore",
                lane_label(),
                F.col("week_start"),
                F.col("otp_observed"),
                F.col("otp_expected"),
                F.col("z_score"),
                F.col("reason_hint"),
            )
        )
        .unionByName(
            rows(
                outliers,
                "iqr",
                F.col("carrier_name"),
                F.col("date"),
                F.col("daily_cpm"),
                F.col("upper_fence"),
                F.col("excess_pct"),
                F.col("lane_type"),
            )
        )
    )


def anomaly_window_otp(
    star: Star,
    *,
    lanes: tuple[int, ...] = (1, 2, 3),
    tier: str = "Spot",
    first: date | None = None,
    before: date | None = None,
) -> DataFrame:
    """OTP of one carrier tier on given lanes, optionally within a date range."""
    parts = gather(
        star.between(first, before).where(F.col("lane_id").isin(list(lanes))),
        ["carrier_id"],
        ["otp_rate"],
    )
    wanted = star.carrier.where(F.col("carrier_tier") == tier)
    matched = parts.join(wanted, "carrier_id", "left_semi")
    return merge(matched, [], ["otp_rate"]).select(kpi("otp_rate").alias("otp"))
