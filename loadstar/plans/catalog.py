"""Every named query, as a function of a star.

``as_of`` is fixed to the last day of the derived star. Queries named like the
original reports use the calendar year beside the ISO week, as those reports do;
the ``_iso`` variants use the ISO week-year, under which weeks sort in time.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstar import schema
from loadstar.functions import calendar
from loadstar.functions.measures import gather
from loadstar.operators import (
    anomalies,
    bootstrap,
    carriers,
    dashboards,
    forecast,
    hypothesis,
    lanes,
    network,
    ordered,
    pricing,
    quality,
    reports,
    shippers,
    views,
)
from loadstar.sources import warehouse
from loadstar.sources.increments import refreshed
from loadstar.sources.orders_star import AS_OF, FIRST_DAY, LAST_DAY
from loadstar.sources.rejects import read_csv_sorted
from loadstar.sources.session import new_folder
from loadstar.star import Star, date_key

Query = Callable[[Star], DataFrame]

_CALENDAR = {"week_key": "calendar"}
_DATED = {"as_of": AS_OF}
# a day in the middle of the data, for queries that look back from one
_PAST = date(2024, 8, 18)
# destination nodes of the derived star, one per region
_NODES = tuple(f"FC{i}" for i in range(5))


def _exported(star: Star) -> DataFrame:
    """Write the four KPI tables as CSV and count what was written."""
    spark = star.fact.sparkSession
    paths = views.export_kpi_tables(
        star, new_folder(spark, "kpi-tables"), as_of=AS_OF, week_key="calendar"
    )
    counts = [
        spark.read.option("header", True)
        .csv(path)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(path.rsplit("/", 1)[1]).alias("table_name"), "row_count")
        for path in paths
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def _kept(name: str, query: Query) -> Query:
    """Write the result as CSV, read it back with its types, and return what was read."""

    def written(star: Star) -> DataFrame:
        table = query(star)
        path = new_folder(star.fact.sparkSession, name)
        warehouse.write_csv(table, path)
        return warehouse.read_csv(table.sparkSession, path, table.schema)

    return written


def _as_csv(star: Star, fact: DataFrame) -> str:
    """Write the tables as CSV files with headers, ``fact`` in place of the star's own."""
    path = new_folder(star.fact.sparkSession, "star-csv")
    for name, table in star.tables().items():
        rows = fact if name == "fact_shipment" else table.select(*schema.TABLES[name].fieldNames())
        warehouse.write_csv(rows, f"{path}/{name}.csv")
    return path


def _csv_loaded(star: Star) -> DataFrame:
    """Rows and key sums of all tables after a way through CSV files."""
    fact = star.fact.select(*schema.FACT.fieldNames())
    back = warehouse.read_csv_star(fact.sparkSession, _as_csv(star, fact))
    sums = {"fact_shipment": "total_cost_usd"}
    rows = [
        table.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum(sums.get(name, schema.TABLES[name].fieldNames()[0])).cast("double").alias("total"),
        ).select(F.lit(name).alias("table_name"), "*")
        for name, table in back.tables().items()
    ]
    return reduce(DataFrame.unionByName, rows)


def _csv_rejects(star: Star) -> DataFrame:
    """Problems per column of shipments spoiled on three lanes, and the rows that are left."""
    lane = F.col("lane_id")
    text = {c: F.col(c).cast("string") for c in schema.FACT.fieldNames()}
    spoiled = {
        "carrier_id": F.when(lane == 1, "n/a").otherwise(text["carrier_id"]),
        "total_cost_usd": F.when(lane != 2, text["total_cost_usd"]),
        "pickup_appt_ts": F.when(lane == 3, "yesterday").otherwise(text["pickup_appt_ts"]),
    }
    fact = star.fact.select(*[v.alias(c) for c, v in (text | spoiled).items()])
    found = read_csv_sorted(fact.sparkSession, _as_csv(star, fact))
    problems = found.rejects.groupBy("table_name", "column_name", "reason").agg(
        F.count(F.lit(1)).alias("shipments")
    )
    kept = found.star.fact.agg(F.count(F.lit(1)).alias("shipments")).select(
        F.lit("fact_shipment").alias("table_name"),
        F.lit("").alias("column_name"),
        F.lit("kept").alias("reason"),
        "shipments",
    )
    return problems.unionByName(kept)


# Sundays that end the periods after which a detector's state is carried on
_STOPS = (date(2024, 8, 18), date(2024, 10, 6))


def _zscore_carried(star: Star) -> DataFrame:
    """Flags after the first stop, period by period from the state of the one before."""
    spark = star.fact.sparkSession

    def kept(state: DataFrame) -> DataFrame:
        path = new_folder(spark, "zscore-state")
        state.write.parquet(path)
        return spark.read.schema(state.schema).parquet(path)

    days = [None, *(d + timedelta(days=1) for d in _STOPS), None]
    state, found = None, []
    for first, before in zip(days, days[1:], strict=False):
        period = replace(star, fact=star.between(first, before), parts={})
        weeks = anomalies.qualifying_weeks(period)
        if state is None:
            state = kept(anomalies.last_weeks(weeks))
            continue
        flags, state = anomalies.zscore_next(state, weeks)
        found.append(flags)
        if before is not None:
            state = kept(state)
    return reduce(DataFrame.unionByName, found)


_grown_stars: dict[int, tuple[Star, Star]] = {}


def _grown(query: Query) -> Query:
    """Ask a warehouse that was loaded without one day and got that day later."""

    def asked(star: Star) -> DataFrame:
        if id(star) not in _grown_stars:
            path = new_folder(star.fact.sparkSession, "warehouse")
            # the star is kept beside, so that its id stays its own
            _grown_stars[id(star)] = (star, refreshed(star, date_key(_PAST), path))
        return query(_grown_stars[id(star)][1])

    return asked


def _months(star: Star) -> DataFrame:
    """Shipments and cost of every month."""
    month = F.expr("CAST(shipment_date_key div 100 AS INT)").alias("month")
    return star.fact.groupBy(month).agg(
        F.count(F.lit(1)).alias("shipments"),
        F.sum("total_cost_usd").cast("double").alias("total_cost"),
        F.count_distinct("shipment_date_key").alias("days"),
    )


def _on_time_audit(star: Star) -> DataFrame:
    """Stored on-time flags against flags derived from the timestamps."""
    stored = star.fact.withColumnsRenamed(
        {"on_time_pickup": "stored_pickup", "on_time_delivery": "stored_delivery"}
    )
    derived = calendar.derive_on_time(stored)
    return derived.groupBy("on_time_pickup", "on_time_delivery").agg(
        F.count(F.lit(1)).alias("shipments"),
        F.count_if(F.col("on_time_pickup") != F.col("stored_pickup")).alias(
            "pickup_differs"
        ),
        F.count_if(F.col("on_time_delivery") != F.col("stored_delivery")).alias(
            "delivery_differs"
        ),
    )


def _calendar_volume(star: Star) -> DataFrame:
    """The calendar with the shipments of each day."""
    days = calendar.dim_date(star.fact.sparkSession, FIRST_DAY, LAST_DAY)
    volume = gather(star.fact, ["shipment_date_key"], ["n"])
    return days.join(
        volume, F.col("date_key") == F.col("shipment_date_key"), "left"
    ).select(*schema.DATE.fieldNames(), F.coalesce("n", F.lit(0)).alias("shipments"))


def _lane_classes(star: Star) -> DataFrame:
    """Shipments per haul class, the class taken from each shipment's distance."""
    haul = calendar.classify_lane(F.col("distance_miles")).alias("haul")
    return star.fact.groupBy(haul).agg(
        F.count(F.lit(1)).alias("shipments"),
        F.min("distance_miles").alias("min_miles"),
        F.max("distance_miles").alias("max_miles"),
    )


def _carrier_cost_ranks(star: Star) -> DataFrame:
    """Every carrier ranked by total spend over the network."""
    spend = gather(star.fact, ["carrier_id"], ["cost_sum"]).select(
        "carrier_id", F.col("cost_sum").cast("double").alias("total_cost")
    )
    return ordered.global_rank(spend, "total_cost", descending=True, name="cost_rank")


def _anomaly_count(star: Star, *, as_of: date = AS_OF) -> DataFrame:
    star, as_of = star.at(as_of)
    return anomalies.anomaly_count(
        anomalies.zscore_flags(star, **_CALENDAR),
        anomalies.iqr_cost_anomalies(star),
        as_of=as_of,
    )


def _latest_high(star: Star) -> DataFrame:
    found = anomalies.zscore_otp_anomalies(star, **_CALENDAR)
    return anomalies.anomalies_filtered(found, severity="HIGH")


def _latest_long_haul_cost(star: Star) -> DataFrame:
    return anomalies.cost_anomalies_filtered(
        anomalies.iqr_cost_anomalies(star), lane_type="Long"
    )


QUERIES: dict[str, Query] = {
    # lanes, carriers, shippers, network
    "q01_top10_lanes_by_volume": lanes.top_lanes_by_volume,
    "q02_otp_by_carrier_tier": carriers.otp_rank_within_tier,
    "q03_dwell_percentiles_by_carrier": carriers.dwell_percentiles_by_carrier,
    "q04_defect_rate_trend_monthly": network.defect_trend_monthly,
    "q05_carrier_lane_otp_matrix": carriers.carrier_lane_otp_matrix,
    "q06_otp_by_dayofweek": network.otp_by_weekday,
    "q07_weekly_otp_trend_vs_target": partial(
        network.weekly_otp_vs_target, **_CALENDAR
    ),
    "q07_weekly_otp_trend_vs_target_iso": network.weekly_otp_vs_target,
    "q08_late_pickup_cascade": network.late_pickup_cascade,
    "q09_defect_reason_pareto": network.defect_reason_pareto,
    "q10_dwell_outliers_by_lane": lanes.dwell_outliers_by_lane,
    "q11_cost_per_mile_by_carrier_tier": carriers.cost_per_mile_by_tier,
    "q12_accessorial_pct_by_carrier": carriers.accessorial_share_by_carrier,
    "q13_top20_shippers_costtoserve": shippers.top_shippers_cost_to_serve,
    "q14_lane_profitability_vs_benchmark": lanes.profitability_vs_benchmark,
    "q15_seasonal_cost_lift_q4": network.seasonal_cost_lift,
    "q16_accessorial_pareto_by_reason": network.accessorial_pareto,
    "q17_cost_per_pallet_by_service_type": network.cost_per_pallet_by_service,
    "q18_haul_economics": lanes.haul_economics,
    "q19_trailer_utilization_by_service": network.utilization_by_service,
    "q20_underutilized_lanes_top20": lanes.underutilized_lanes,
    "q21_modal_mismatch_candidates": lanes.modal_mismatch_candidates,
    # the derived star has no lane above the original limits; these find some
    "q21_modal_mismatch_candidates_low": partial(
        lanes.modal_mismatch_candidates, min_util=0.62, min_weight=23500
    ),
    "q22_intermodal_candidates": lanes.intermodal_candidates,
    "q23_carrier_concentration": carriers.carrier_concentration,
    "q24_shipper_volume_pareto": shippers.shipper_volume_pareto,
    "q25_origin_state_volume": lanes.origin_state_volume,
    "q26_inbound_node_load_balance": lanes.inbound_node_balance,
    "q27_otp_wow_pct_change": partial(network.otp_week_over_week, **_CALENDAR),
    "q27_otp_wow_pct_change_iso": network.otp_week_over_week,
    "q28_carriers_otp_decline": partial(carriers.otp_decline, **_DATED),
    "q29_lanes_dwell_spike": partial(lanes.dwell_spikes, **_DATED),
    "q30_anomaly_summary_14d": partial(views.anomaly_summary, **_DATED),
    "q31_paired_t_test": hypothesis.strategic_vs_tactical_otp,
    "q32_chi_square": hypothesis.defects_vs_tier,
    "q33_mann_whitney": hypothesis.peak_cost_lift,
    "q34_null_audit": quality.fact_null_audit,
    "q35_negative_dwell_audit": network.negative_dwell_audit,
    # views and KPI tables
    "v_carrier_scorecard": views.carrier_scorecard,
    "v_lane_performance": views.lane_performance,
    "v_weekly_kpis": partial(views.weekly_kpis, **_CALENDAR),
    "v_weekly_kpis_iso": views.weekly_kpis,
    "v_shipper_costtoserve": views.shipper_cost_to_serve,
    "v_shipper_health": partial(shippers.shipper_health, **_DATED),
    "v_anomaly_flags": partial(views.anomaly_flags, **_DATED),
    "network_kpis": network.network_kpis,
    "network_kpis_known_pickup": partial(
        network.network_kpis, exclude_unknown_pickup=True
    ),
    "export_kpi_tables": _exported,
    "mom_cost_change": network.mom_cost_change,
    "bi_extract_60d": partial(views.bi_extract, **_DATED),
    "derive_on_time": _on_time_audit,
    "dim_date": _calendar_volume,
    "classify_lane": _lane_classes,
    "classify_shipper_tier": shippers.classify_shipper_tier,
    "global_rank": _carrier_cost_ranks,
    "table_row_counts": warehouse.row_counts,
    # anomalies, pricing, forecasts
    "zscore_otp_anomalies": partial(anomalies.zscore_otp_anomalies, **_CALENDAR),
    "zscore_otp_anomalies_iso": anomalies.zscore_otp_anomalies,
    "anomaly_reason_hints_share": partial(
        anomalies.zscore_otp_anomalies, mode="share", **_CALENDAR
    ),
    "iqr_cost_anomalies": anomalies.iqr_cost_anomalies,
    "anomaly_count_14d": _anomaly_count,
    "briefing_rows": partial(anomalies.briefing_rows, **_DATED, **_CALENDAR),
    "pricing_recommendations": partial(pricing.pricing_recommendations, **_DATED),
    "whatif_bootstrap_ci": bootstrap.whatif_bootstrap_ci,
    "lane_primary_carrier": lanes.lane_primary_carrier,
    "otp_weekly_series": partial(forecast.otp_weekly_series, **_CALENDAR),
    "cost_daily_series": forecast.cost_daily_series,
    "forecast_otp": partial(forecast.forecast_otp, **_DATED, **_CALENDAR),
    "forecast_cost": partial(forecast.forecast_cost, **_DATED),
    "forecast_otp_by_lane": partial(
        forecast.forecast_otp, keys=("lane_id",), **_DATED, **_CALENDAR
    ),
    "forecast_cost_by_carrier": partial(
        forecast.forecast_cost, keys=("carrier_id",), **_DATED
    ),
    # data quality
    "dq_row_count": quality.row_count,
    "dq_distinct_lanes": quality.distinct_lanes,
    "dq_fk_orphans": quality.fk_orphans,
    "dq_cost_identity": quality.cost_identity,
    "dq_null_pickup": quality.null_pickup,
    "dq_negative_dwell": quality.negative_dwell,
    "dq_top20_concentration": quality.top_shipper_concentration,
    "dq_pk_unique": quality.pk_unique,
    "dq_not_null": quality.not_null,
    "dq_domain": quality.domains,
    "dq_report": quality.all_checks,
    # report tables
    "report_kpi_snapshot": reports.kpi_snapshot,
    "report_carrier_month": reports.carrier_month,
    "report_lane_heatmap": reports.lane_heatmap,
    "report_shipper_service_cts": reports.shipper_service_cost,
    "report_accessorial_drivers": reports.accessorial_drivers,
    "report_daily_trend": reports.daily_trend,
    # dashboard datasets
    "exec_kpi_period_delta": partial(dashboards.kpi_period_delta, **_DATED),
    "exec_weekly_otp_26": partial(dashboards.weekly_otp_trailing, **_CALENDAR),
    "exec_top_issues": partial(dashboards.top_issues, **_DATED),
    "health_filtered": partial(
        dashboards.health_filtered, vendor_type="Brand", **_DATED
    ),
    "lane_otp_pivot": partial(dashboards.lane_otp_pivot, nodes=_NODES),
    "lane_otp_long": dashboards.lane_otp_pivot,
    "lane_best_worst_10": dashboards.lane_best_worst,
    "carrier_filtered": partial(dashboards.carrier_filtered, tier="Spot"),
    "carrier_lane_mix": dashboards.carrier_lane_mix,
    "carrier_defects": dashboards.carrier_defects,
    "anomalies_filtered": _latest_high,
    "cost_anomalies_filtered": _latest_long_haul_cost,
    "whatif_lanes_top50": dashboards.busiest_lanes,
    "tier_overview": dashboards.tier_overview,
    "filter_values": dashboards.filter_values,
    "anomaly_window_otp": anomalies.anomaly_window_otp,
}

QUERIES |= {
    f"{name}_past": partial(QUERIES[name], as_of=_PAST)
    for name in (
        "q28_carriers_otp_decline",
        "q29_lanes_dwell_spike",
        "q30_anomaly_summary_14d",
        "v_shipper_health",
        "v_anomaly_flags",
        "bi_extract_60d",
        "anomaly_count_14d",
        "briefing_rows",
        "pricing_recommendations",
        "exec_kpi_period_delta",
        "exec_top_issues",
        "health_filtered",
        "forecast_otp",
        "forecast_cost",
        "forecast_otp_by_lane",
        "forecast_cost_by_carrier",
    )
}

# The tables a refresh leaves behind: written, read back, and compared in full.
SINKS = (
    "v_weekly_kpis",
    "v_carrier_scorecard",
    "v_lane_performance",
    "v_shipper_health",
    "zscore_otp_anomalies",
    "iqr_cost_anomalies",
    "pricing_recommendations",
    "forecast_otp",
    "forecast_cost",
    "bi_extract_60d",
)
QUERIES |= {f"sink_{name}": _kept(f"sink-{name}", QUERIES[name]) for name in SINKS}

# Asked of a warehouse with stored KPI parts, after a day that came late.
GROWN = ("v_weekly_kpis", "v_carrier_scorecard", "v_lane_performance", "v_shipper_costtoserve", "network_kpis")
QUERIES |= {f"grown_{name}": _grown(QUERIES[name]) for name in GROWN}
QUERIES |= {
    "zscore_carried": _zscore_carried,
    "csv_star_loaded": _csv_loaded,
    "csv_star_rejects": _csv_rejects,
    "grown_months": _grown(_months),
    "approx_dwell_ranks": _grown(carriers.dwell_rank_errors),
}
QUERIES |= {
    f"active_parties_{level}": _grown(partial(views.active_parties, level=level))
    for level in ("day", "week", "month", "year", "network")
}
