"""KPI formulas as mergeable parts.

A KPI is a formula over sums, counts, minima and maxima. The parts are gathered
once per fact key (with map-side combining), dimensions are joined to the small
result, and the parts are merged again at the level the report asks for. The
fact itself is therefore never joined and never shuffled row by row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstar.functions.numeric import ratio, settled
from loadstar.schema import FOREIGN_KEYS
from loadstar.star import Star

def _cost_per_mile() -> Column:
    return ratio("total_cost_usd", "distance_miles")


def _cost_per_pallet() -> Column:
    return ratio("total_cost_usd", "pallet_count")


def _accessorial_share() -> Column:
    return ratio("accessorial_cost_usd", "total_cost_usd")


def _positive_dwell() -> Column:
    return F.when(F.col("dwell_minutes") > 0, F.col("dwell_minutes"))


def _negative_dwell() -> Column:
    return F.when(F.col("dwell_minutes") < 0, F.col("dwell_minutes"))


# Sketches are parts too: they merge like sums. The quantiles are off by about 0.2 % of the
# ranks, distinct counts by about 0.4 %, and counts of up to some thousands come out exact.
QUANTILE_SIZE = 2000
DISTINCT_BITS = 16


def _quantiles(value: Column) -> Column:
    return F.kll_sketch_agg_double(value.cast("double"), QUANTILE_SIZE)


def _distinct(key: str) -> Column:
    return F.hll_sketch_agg(F.col(key).cast("bigint"), DISTINCT_BITS)


# part name -> aggregate over fact rows
_PARTS: dict[str, Callable[[], Column]] = {
    "n": lambda: F.count(F.lit(1)),
    "on_time": lambda: F.count_if(F.col("on_time_pickup")),
    "on_time_known": lambda: F.count_if(
        F.col("on_time_pickup") & F.col("pickup_actual_ts").isNotNull()
    ),
    "pickup_known": lambda: F.count("pickup_actual_ts"),
    "delivered_on_time": lambda: F.count_if(F.col("on_time_delivery")),
    "defects": lambda: F.count_if(F.col("defect_flag")),
    "dwell_sum": lambda: F.sum(_positive_dwell()),
    "dwell_n": lambda: F.count(_positive_dwell()),
    "early_n": lambda: F.count(_negative_dwell()),
    "early_sum": lambda: F.sum(_negative_dwell()),
    "early_min": lambda: F.min(_negative_dwell()),
    "util_sum": lambda: F.sum("trailer_utilization_pct"),
    "util_under_half": lambda: F.count_if(F.col("trailer_utilization_pct") < 0.5),
    "weight_sum": lambda: F.sum("weight_lbs"),
    "pallet_sum": lambda: F.sum("pallet_count"),
    "miles_sum": lambda: F.sum("distance_miles"),
    "cost_sum": lambda: F.sum("total_cost_usd"),
    "linehaul_sum": lambda: F.sum("linehaul_cost_usd"),
    "accessorial_sum": lambda: F.sum("accessorial_cost_usd"),
    "cpm_sum": lambda: F.sum(_cost_per_mile()),
    "cpm_n": lambda: F.count(_cost_per_mile()),
    "cpm_min": lambda: F.min(_cost_per_mile()),
    "cpm_max": lambda: F.max(_cost_per_mile()),
    "cpp_sum": lambda: F.sum(_cost_per_pallet()),
    "cpp_n": lambda: F.count(_cost_per_pallet()),
    "acc_share_sum": lambda: F.sum(_accessorial_share()),
    "acc_share_n": lambda: F.count(_accessorial_share()),
    "dwell_kll": lambda: _quantiles(_positive_dwell()),
    "util_kll": lambda: _quantiles(F.col("trailer_utilization_pct")),
    "carriers_hll": lambda: _distinct("carrier_id"),
    "lanes_hll": lambda: _distinct("lane_id"),
    "shippers_hll": lambda: _distinct("shipper_id"),
}


def _value(part: str) -> Callable[[], Column]:
    return lambda: F.col(part).cast("double")


def _rate(top: str, bottom: str) -> Callable[[], Column]:
    """Ratio of exact counts or decimal sums."""
    return lambda: ratio(top, bottom)


def _mean(total: str, count: str) -> Callable[[], Column]:
    """Average of doubles, free of the noise that summation order leaves."""
    return lambda: settled(ratio(total, count))


# KPI name -> (parts it needs, formula over them)
_KPIS: dict[str, tuple[tuple[str, ...], Callable[[], Column]]] = {
    "shipment_count": (("n",), lambda: F.col("n")),
    "otp_rate": (("on_time", "n"), _rate("on_time", "n")),
    # shipments without a pickup time left out of both counts
    "otp_known_rate": (("on_time_known", "pickup_known"), _rate("on_time_known", "pickup_known")),
    "otd_rate": (("delivered_on_time", "n"), _rate("delivered_on_time", "n")),
    "defect_rate": (("defects", "n"), _rate("defects", "n")),
    "defect_free_rate": (
        ("defects", "n"),
        lambda: ratio(F.col("n") - F.col("defects"), "n"),
    ),
    "avg_dwell": (("dwell_sum", "dwell_n"), _mean("dwell_sum", "dwell_n")),
    "avg_utilization": (("util_sum", "n"), _mean("util_sum", "n")),
    "avg_weight": (("weight_sum", "n"), _mean("weight_sum", "n")),
    "avg_pallets": (("pallet_sum", "n"), _rate("pallet_sum", "n")),
    "avg_miles": (("miles_sum", "n"), _mean("miles_sum", "n")),
    "avg_cost": (("cost_sum", "n"), _rate("cost_sum", "n")),
    "total_cost": (("cost_sum",), _value("cost_sum")),
    "avg_linehaul": (("linehaul_sum", "n"), _rate("linehaul_sum", "n")),
    "avg_accessorial": (("accessorial_sum", "n"), _rate("accessorial_sum", "n")),
    "total_accessorial": (("accessorial_sum",), _value("accessorial_sum")),
    # mean of per-shipment ratios
    "cpm": (("cpm_sum", "cpm_n"), _mean("cpm_sum", "cpm_n")),
    "cost_per_pallet": (("cpp_sum", "cpp_n"), _mean("cpp_sum", "cpp_n")),
    "accessorial_share": (
        ("acc_share_sum", "acc_share_n"),
        _mean("acc_share_sum", "acc_share_n"),
    ),
    # ratio of the sums: a different number
    "accessorial_of_total": (
        ("accessorial_sum", "cost_sum"),
        _rate("accessorial_sum", "cost_sum"),
    ),
    "util_under_half_rate": (("util_under_half", "n"), _rate("util_under_half", "n")),
    "active_carriers": (("carriers_hll",), lambda: F.hll_sketch_estimate("carriers_hll")),
    "active_lanes": (("lanes_hll",), lambda: F.hll_sketch_estimate("lanes_hll")),
    "active_shippers": (("shippers_hll",), lambda: F.hll_sketch_estimate("shippers_hll")),
}


def kpi(name: str) -> Column:
    """The formula of a KPI over gathered parts."""
    return _KPIS[name][1]()


def parts_of(kpis: Iterable[str]) -> list[str]:
    """The parts a list of KPI (or part) names needs, without repeats."""
    parts: dict[str, None] = {}
    for name in kpis:
        for part in _KPIS[name][0] if name in _KPIS else (name,):
            parts[part] = None
    return list(parts)


def part_aggregates(kpis: Iterable[str]) -> list[Column]:
    """The aggregates over fact rows that ``kpis`` need, named by part."""
    return [_PARTS[p]().alias(p) for p in parts_of(kpis)]


def linked(fact: DataFrame, *keys: str) -> DataFrame:
    """Fact rows whose foreign keys among ``keys`` are filled.

    The joins to the dimensions drop the others anyway. Saying so at the scan
    gives every branch of a plan the same filter, so that branches which differ
    only in their later joins still share one scan and one shuffle.
    """
    filled = [F.col(k).isNotNull() for k in keys if k in FOREIGN_KEYS]
    return fact.where(reduce(Column.__and__, filled)) if filled else fact


def gather(fact: DataFrame, keys: Sequence[str], kpis: Iterable[str]) -> DataFrame:
    """Parts of ``kpis`` per fact key: one pass with partial aggregation."""
    return linked(fact, *keys).groupBy(*keys).agg(*part_aggregates(kpis))


def _merge_part(part: str) -> Column:
    if part.endswith("_min"):
        merged = F.min(part)
    elif part.endswith("_max"):
        merged = F.max(part)
    elif part.endswith("_kll"):
        merged = F.kll_merge_agg_double(part, QUANTILE_SIZE)
    elif part.endswith("_hll"):
        merged = F.hll_union_agg(part)
    else:
        merged = F.sum(part)
    return merged.alias(part)


def merge(
    parts: DataFrame, keys: Sequence[str], kpis: Iterable[str], *extra: Column
) -> DataFrame:
    """Merge gathered parts to coarser ``keys``; ``extra`` are further aggregates."""
    aggs = [_merge_part(p) for p in parts_of(kpis)]
    return parts.groupBy(*keys).agg(*aggs, *extra)


def gather_from(star: Star, keys: Sequence[str], kpis: Iterable[str]) -> DataFrame:
    """Parts of ``kpis`` per key, merged from the star's stored parts where it has them.

    Stored parts serve if their grain has all of ``keys`` and its other keys drop no
    rows; the coarsest grain that serves is read. Otherwise the fact is.
    """
    needed = parts_of(kpis)

    def serves(grain: tuple[str, ...], table: DataFrame) -> bool:
        others = set(grain) - set(keys)
        return set(keys) <= set(grain) and not others & set(FOREIGN_KEYS) and set(needed) <= set(table.columns)

    found = [(len(grain), table) for grain, table in star.parts.items() if serves(grain, table)]
    if not found:
        return gather(star.fact, keys, needed)
    return merge(min(found, key=lambda f: f[0])[1], keys, needed)


def sketched(
    parts: DataFrame, keys: Sequence[str], sketch: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """Approximate percentiles per group, in the shape of ``ordered.percentiles``.

    Merges the parts ``n`` and ``sketch``; a group without values has NULLs.
    """
    merged = merge(parts, keys, ["n", sketch])
    known = F.kll_sketch_get_n_double(sketch) > 0
    return merged.select(
        *keys,
        F.col("n").alias("row_count"),
        *[
            F.when(known, F.kll_sketch_get_quantile_double(sketch, F.lit(float(p)))).alias(name)
            for name, p in probabilities.items()
        ],
    )
