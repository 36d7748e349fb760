"""Data-quality operators. Each returns rows; none raises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstar import schema
from loadstar.functions.measures import gather
from loadstar.functions.numeric import percent, ratio
from loadstar.star import Star


def _check(df: DataFrame, name: str, value: Column, passed: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("check_name"),
        value.cast("double").alias("value"),
        passed.alias("passed"),
    )


def _stack(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def row_count(star: Star, *, minimum: int = 1_000_000) -> DataFrame:
    n = F.col("n")
    return _check(_count(star.fact), "row_count", n, n >= minimum)


def distinct_lanes(star: Star, *, minimum: int = 200) -> DataFrame:
    lanes = star.lane.agg(F.count_distinct("lane_id").alias("n"))
    return _check(lanes, "distinct_lanes", F.col("n"), F.col("n") >= minimum)


def fk_orphans(
    star: Star, *, foreign_keys: Mapping[str, tuple[str, str]] = schema.FOREIGN_KEYS
) -> DataFrame:
    """Fact rows without a dimension row, one result row per foreign key.

    All keys are counted per value in one pass over the fact and looked up in one
    anti join. A NULL key counts as an orphan.
    """
    return _orphans(star, _key_counts(star.fact, foreign_keys), foreign_keys)


def _key_counts(fact: DataFrame, foreign_keys: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Rows per value of every foreign key, in one pass."""
    pairs = [
        F.struct(F.lit(c).alias("fk"), F.col(c).cast("bigint").alias("value"))
        for c in foreign_keys
    ]
    return fact.select(F.inline(F.array(*pairs))).groupBy("fk", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def _orphans(
    star: Star, used: DataFrame, foreign_keys: Mapping[str, tuple[str, str]]
) -> DataFrame:
    tables = star.tables()
    known = _stack(
        [
            tables[table].select(F.lit(column).alias("fk"), F.col(key).cast("bigint").alias("value"))
            for column, (table, key) in foreign_keys.items()
        ]
    )
    orphans = used.join(known, ["fk", "value"], "left_anti").groupBy("fk").agg(F.sum("n").alias("orphans"))
    names = star.fact.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, foreign_keys))).alias("fk"))
    n = F.coalesce("orphans", F.lit(0))
    return names.join(orphans, "fk", "left").select(
        F.concat(F.lit("orphan_"), "fk").alias("check_name"),
        n.cast("double").alias("value"),
        (n == 0).alias("passed"),
    )


def cost_identity(star: Star) -> DataFrame:
    """Linehaul + fuel + accessorial must equal the total to the cent."""
    parts = (
        F.col("linehaul_cost_usd")
        + F.col("fuel_surcharge_usd")
        + F.col("accessorial_cost_usd")
    )
    wrong = star.fact.agg(F.count_if(parts != F.col("total_cost_usd")).alias("n"))
    return _check(wrong, "cost_identity", F.col("n"), F.col("n") == 0)


def null_pickup(star: Star) -> DataFrame:
    """How many pickups have no recorded time (information only)."""
    found = star.fact.agg(F.count_if(F.col("pickup_actual_ts").isNull()).alias("n"))
    return _check(found, "null_pickup", F.col("n"), F.lit(True))


def negative_dwell(star: Star) -> DataFrame:
    """How many shipments have negative dwell (information only)."""
    found = star.fact.agg(F.count_if(F.col("dwell_minutes") < 0).alias("n"))
    return _check(found, "negative_dwell", F.col("n"), F.lit(True))


def top_shipper_concentration(
    star: Star, *, top: int = 20, minimum: float = 0.50
) -> DataFrame:
    """Share of the ``top`` shippers in all shipments."""
    return _concentration(gather(star.fact, ["shipper_id"], ["n"]), "shipper_id", top, minimum)


def _concentration(volumes: DataFrame, key: str, top: int, minimum: float) -> DataFrame:
    total = volumes.agg(F.sum("n")).scalar()
    share = (
        volumes.orderBy(F.desc("n"), key)
        .limit(top)
        .agg(F.sum("n").alias("n"))
        .select(ratio("n", total).alias("share"))
    )
    name = f"top{top}_concentration"
    return _check(share, name, F.col("share"), F.col("share") >= minimum)


def blocking_checks(star: Star) -> DataFrame:
    """The checks whose failure makes a star unusable."""
    return _stack([fk_orphans(star), cost_identity(star), pk_unique(star)])


def all_checks(
    star: Star, *, min_rows: int = 1_000_000, min_lanes: int = 200
) -> DataFrame:
    """Every check of the load report, one row each.

    Two passes over the fact: one aggregate for the checks of single rows, one count
    per key value for the orphans and the shippers' shares.
    """
    parts = F.col("linehaul_cost_usd") + F.col("fuel_surcharge_usd") + F.col("accessorial_cost_usd")
    rows = star.fact.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(parts != F.col("total_cost_usd")).alias("cost_identity"),
        F.count_if(F.col("pickup_actual_ts").isNull()).alias("null_pickup"),
        F.count_if(F.col("dwell_minutes") < 0).alias("negative_dwell"),
    )
    passed = {
        "row_count": F.col("row_count") >= min_rows,
        "cost_identity": F.col("cost_identity") == 0,
        "null_pickup": F.lit(True),
        "negative_dwell": F.lit(True),
    }
    scalars = rows.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check_name"),
                        F.col(name).cast("double").alias("value"),
                        ok.alias("passed"),
                    )
                    for name, ok in passed.items()
                ]
            )
        )
    )
    used = _key_counts(star.fact, schema.FOREIGN_KEYS)
    shippers = used.where((F.col("fk") == "shipper_id") & F.col("value").isNotNull())
    return _stack(
        [
            scalars,
            distinct_lanes(star, minimum=min_lanes),
            _orphans(star, used, schema.FOREIGN_KEYS),
            _concentration(shippers, "value", 20, 0.50),
        ]
    )


def pk_unique(star: Star) -> DataFrame:
    """Rows beyond the first for each primary key, per table."""
    checks = []
    for name, table in star.tables().items():
        key = schema.TABLES[name].fieldNames()[0]
        extra = (
            table.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra"))
        )
        n = F.col("extra")
        checks.append(_check(extra, f"duplicate_{name}", n, n == 0))
    return _stack(checks)


def not_null(star: Star) -> DataFrame:
    """NULLs in columns that must be filled, one row per column."""
    checks = []
    for name, table in star.tables().items():
        required = [f.name for f in schema.TABLES[name].fields if not f.nullable]
        audit = null_audit(table, required)
        label = F.concat(F.lit(f"not_null_{name}."), F.col("column_name"))
        n = F.col("null_count")
        checks.append(
            audit.select(
                label.alias("check_name"),
                n.cast("double").alias("value"),
                (n == 0).alias("passed"),
            )
        )
    return _stack(checks)


def domains(star: Star) -> DataFrame:
    """Tier and service names must be exactly the known sets."""

    def matches(df: DataFrame, column: str, known: Sequence[str], name: str):
        expected = F.col(column).isin(list(known))
        seen = df.select(column).distinct().agg(
            F.count(F.lit(1)).alias("found"), F.count_if(expected).alias("expected")
        )
        found = F.col("found")
        passed = (found == len(known)) & (F.col("expected") == len(known))
        return _check(seen, name, found, passed)

    services = [s[0] for s in schema.SERVICES]
    return _stack(
        [
            matches(star.carrier, "carrier_tier", schema.CARRIER_TIERS, "carrier_tiers"),
            matches(star.service, "service_name", services, "service_names"),
        ]
    )


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULL count and share of each column: one pass, one row per column."""
    counts = [F.count_if(F.col(c).isNull()).alias(c) for c in columns]
    one_row = df.agg(F.count(F.lit(1)).alias("_rows"), *counts)
    return one_row.unpivot(["_rows"], list(columns), "column_name", "null_count").select(
        "column_name",
        "null_count",
        F.col("_rows").alias("total_rows"),
        percent(ratio("null_count", "_rows"), 3).alias("null_pct"),
    )


def fact_null_audit(
    star: Star,
    columns: Sequence[str] = (
        "pickup_actual_ts",
        "delivery_actual_ts",
        "defect_reason",
    ),
) -> DataFrame:
    return null_audit(star.fact, columns).orderBy(F.desc("null_pct"), "column_name")
