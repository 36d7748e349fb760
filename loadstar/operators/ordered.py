"""Exact order statistics without putting a whole group into one task.

A window over one group, or over the whole table, runs in one task. Here the
rows are first counted per distinct value, the value range is cut into buckets
holding about equally many distinct values, and each window runs inside one
(group, bucket). Bucket totals, at most ``buckets`` per group, give every bucket
its starting position. All results are exact for any number of buckets; the
cuts only decide how the work is spread.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadstar.functions.numeric import settled

_NULL_BUCKET = -1


def bucket_count(df: DataFrame, buckets: int | None) -> int:
    """``buckets``, or as many as the session has shuffle partitions, at least 64.

    A session tuned for more data cuts finer, so that a group holding a third of
    all distinct values still falls into many tasks.
    """
    if buckets is not None:
        return buckets
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(64, partitions)


def _value_counts(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Weight (and sums of ``carry``) per (keys, distinct value)."""
    return df.groupBy(*keys, F.col(value).alias("_v")).agg(
        F.sum(weight).alias("_w"), *[F.sum(c).alias(c) for c in carry]
    )


def _all_used(counts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``counts`` with a condition that always holds but reads ``columns``.

    Without it the optimiser drops these columns from one branch of the plan,
    the branches stop sharing a shuffle, and the input is read once per branch.
    """
    return counts.where(F.greatest(*columns, F.lit(0)) >= 0) if columns else counts


def _with_bucket(
    counts: DataFrame,
    keys: Sequence[str],
    buckets: int | None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``counts`` with the bucket ``_b`` of each value, laid out by (keys, bucket).

    The bucket is the number of cuts below the value, found in two steps: first
    among every ``step``-th cut, then among the cuts that follow it. The layout
    serves the bucket totals and the windows inside buckets alike.
    """
    buckets = bucket_count(counts, buckets)
    step = math.isqrt(buckets)
    shares = ", ".join(f"{i / buckets!r}D" for i in range(1, buckets))
    cuts = (
        _all_used(counts, ["_w", *carry])
        .agg(F.expr(f"percentile_approx(_v, array({shares}), {50 * buckets}) AS fine"))
        .select(
            F.expr(
                f"struct(fine, filter(fine, (c, i) -> (i + 1) % {step} = 0) AS coarse)"
            )
        )
    )
    jump = f"size(filter(_cuts.coarse, c -> c < _v)) * {step}"
    rest = f"size(filter(slice(_cuts.fine, _jump + 1, {step}), c -> c < _v))"
    return (
        counts.withColumn("_cuts", cuts.scalar())
        .withColumn("_jump", F.expr(jump))
        .withColumn(
            "_b", F.expr(f"CASE WHEN _v IS NULL THEN {_NULL_BUCKET} ELSE _jump + {rest} END")
        )
        .drop("_cuts", "_jump")
        .repartition(*keys, "_b")
    )


def _bucket_offsets(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per (keys, bucket): weight before it, and the totals of the group."""
    known = F.expr(f"CASE WHEN _b <> {_NULL_BUCKET} THEN _bw END")
    ahead = Window.partitionBy(*keys).orderBy("_b").rowsBetween(
        Window.unboundedPreceding, -1
    )
    group = Window.partitionBy(*keys)
    return (
        counts.groupBy(*keys, "_b")
        .agg(F.sum("_w").alias("_bw"))
        .select(
            *keys,
            "_b",
            "_bw",
            F.coalesce(F.sum(known).over(ahead), F.lit(0)).alias("_ahead"),
            F.coalesce(F.sum(known).over(group), F.lit(0)).alias("_known"),
            F.sum("_bw").over(group).alias("_rows"),
        )
    )


def _join_buckets(
    counts: DataFrame, offsets: DataFrame, keys: Sequence[str]
) -> DataFrame:
    on = " AND ".join(f"c.{k} <=> o.{k}" for k in [*keys, "_b"])
    carried = [f"o.{c}" for c in offsets.columns if c not in {*keys, "_b", "_bw"}]
    return (
        counts.alias("c")
        .join(offsets.alias("o"), F.expr(on))
        .select("c.*", *carried)
    )


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    *,
    carry: Sequence[str] = (),
    descending: bool = False,
    buckets: int | None = None,
) -> DataFrame:
    """Per (keys, distinct value): ``weight_here``, ``weight_before``, ``weight_total``.

    ``weight_before`` sums the rows that sort strictly ahead of the value, so
    with a weight of 1 per row the standard rank is ``weight_before + 1``. Rows
    with a NULL value are left out; ``carry`` columns are summed per value.
    """
    sign = -1 if descending else 1
    known = df.where(F.col(value).isNotNull()).withColumn(
        "_signed", F.col(value) * F.lit(sign)
    )
    counts = _with_bucket(
        _value_counts(known, keys, "_signed", weight, carry), keys, buckets, carry
    )
    offsets = _bucket_offsets(_all_used(counts, carry), keys).drop("_rows")
    inside = (
        Window.partitionBy(*keys, "_b")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return _join_buckets(counts, offsets, keys).select(
        *keys,
        (F.col("_v") * F.lit(sign)).alias(value),
        F.col("_w").alias("weight_here"),
        (F.col("_ahead") + F.coalesce(F.sum("_w").over(inside), F.lit(0))).alias(
            "weight_before"
        ),
        F.col("_known").alias("weight_total"),
        *carry,
    )


def cumulative_top(
    df: DataFrame, value: str, limit: int, tie_break: Sequence[str]
) -> DataFrame:
    """The ``limit`` largest rows with the running sum of ``value`` beside them.

    Adds ``position`` (1 is the largest), ``running`` (all rows of ``df`` at
    least as large, ties included even when they fall behind the limit) and
    ``overall`` (the sum over all of ``df``). The windows run over at most
    ``limit`` rows.
    """
    top = df.orderBy(F.desc(value), *tie_break).limit(limit)
    peers = df.groupBy(value).agg(F.sum(value).alias("_peers"))
    largest = peers.orderBy(F.desc(value)).limit(limit)
    first = Window.orderBy(F.desc(value))
    running = largest.select(
        value,
        F.sum("_peers")
        .over(first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("running"),
    )
    overall = df.agg(F.sum(value)).scalar()
    order = Window.orderBy(F.desc(value), *tie_break)
    return top.join(running, value).select(
        F.row_number().over(order).alias("position"),
        *df.columns,
        "running",
        overall.alias("overall"),
    )


def global_rank(
    df: DataFrame,
    value: str,
    *,
    keys: Sequence[str] = (),
    descending: bool = False,
    name: str = "rank",
    buckets: int | None = None,
) -> DataFrame:
    """``df`` with the standard rank (ties share the lowest) of ``value``.

    Equals ``rank() over (partition by keys order by value)`` except that rows
    with a NULL value get a NULL rank.
    """
    ranks = running_totals(
        df.withColumn("_one", F.lit(1)),
        keys,
        value,
        "_one",
        descending=descending,
        buckets=buckets,
    ).select(*keys, value, (F.col("weight_before") + 1).alias(name))
    on = [F.col(f"d.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*keys, value]]
    joined = df.alias("d").join(ranks.alias("r"), on, "left")
    return joined.select("d.*", F.col(f"r.{name}").alias(name))


def percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    weight: str,
    probabilities: Mapping[str, float],
    *,
    buckets: int | None = None,
) -> DataFrame:
    """Exact interpolated percentiles of ``value`` per group.

    ``weight`` counts how many rows stand behind each input row. One output row
    per group: a column per entry of ``probabilities`` plus ``row_count``, which
    also counts rows whose value is NULL. Only the buckets that hold a wanted
    position are sorted.
    """
    counts = _with_bucket(_value_counts(df, keys, value, weight), keys, buckets)
    offsets = _bucket_offsets(counts, keys)
    # Every probability has a position among the known values, usually between
    # two of them: the places just below and just above.
    positions = {n: f"(_known - 1) * {float(p)!r}D" for n, p in probabilities.items()}
    places = {
        f"_{n}_{side}": f"{function}({position})"
        for n, position in positions.items()
        for side, function in (("low", "floor"), ("high", "ceil"))
    }
    holds = [f"({p}) BETWEEN _ahead AND _ahead + _bw - 1" for p in places.values()]
    wanted = offsets.where(" OR ".join([f"_b = {_NULL_BUCKET}", *holds]))
    inside = (
        Window.partitionBy(*keys, "_b")
        .orderBy("_v")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = _join_buckets(counts, wanted, keys).withColumn(
        "_first", F.col("_ahead") + F.coalesce(F.sum("_w").over(inside), F.lit(0))
    )
    found = [
        F.expr(
            f"max(CASE WHEN _b <> {_NULL_BUCKET}"
            f" AND ({place}) BETWEEN _first AND _first + _w - 1 THEN _v END)"
        ).alias(name)
        for name, place in places.items()
    ]
    share = {n: f"({position} - floor({position}))" for n, position in positions.items()}
    results = [
        settled(F.expr(f"_{n}_low * (1 - {share[n]}) + _{n}_high * {share[n]}")).alias(n)
        for n in probabilities
    ]
    return (
        placed.groupBy(*keys)
        .agg(*found, F.max("_known").alias("_known"), F.max("_rows").alias("row_count"))
        .select(*keys, "row_count", *results)
    )
