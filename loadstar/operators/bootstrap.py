"""What-if: bootstrap intervals for moving a lane to another carrier."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstar.functions.measures import gather, linked
from loadstar.functions.numeric import ratio, settled
from loadstar.operators.lanes import lane_primary_carrier
from loadstar.operators.ordered import running_totals
from loadstar.star import Star

# Constants of a well-known 32-bit integer mixer.
_MIX_FACTOR = 73244475
_MASK_32 = 4294967295
_RANGE_32 = 4294967296.0


def _mix(x: np.ndarray) -> np.ndarray:
    """Scramble non-negative integers below 2^32 into others."""
    for _ in range(2):
        x = ((x ^ (x >> 16)) * _MIX_FACTOR) & _MASK_32
    return x ^ (x >> 16)


def _next(state: np.ndarray, step: np.ndarray) -> np.ndarray:
    return _mix((state + step) & _MASK_32)


def _history(fact: DataFrame) -> DataFrame:
    """Per carrier: distinct (cost, on time) outcomes with their rank interval.

    An outcome is coded as cents x 2 + on-time flag, so equal shipments collapse
    and ranks do not depend on any row order.
    """
    cents = (F.col("total_cost_usd") * 100).cast("bigint")
    flag = F.col("on_time_pickup").cast("bigint")
    outcomes = linked(fact, "carrier_id").select(
        "carrier_id", (cents * 2 + flag).alias("outcome"), F.lit(1).alias("shipments")
    )
    return running_totals(outcomes, ["carrier_id"], "outcome", "shipments")


def _chunks(known: DataFrame, chunk: int) -> DataFrame:
    """Outcomes by rank as arrays: ``carrier_id, n, first, outcomes`` of ``chunk`` ranks each.

    A run of equal outcomes that spans several chunks is dealt over them, so no row
    holds more than ``chunk`` shipments however many a carrier has.
    """
    first, total = F.col("weight_before"), F.col("weight_total")
    last = first + F.col("weight_here") - 1

    def of(rank: Column) -> Column:
        return F.floor(rank / F.lit(chunk)).cast("bigint")

    begin = F.greatest("first", F.col("chunk") * chunk)
    end = F.least("last", F.col("chunk") * chunk + chunk - 1)
    runs = known.select(
        "carrier_id",
        total.alias("n"),
        "outcome",
        first.alias("first"),
        last.alias("last"),
        F.explode(F.sequence(of(first), of(last))).alias("chunk"),
    ).select(
        "carrier_id",
        "n",
        "chunk",
        F.struct(
            begin.alias("first"), "outcome", (end - begin + 1).cast("int").alias("shipments")
        ).alias("run"),
    )
    repeated = F.transform(
        F.sort_array(F.collect_list("run")),
        lambda r: F.array_repeat(r["outcome"], r["shipments"]),
    )
    return runs.groupBy("carrier_id", "n", "chunk").agg(F.flatten(repeated).alias("outcomes")).select(
        "carrier_id", "n", (F.col("chunk") * chunk).alias("first"), "outcomes"
    )


def _ranks(carrier: int, n: int, reps: int, draw: int, seed: int) -> np.ndarray:
    """The ranks that each resample draws, from a hash of carrier, resample and position."""
    state = _next(_next(np.int64(seed), np.int64(carrier)), np.arange(reps))
    state = _next(state[:, None], np.arange(1, min(draw, n) + 1)[None, :])
    return np.floor(state / _RANGE_32 * n).astype(np.int64)


_SUMS = "carrier_id long, rep int, size int, cents long, flags long"


def _resampled(
    batches: Iterator[pa.RecordBatch], reps: int, draw: int, seed: int
) -> Iterator[pa.RecordBatch]:
    """For each chunk and resample: what the draws that fall into the chunk add up to."""
    names = [c.split()[0] for c in _SUMS.split(", ")]
    for b in batches:
        heads = zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)
        for (carrier, n, first), outcomes in zip(heads, b.column(3), strict=True):
            outcomes = outcomes.values.to_numpy()
            ranks = _ranks(carrier, n, reps, draw, seed) - first
            here = (ranks >= 0) & (ranks < len(outcomes))
            drawn = np.where(here, outcomes[np.where(here, ranks, 0)], 0)
            sums = [(drawn >> 1).sum(axis=1), (drawn & 1).sum(axis=1)]
            same = [np.full(reps, v) for v in (carrier, min(draw, n))]
            columns = same[0], np.arange(reps, dtype=np.int32), same[1].astype(np.int32), *sums
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)


def carrier_bootstrap(
    star: Star,
    *,
    carriers: DataFrame | None = None,
    reps: int = 1000,
    draw: int = 100,
    min_n: int = 30,
    ci: float = 0.95,
    seed: int = 42,
    chunk: int | None = None,
) -> DataFrame:
    """Bootstrap mean and interval of OTP % and cost for every carrier.

    Each of ``reps`` resamples draws ``draw`` shipments (fewer for carriers with
    fewer) with replacement from the carrier's whole history. The history is laid
    out by rank in arrays of ``chunk`` shipments, by default as many as a carrier has
    draws, so that hashing the draws for each chunk costs no more than reading the history
    once; a draw is an array entry inside a task and never a row. Draws come from a hash of carrier, resample and position, so a
    task that runs twice draws the same. ``carriers`` limits the work to the given
    carrier ids.
    """
    fact = star.fact
    if carriers is not None:
        fact = fact.join(carriers.select("carrier_id"), "carrier_id", "left_semi")
    known = _history(fact).where(F.col("weight_total") >= min_n)
    chunks = _chunks(known, chunk or max(1, reps * draw))
    # every chunk is the same work, reps x draw hashes, so rows are dealt out evenly
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = (
        chunks.repartition(tasks, "carrier_id", "first")
        .mapInArrow(lambda b: _resampled(b, reps, draw, seed), _SUMS)
        .groupBy("carrier_id", "rep", "size")
        .agg(F.sum("cents").alias("cents"), F.sum("flags").alias("flags"))
    )
    means = sums.select(
        "carrier_id",
        (ratio(F.col("flags"), F.col("size")) * 100).alias("otp"),
        (ratio(F.col("cents"), F.col("size")) / 100).alias("cost"),
    )
    low, high = 0.5 - ci / 2, 0.5 + ci / 2
    # one value per resample and carrier, so the exact percentile stays small
    return means.groupBy("carrier_id").agg(
        F.avg("otp").alias("otp_mean"),
        F.percentile("otp", low).alias("otp_low"),
        F.percentile("otp", high).alias("otp_high"),
        F.avg("cost").alias("cost_mean"),
        F.percentile("cost", low).alias("cost_low"),
        F.percentile("cost", high).alias("cost_high"),
    )


def whatif_bootstrap_ci(
    star: Star,
    *,
    candidates: DataFrame | None = None,
    reps: int = 1000,
    draw: int = 100,
    min_n: int = 30,
    ci: float = 0.95,
    seed: int = 42,
) -> DataFrame:
    """Projected OTP and cost of giving a lane to a carrier, against today.

    ``candidates`` holds the (lane_id, carrier_id) moves to evaluate; by default
    every pair the network has shipped. Deltas are against the lane's primary
    carrier on that lane.
    """
    carriers = None if candidates is None else candidates.select("carrier_id").distinct()
    if candidates is None:
        candidates = gather(star.fact, ["lane_id", "carrier_id"], ["n"])
    primary = lane_primary_carrier(star).select(
        "lane_id",
        F.col("carrier_id").alias("current_carrier_id"),
        F.col("otp").alias("current_otp"),
        F.col("avg_cost").alias("current_cost"),
    )
    projected = carrier_bootstrap(
        star, carriers=carriers, reps=reps, draw=draw, min_n=min_n, ci=ci, seed=seed
    )
    return (
        candidates.select("lane_id", "carrier_id")
        .join(projected, "carrier_id")
        .join(primary, "lane_id")
        .select(
            "lane_id",
            "carrier_id",
            "current_carrier_id",
            *[
                settled(value).alias(name)
                for name, value in {
                    "otp_mean": F.col("otp_mean"),
                    "otp_low": F.col("otp_low"),
                    "otp_high": F.col("otp_high"),
                    "otp_delta_pp": F.col("otp_mean") - F.col("current_otp"),
                    "cost_mean": F.col("cost_mean"),
                    "cost_low": F.col("cost_low"),
                    "cost_high": F.col("cost_high"),
                    "cost_delta": F.col("cost_mean") - F.col("current_cost"),
                }.items()
            ],
        )
        .orderBy("lane_id", "carrier_id")
    )
