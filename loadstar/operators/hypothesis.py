"""Hypothesis tests as reusable operators, and their freight applications."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadstar.functions.measures import gather
from loadstar.functions.numeric import percent, ratio, rounded
from loadstar.operators.ordered import running_totals
from loadstar.schema import PEAK_MONTHS
from loadstar.star import Star

# Verdicts that appear in results.
PAIRED_REJECT = "REJECT H0: Significant OTP difference (p < 0.05)"
PAIRED_KEEP = "FAIL TO REJECT H0: No significant difference"
CHI_NAME = "Chi-square test: Defect vs Carrier Tier"
CHI_REJECT = "REJECT H0: Defect rate depends on carrier tier (p < 0.05)"
CHI_KEEP = "FAIL TO REJECT H0: Defect rate is independent of tier"
RANK_REJECT = "REJECT H0: Q4 cost-per-mile is significantly different (p < 0.05)"
RANK_KEEP = "FAIL TO REJECT H0: No significant difference"


def _verdict(rejected: Column, reject: str, keep: str) -> Column:
    return F.when(rejected, reject).otherwise(keep)


def paired_t_test(
    df: DataFrame,
    pair_key: str,
    group_col: str,
    a: str,
    b: str,
    value: str,
    *,
    weight: str | None = None,
    min_n: int = 30,
    critical: float = 1.96,
) -> DataFrame:
    """Paired t-test of the mean of ``value`` in group ``a`` against group ``b``.

    Pairs are the values of ``pair_key`` where both groups have at least
    ``min_n`` rows. With ``weight``, ``value`` is a sum over that many rows.
    One row: n, mean_diff, std_diff, t_statistic, critical_value, rejected.
    """
    rows = F.col(weight) if weight else F.lit(1)
    sides = df.where(F.col(group_col).isin(a, b)).groupBy(pair_key)
    in_a, in_b = F.col(group_col) == a, F.col(group_col) == b
    pairs = sides.agg(
        F.sum(F.when(in_a, rows)).alias("n_a"),
        F.sum(F.when(in_b, rows)).alias("n_b"),
        F.sum(F.when(in_a, F.col(value))).alias("sum_a"),
        F.sum(F.when(in_b, F.col(value))).alias("sum_b"),
    ).where((F.col("n_a") >= min_n) & (F.col("n_b") >= min_n))
    diff = ratio("sum_a", "n_a") - ratio("sum_b", "n_b")
    stats = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(diff).alias("mean_diff"),
        F.stddev_samp(diff).alias("std_diff"),
    )
    t = F.try_divide(
        F.col("mean_diff"), F.try_divide(F.col("std_diff"), F.sqrt(F.col("n")))
    )
    return stats.select(
        "n",
        "mean_diff",
        "std_diff",
        t.alias("t_statistic"),
        F.lit(float(critical)).alias("critical_value"),
        F.coalesce(F.abs(t) > critical, F.lit(False)).alias("rejected"),
    )


def chi_square_independence(
    df: DataFrame,
    row_col: str,
    flag_col: str,
    *,
    weight: str | None = None,
    critical: float = 7.815,
) -> DataFrame:
    """Chi-square test that a boolean flag is independent of a category.

    With ``weight``, each row stands for that many observations. One row:
    chi_square, degrees_of_freedom, critical_value, rejected.
    """
    rows = F.col(weight) if weight else F.lit(1)
    observed = df.groupBy(row_col).agg(
        F.sum(F.when(F.col(flag_col), rows).otherwise(0)).alias("yes"),
        F.sum(F.when(F.col(flag_col), 0).otherwise(rows)).alias("no"),
    )
    here = F.col("yes") + F.col("no")
    share_of_yes = observed.agg(ratio(F.sum("yes"), F.sum(here))).scalar()
    expected_yes = here * share_of_yes
    expected = observed.select(
        "yes",
        "no",
        expected_yes.alias("e_yes"),
        (here - expected_yes).alias("e_no"),
    )

    def term(seen: str, wanted: str) -> Column:
        gap = F.col(seen) - F.col(wanted)
        return F.try_divide(gap * gap, F.col(wanted))

    result = expected.agg(
        F.sum(term("yes", "e_yes") + term("no", "e_no")).alias("chi_square"),
        (F.count(F.lit(1)).cast("int") - 1).alias("degrees_of_freedom"),
    )
    return result.select(
        "chi_square",
        "degrees_of_freedom",
        F.lit(float(critical)).alias("critical_value"),
        F.coalesce(F.col("chi_square") > critical, F.lit(False)).alias("rejected"),
    )


def mann_whitney_u(
    df: DataFrame,
    group_col: str,
    a: str,
    b: str,
    value: str,
    *,
    weight: str | None = None,
    critical: float = 1.96,
    buckets: int | None = None,
) -> DataFrame:
    """Mann-Whitney U of ``value`` in group ``a`` against ``b``.

    Normal approximation, ties take the lowest rank, no tie correction. Ranks
    come from counts per distinct value, bucketed by value range, so no task
    ever holds the whole ranking. One row: n1, n2, mean1, mean2, u, z,
    critical_value, rejected.
    """
    rows = F.col(weight) if weight else F.lit(1)
    sides = df.where(F.col(group_col).isin(a, b)).select(
        F.col(value).alias("x"),
        rows.alias("rows"),
        F.when(F.col(group_col) == a, rows).otherwise(0).alias("in_a"),
    )
    ranked = running_totals(sides, [], "x", "rows", carry=["in_a"], buckets=buckets)
    in_a, here = F.col("in_a"), F.col("weight_here")
    # a rank sum outgrows 64 bits at a few billion rows
    rank_sum = F.sum(
        in_a.cast("decimal(19,0)") * (F.col("weight_before") + 1).cast("decimal(19,0)")
    )
    sums = ranked.agg(
        F.sum(in_a).alias("n1"),
        F.sum(here - in_a).alias("n2"),
        rank_sum.cast("double").alias("r1"),
        F.sum(in_a * F.col("x")).alias("s1"),
        F.sum((here - in_a) * F.col("x")).alias("s2"),
    )
    n1, n2 = F.col("n1").cast("double"), F.col("n2").cast("double")
    u = F.col("r1") - n1 * (n1 + 1) / 2
    z = F.try_divide(u - n1 * n2 / 2, F.sqrt(n1 * n2 * (n1 + n2 + 1) / 12))
    return sums.select(
        "n1",
        "n2",
        ratio("s1", "n1").alias("mean1"),
        ratio("s2", "n2").alias("mean2"),
        u.alias("u"),
        z.alias("z"),
        F.lit(float(critical)).alias("critical_value"),
        F.coalesce(F.abs(z) > critical, F.lit(False)).alias("rejected"),
    )


def strategic_vs_tactical_otp(
    star: Star, *, min_n: int = 30, critical: float = 1.96
) -> DataFrame:
    """Paired by lane: on-time pickup of Strategic against Tactical carriers."""
    pairs = gather(star.fact, ["lane_id", "carrier_id"], ["on_time", "n"]).join(
        star.carrier.select("carrier_id", "carrier_tier"), "carrier_id"
    )
    test = paired_t_test(
        pairs,
        "lane_id",
        "carrier_tier",
        "Strategic",
        "Tactical",
        "on_time",
        weight="n",
        min_n=min_n,
        critical=critical,
    )
    return test.select(
        F.col("n").alias("paired_lanes"),
        percent("mean_diff", 2).alias("mean_otp_diff_pp"),
        percent("std_diff", 2).alias("std_diff_pp"),
        rounded("t_statistic", 3).alias("t_statistic"),
        F.col("critical_value").alias("critical_value_alpha_05"),
        _verdict(F.col("rejected"), PAIRED_REJECT, PAIRED_KEEP).alias("conclusion"),
    )


def defects_vs_tier(star: Star, *, critical: float = 7.815) -> DataFrame:
    """Is the defect flag independent of the carrier tier?"""
    cells = gather(star.fact, ["carrier_id", "defect_flag"], ["n"]).join(
        star.carrier.select("carrier_id", "carrier_tier"), "carrier_id"
    )
    test = chi_square_independence(
        cells, "carrier_tier", "defect_flag", weight="n", critical=critical
    )
    return test.select(
        F.lit(CHI_NAME).alias("test_name"),
        rounded("chi_square", 3).alias("chi_square_statistic"),
        "degrees_of_freedom",
        F.col("critical_value").alias("critical_value_alpha_05"),
        _verdict(F.col("rejected"), CHI_REJECT, CHI_KEEP).alias("conclusion"),
    )


def peak_cost_lift(
    star: Star, *, critical: float = 1.96, buckets: int | None = None
) -> DataFrame:
    """Cost per mile in the peak quarter against the rest, by rank."""
    month = F.expr("shipment_date_key div 100 % 100")
    peak = month.isin(list(PEAK_MONTHS))
    dated = F.col("shipment_date_key").isNotNull()
    cost = (
        star.fact.where(dated & (F.col("distance_miles") > 0))
        .select(
            F.when(peak, "Q4").otherwise("Non-Q4").alias("period"),
            ratio("total_cost_usd", "distance_miles").alias("cpm"),
        )
    )
    test = mann_whitney_u(
        cost,
        "period",
        "Q4",
        "Non-Q4",
        "cpm",
        critical=critical,
        buckets=buckets,
    )
    return test.select(
        F.col("n1").alias("q4_sample_size"),
        F.col("n2").alias("nonq4_sample_size"),
        rounded("mean1", 2).alias("q4_avg_cpm"),
        rounded("mean2", 2).alias("nonq4_avg_cpm"),
        rounded("u").alias("u_statistic"),
        rounded("z", 3).alias("z_score"),
        F.col("critical_value").alias("critical_value_alpha_05"),
        _verdict(F.col("rejected"), RANK_REJECT, RANK_KEEP).alias("conclusion"),
    )
