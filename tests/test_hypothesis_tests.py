import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from loadstar.operators.hypothesis import (
    chi_square_independence,
    mann_whitney_u,
    paired_t_test,
)


def test_chi_square_textbook(spark):
    """Observed (20, 30), (30, 20): expected 25 everywhere, statistic 4."""
    df = spark.createDataFrame(
        [("x", True, 20), ("x", False, 30), ("y", True, 30), ("y", False, 20)],
        "row string, flag boolean, n int",
    )
    found = chi_square_independence(df, "row", "flag", weight="n", critical=3.841).first()
    assert found["chi_square"] == pytest.approx(4.0)
    assert found["degrees_of_freedom"] == 1
    assert found["rejected"] is True
    one_by_one = df.select("row", "flag", F.explode(F.sequence(F.lit(1), "n")))
    again = chi_square_independence(one_by_one, "row", "flag", critical=3.841).first()
    assert again == found


def test_chi_square_without_any_flag(spark):
    df = spark.createDataFrame([("x", False), ("y", False)], "row string, flag boolean")
    found = chi_square_independence(df, "row", "flag").first()
    assert found["rejected"] is False


def test_paired_t_five_pairs(spark):
    a, b = [0.9, 0.8, 0.95, 0.7, 0.85], [0.8, 0.75, 0.9, 0.75, 0.7]
    rows = [(i, g, v) for i, pair in enumerate(zip(a, b)) for g, v in zip("ab", pair)]
    rows += [(99, "a", 0.1)]  # no partner
    df = spark.createDataFrame(rows, "pair int, g string, v double")
    found = paired_t_test(df, "pair", "g", "a", "b", "v", min_n=1).first()
    diffs = [x - y for x, y in zip(a, b)]
    t = statistics.mean(diffs) / (statistics.stdev(diffs) / math.sqrt(5))
    assert found["n"] == 5
    assert found["t_statistic"] == pytest.approx(t)


def test_paired_t_needs_enough_rows(spark):
    df = spark.createDataFrame(
        [(1, "a", 10, 30), (1, "b", 8, 29), (2, "a", 10, 30), (2, "b", 8, 30)],
        "pair int, g string, hits int, n int",
    )
    found = paired_t_test(df, "pair", "g", "a", "b", "hits", weight="n").first()
    assert found["n"] == 1
    assert found["t_statistic"] is None
    assert found["rejected"] is False


@pytest.mark.parametrize("buckets", [2, 64])
def test_mann_whitney_with_heavy_ties(spark, buckets):
    rng = random.Random(5)
    rows = [(rng.choice("ab"), float(rng.randrange(6))) for _ in range(400)]
    rows += [("other", 3.0)] * 5
    df = spark.createDataFrame(rows, "g string, v double")
    found = mann_whitney_u(df, "g", "a", "b", "v", buckets=buckets).first()
    kept = [r for r in rows if r[0] != "other"]
    low_rank = {v: 1 + sum(x < v for _, x in kept) for v in {x for _, x in kept}}
    n1, n2 = (sum(g == side for g, _ in kept) for side in "ab")
    u1 = sum(low_rank[v] for g, v in kept if g == "a") - n1 * (n1 + 1) / 2
    assert (found["n1"], found["n2"], found["u"]) == (n1, n2, u1)
    sigma = math.sqrt(n1 * n2 * (n1 + n2 + 1) / 12)
    assert found["z"] == pytest.approx((u1 - n1 * n2 / 2) / sigma)


def test_u_statistics_add_up_without_ties(spark):
    rows = [("a" if i % 3 else "b", float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "g string, v double")
    one = mann_whitney_u(df, "g", "a", "b", "v").first()
    two = mann_whitney_u(df, "g", "b", "a", "v").first()
    assert one["u"] + two["u"] == one["n1"] * one["n2"]
