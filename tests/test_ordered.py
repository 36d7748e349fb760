import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from loadstar.operators.ordered import (
    cumulative_top,
    global_rank,
    percentiles,
    running_totals,
)


def skewed(spark, seed):
    """A third of the rows under one key, many ties, some NULL values."""
    rng = random.Random(seed)
    rows = []
    for i in range(3000):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(20)}"
        value = None if rng.random() < 0.05 else float(rng.choice([1, 2, 3, 500]))
        if value is not None and rng.random() < 0.5:
            value = round(rng.lognormvariate(3, 1), 2)
        rows.append((key, value))
    rows += [("only_null", None), ("single", 7.0)]
    return spark.createDataFrame(rows, "k string, v double").withColumn("n", F.lit(1))


@pytest.mark.parametrize("buckets", [2, 5, 64])
def test_percentiles_equal_numpy(spark, buckets):
    df = skewed(spark, 1)
    wanted = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    found = percentiles(df, ["k"], "v", "n", wanted, buckets=buckets).collect()
    groups = {}
    for row in df.collect():
        groups.setdefault(row["k"], []).append(row["v"])
    assert {r["k"] for r in found} == set(groups)
    for row in found:
        values = [v for v in groups[row["k"]] if v is not None]
        assert row["row_count"] == len(groups[row["k"]])
        for name, p in wanted.items():
            if values:
                assert row[name] == pytest.approx(np.percentile(values, p * 100))
            else:
                assert row[name] is None


def test_percentiles_take_weights(spark):
    df = spark.createDataFrame(
        [("a", 1.0, 3), ("a", 10.0, 1), ("a", None, 5)], "k string, v double, n int"
    )
    row = percentiles(df, ["k"], "v", "n", {"p50": 0.5, "p90": 0.9}).first()
    assert row["row_count"] == 9
    assert row["p50"] == 1.0
    assert row["p90"] == pytest.approx(np.percentile([1, 1, 1, 10], 90))


def test_percentiles_without_keys(spark):
    df = skewed(spark, 2)
    values = [r["v"] for r in df.collect() if r["v"] is not None]
    row = percentiles(df, [], "v", "n", {"p90": 0.9}).first()
    assert row["p90"] == pytest.approx(np.percentile(values, 90))


@pytest.mark.parametrize("buckets", [2, 7, 64])
@pytest.mark.parametrize("descending", [False, True])
def test_global_rank_equals_window_rank(spark, buckets, descending):
    df = skewed(spark, 3).where("v is not null").drop("n")
    order = F.desc("v") if descending else F.asc("v")
    plain = df.withColumn("r", F.rank().over(Window.orderBy(order)).cast("bigint"))
    found = global_rank(df, "v", descending=descending, name="r", buckets=buckets)
    assert sorted(found.select("k", "v", "r").collect()) == sorted(plain.collect())


def test_rank_within_keys(spark):
    df = skewed(spark, 4).where("v is not null").drop("n")
    plain = df.withColumn(
        "r", F.rank().over(Window.partitionBy("k").orderBy("v")).cast("bigint")
    )
    found = global_rank(df, "v", keys=["k"], name="r", buckets=8)
    assert sorted(found.select("k", "v", "r").collect()) == sorted(plain.collect())


def test_running_totals_carry(spark):
    df = spark.createDataFrame(
        [(1.0, 2, 1), (1.0, 1, 0), (3.0, 4, 4), (None, 9, 9)], "v double, n int, c int"
    )
    rows = {r["v"]: r for r in running_totals(df, [], "v", "n", carry=["c"]).collect()}
    assert set(rows) == {1.0, 3.0}
    assert (rows[1.0]["weight_before"], rows[1.0]["weight_here"], rows[1.0]["c"]) == (0, 3, 1)
    assert (rows[3.0]["weight_before"], rows[3.0]["weight_total"], rows[3.0]["c"]) == (3, 7, 4)


def test_cumulative_top_keeps_ties_behind_the_limit(spark):
    df = spark.createDataFrame(
        [("a", 5), ("b", 3), ("c", 3), ("d", 3), ("e", 1)], "name string, n bigint"
    )
    rows = cumulative_top(df, "n", 2, ["name"]).orderBy("position").collect()
    assert [r["name"] for r in rows] == ["a", "b"]
    # b ties with c and d, so its running sum holds all three
    assert [r["running"] for r in rows] == [5, 14]
    assert {r["overall"] for r in rows} == {15}


def test_global_rank_with_null_keys(spark):
    """NULL keys form a group of their own; only NULL values have no rank."""
    rows = [("a", "x", 1), ("a", "x", 2), ("a", None, 5), ("a", None, 5), ("a", None, 9), (None, None, None)]
    df = spark.createDataFrame(rows, "k1 string, k2 string, v int")
    found = global_rank(df, "v", keys=["k1", "k2"], buckets=3)
    assert found.columns == ["k1", "k2", "v", "rank"]
    ranks = sorted(((r.k2 or "", r.v, r["rank"]) for r in found.collect()), key=str)
    assert ranks == sorted([("x", 1, 1), ("x", 2, 2), ("", 5, 1), ("", 5, 1), ("", 9, 3), ("", None, None)], key=str)
