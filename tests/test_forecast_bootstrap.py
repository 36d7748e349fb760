from datetime import date, timedelta
from decimal import Decimal

import numpy as np
import pytest

from loadstar.operators import bootstrap, forecast
from tests.small import make_star, shipment

START = date(2024, 3, 4)


def series(spark, values, keys=("a",)):
    rows = [
        (k, START + timedelta(days=i), float(v)) for k in keys for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, "k string, day date, y double")


def run(df, keys=("k",), **changes):
    options = {"period": 4, "horizon": 6, "min_history": 10, **changes}
    return forecast.series_forecast(df, list(keys), "day", "y", **options).collect()


def test_exact_season_with_drift(spark):
    """A season that grows by 2 each time is continued without uncertainty."""
    values = [base + 2 * season for season in range(4) for base in (1, 5, 3, 9)]
    rows = run(series(spark, values))
    assert [r["step"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["forecast"] for r in rows] == [9, 13, 11, 17, 11, 15]
    assert all(r["lower"] == r["forecast"] == r["upper"] for r in rows)


def test_interval_brackets_and_widens(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(100, 10, 40)
    rows = run(series(spark, values), horizon=9)
    changes = values[4:] - values[:-4]
    half = 1.959963984540054 * np.std(changes, ddof=1)
    for r in rows:
        seasons = (r["step"] - 1) // 4 + 1
        middle = values[-4 + (r["step"] - 1) % 4] + seasons * changes.mean()
        assert r["forecast"] == pytest.approx(middle, abs=1e-5)
        assert r["upper"] - r["forecast"] == pytest.approx(half * seasons**0.5, abs=1e-5)
        assert r["lower"] < r["forecast"] < r["upper"]


def test_gaps_do_not_shift_the_season(spark):
    """A weekly pattern stays in place when days are missing; a missing day is zero."""
    pattern = [0, 100, 200, 300, 400, 500, 600]
    full = [(("a", START + timedelta(days=i), float(pattern[i % 7]))) for i in range(100)]
    schema = "k string, day date, y double"
    options = {"period": 7, "horizon": 7, "missing": 0.0}
    expected = [pattern[(100 + i) % 7] for i in range(7)]
    rows = run(spark.createDataFrame(full, schema), **options)
    assert [r["forecast"] for r in rows] == expected
    # zero days left out change nothing
    rows = run(spark.createDataFrame([r for r in full if r[2]], schema), **options)
    assert [r["forecast"] for r in rows] == expected


def test_gap_filling(spark):
    rows = [("a", START, 5.0), ("a", START + timedelta(days=14), 7.0), ("b", START, None), ("b", START + timedelta(days=7), 1.0)]
    df = spark.createDataFrame(rows, "k string, day date, y double")
    carried = forecast.without_gaps(df, ["k"], "day", "y", every=7).orderBy("k", "day").collect()
    assert [(r["k"], r["y"]) for r in carried] == [("a", 5.0), ("a", 5.0), ("a", 7.0), ("b", None), ("b", 1.0), ("b", 1.0)]
    zero = forecast.without_gaps(df, ["k"], "day", "y", every=7, missing=0.0).orderBy("k", "day").collect()
    assert [r["y"] for r in zero] == [5.0, 0.0, 7.0, 0.0, 1.0, 0.0]
    later = forecast.without_gaps(df, ["k"], "day", "y", every=7, until=START + timedelta(days=28))
    assert later.groupBy("k").count().orderBy("k").collect() == [("a", 5), ("b", 5)]
    assert forecast.without_gaps(df, ["k"], "day", "y", until=START - timedelta(days=1)).count() == 0
    whole = forecast.without_gaps(df.where("k = 'a'"), [], "day", "y", every=7, missing=0.0)
    assert whole.count() == 3


def test_a_series_that_stopped_is_forecast_from_the_common_last_day(spark):
    """b had 50 days of 100 and then 50 empty ones, so its next week is empty too."""
    rows = [("a", START + timedelta(days=i), 100.0) for i in range(100)]
    rows += [("b", START + timedelta(days=i), 100.0) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, day date, y double")
    found = {(r["k"], r["step"]): r["forecast"] for r in run(df, period=7, horizon=7, missing=0.0)}
    assert {found["a", k] for k in range(1, 8)} == {100.0}
    drift = -100 * 7 / (100 - 7)
    assert all(found["b", k] == pytest.approx(drift, abs=1e-5) for k in range(1, 8))


def test_forecasts_as_of_a_day(stored):
    """What ships later changes nothing, and the day after is step 1."""
    day = date(2024, 8, 18)
    cut, _ = stored.at(day)
    for query in (forecast.forecast_otp, forecast.forecast_cost):
        assert query(stored, as_of=day).collect() == query(cut, as_of=day).collect()
    assert forecast.forecast_cost(stored, as_of=day).count() == 28


def test_short_series_are_left_out(spark):
    late = series(spark, range(12)).where("y >= 3")  # nine steps, up to the same day
    df = late.unionByName(series(spark, range(12), ("b",)))
    assert {r["k"] for r in run(df)} == {"b"}


def test_horizon_below_period(spark):
    assert [r["step"] for r in run(series(spark, range(12)), horizon=2)] == [1, 2]


def test_reference_shapes(spark, stored):
    otp = forecast.forecast_otp(stored)
    assert otp.columns == ["week", "otp_forecast", "otp_lower", "otp_upper"]
    rows = otp.collect()
    assert [r["week"] for r in rows] == [1, 2, 3, 4]
    assert all(r["otp_lower"] <= r["otp_forecast"] <= r["otp_upper"] for r in rows)
    cost = forecast.forecast_cost(stored)
    assert cost.columns == ["day", "cost_forecast", "cost_lower", "cost_upper"]
    assert cost.count() == 28


@pytest.fixture(scope="module")
def star(spark):
    """Carrier 1 with repeated costs, carrier 2 with distinct ones, 3 with too few."""
    rows = []
    for i in range(60):
        cost = Decimal(1000 + 500 * (i % 3)).quantize(Decimal("0.01"))
        rows.append(shipment(f"a{i}", START, total_cost_usd=cost, on_time_pickup=i % 4 > 0))
    for i in range(40):
        cost = Decimal(700 + 7 * i).quantize(Decimal("0.01"))
        rows.append(
            shipment(f"b{i}", START, carrier_id=2, lane_id=2, total_cost_usd=cost)
        )
    rows += [shipment(f"c{i}", START, carrier_id=3) for i in range(29)]
    return make_star(spark, rows)


def mix(x):
    for _ in range(2):
        x = ((x ^ (x >> 16)) * 73244475) & 0xFFFFFFFF
    return x ^ (x >> 16)


def brute_force(outcomes, carrier, reps, draw, seed):
    outcomes = sorted(outcomes)
    n = len(outcomes)
    otps, costs = [], []
    for rep in range(reps):
        picked = []
        for pick in range(1, min(draw, n) + 1):
            state = mix((seed + carrier) & 0xFFFFFFFF)
            state = mix((state + rep) & 0xFFFFFFFF)
            state = mix((state + pick) & 0xFFFFFFFF)
            picked.append(outcomes[int(state / 2**32 * n)])
        otps.append(100 * np.mean([f for _, f in picked]))
        costs.append(np.mean([c for c, _ in picked]))
    return otps, costs


@pytest.mark.parametrize("reps, draw", [(50, 20), (2, 3)])
def test_bootstrap_equals_brute_force(star, reps, draw):
    """(2, 3) leaves fewer blocks than ranks, so blocks hold several outcomes."""
    found = {
        r["carrier_id"]: r
        for r in bootstrap.carrier_bootstrap(star, reps=reps, draw=draw, seed=7).collect()
    }
    assert set(found) == {1, 2}
    history = {}
    for r in star.fact.collect():
        history.setdefault(r["carrier_id"], []).append(
            (float(r["total_cost_usd"]), int(r["on_time_pickup"]))
        )
    for carrier, row in found.items():
        otps, costs = brute_force(history[carrier], carrier, reps, draw, 7)
        assert row["otp_mean"] == pytest.approx(np.mean(otps))
        assert row["cost_mean"] == pytest.approx(np.mean(costs))
        assert row["cost_low"] == pytest.approx(np.percentile(costs, 2.5))
        assert row["cost_high"] == pytest.approx(np.percentile(costs, 97.5))
        assert row["otp_low"] == pytest.approx(np.percentile(otps, 2.5))


def test_carriers_larger_than_a_chunk(star):
    """The cuts between chunks move no draw, wherever they fall in a run of equal outcomes."""
    options = {"reps": 20, "draw": 15, "seed": 3}
    whole = sorted(bootstrap.carrier_bootstrap(star, **options).collect())
    for chunk in (1, 7, 64):
        cut = sorted(bootstrap.carrier_bootstrap(star, chunk=chunk, **options).collect())
        assert [r["carrier_id"] for r in cut] == [r["carrier_id"] for r in whole]
        for one, other in zip(cut, whole, strict=True):
            assert list(one) == pytest.approx(list(other))


def test_draws_are_never_rows(star):
    """Each of the two carriers' chunks hands on one row per resample, not one per draw."""
    rows = bootstrap.carrier_bootstrap(star, reps=50, draw=40)
    assert rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and plan.count("Generate explode") <= 2 and "posexplode" not in plan
    chunks = bootstrap._chunks(bootstrap._history(star.fact), 2000)
    sums = chunks.mapInArrow(lambda b: bootstrap._resampled(b, 50, 40, 1), bootstrap._SUMS)
    assert sums.count() == sums.select("carrier_id").distinct().count() * 50


def test_interval_holds_the_true_mean(star):
    for row in bootstrap.carrier_bootstrap(star, reps=300).collect():
        truth = 1500 if row["carrier_id"] == 1 else 700 + 7 * 19.5
        assert row["cost_low"] < truth < row["cost_high"]
        assert row["cost_mean"] == pytest.approx(truth, rel=0.02)


def test_whatif_for_one_move(spark, star):
    move = spark.createDataFrame([(1, 2)], "lane_id bigint, carrier_id bigint")
    rows = bootstrap.whatif_bootstrap_ci(star, candidates=move, reps=20).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["lane_id"], row["carrier_id"], row["current_carrier_id"]) == (1, 2, 1)
    assert row["otp_mean"] == 100.0
    # lane 1 is carried by 1 (60 shipments) with 45 of 60 on time
    assert row["otp_delta_pp"] == pytest.approx(25.0)
    everything = bootstrap.whatif_bootstrap_ci(star, reps=20).collect()
    assert {(r["lane_id"], r["carrier_id"]) for r in everything} == {(1, 1), (2, 2)}


def test_fewer_shipments_than_draws(spark):
    rows = [shipment(i, START) for i in range(30)]
    row = bootstrap.carrier_bootstrap(make_star(spark, rows), reps=5, draw=100).first()
    assert row["cost_low"] == row["cost_mean"] == row["cost_high"] == 2000.0
