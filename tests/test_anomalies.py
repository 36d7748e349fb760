import random
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loadstar.operators import anomalies
from tests.small import make_star, shipment

MONDAY = date(2024, 4, 1)


def week(lane, index, late, n=10, **changes):
    """``n`` shipments of one lane in one week, ``late`` of them late."""
    day = MONDAY + timedelta(weeks=index)
    return [
        shipment(f"{lane}-{index}-{i}", day, lane_id=lane, on_time_pickup=i >= late, **changes)
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def star(spark):
    rows = []
    for w in range(8):
        rows += week(1, w, 1 if w % 2 else 2)
        rows += week(2, w, 1)  # constant: no spread, never scored
    rows += week(1, 8, 8, carrier_id=4)
    rows += week(2, 8, 9)
    # lane 3: a thin week is dropped before the window, so week 9 is the first
    # with eight qualifying weeks behind it
    for w in range(9):
        rows += week(3, w, 1 if w % 2 else 2, n=4 if w == 4 else 10)
    rows += week(3, 9, 8)
    return make_star(spark, rows)


def test_zscore_flags(star):
    rows = {(r["lane_id"], r["week_start"]): r for r in anomalies.zscore_flags(star).collect()}
    assert set(rows) == {
        (1, MONDAY + timedelta(weeks=8)),
        (3, MONDAY + timedelta(weeks=9)),
    }
    flag = rows[1, MONDAY + timedelta(weeks=8)]
    assert flag["otp_observed"] == 0.2
    assert flag["otp_expected"] == 0.85
    # mean .85, sample deviation of four .8 and four .9
    assert flag["z_score"] == pytest.approx((0.2 - 0.85) / 0.05345224838, abs=1e-3)
    assert flag["severity"] == "HIGH"


def test_hints(star):
    found = anomalies.zscore_otp_anomalies(star)
    hints = {r["lane_id"]: r["reason_hint"] for r in found.collect()}
    assert hints == {1: anomalies.HINT_SPOT, 3: anomalies.HINT_COLLAPSE}


def test_all_hints_and_share_mode(spark):
    rows = []
    for w in range(8):
        rows += week(1, w, 1 if w % 2 else 2)
    costly = {"accessorial_cost_usd": Decimal("900.00"), "defect_flag": True}
    rows += week(1, 8, 8, n=9, **costly)
    rows += week(1, 8, 1, n=1, carrier_id=4)
    star = make_star(spark, rows)
    flags = anomalies.zscore_flags(star)

    def hint(mode):
        return anomalies.anomaly_reason_hints(flags, star, mode=mode).first()["reason_hint"]

    # tier means: accessorial share (.45 + .05) / 2 is below .30; defects all in one tier
    assert hint("reference") == f"{anomalies.HINT_SPOT}; {anomalies.HINT_DEFECT}"
    # one Spot shipment in ten is a share of .10
    assert hint("share") == anomalies.HINT_DEFECT
    eager = anomalies.anomaly_reason_hints(flags, star, acc=0.2, mode="share").first()
    assert eager["reason_hint"] == f"{anomalies.HINT_ACCESSORIAL}; {anomalies.HINT_DEFECT}"
    with pytest.raises(ValueError):
        anomalies.anomaly_reason_hints(flags, star, mode="other")


def test_improvement_hint(spark):
    rows = []
    for w in range(8):
        rows += week(1, w, 8 if w % 2 else 9)
    rows += week(1, 8, 0)
    found = anomalies.zscore_otp_anomalies(make_star(spark, rows)).first()
    assert found["z_score"] > 2.5
    assert found["reason_hint"] == anomalies.HINT_IMPROVED


def test_year_end_weeks(spark):
    """29 December 2025 and 1 January 2026 are one ISO week."""
    rows = [shipment(1, date(2025, 12, 29)), shipment(2, date(2026, 1, 1))]
    star = make_star(spark, rows)
    from loadstar.operators.views import weekly_kpis

    iso = weekly_kpis(star).collect()
    assert [(r["year"], r["week_of_year"], r["shipment_count"]) for r in iso] == [(2026, 1, 2)]
    split = weekly_kpis(star, week_key="calendar").collect()
    assert [(r["year"], r["week_of_year"]) for r in split] == [(2025, 1), (2026, 1)]
    with pytest.raises(ValueError):
        weekly_kpis(star, week_key="other")


def test_iqr_fence(spark):
    """Carrier-days at 2.00 per mile and one at 4.00: only the last is flagged."""
    rows = []
    for d in range(20):
        for i in range(3):
            cost = Decimal("4000.00") if d == 19 else Decimal(2000 + d).quantize(Decimal("0.01"))
            rows.append(shipment(f"{d}-{i}", MONDAY + timedelta(days=d), total_cost_usd=cost))
    rows += [shipment("thin", MONDAY, carrier_id=2, total_cost_usd=Decimal("9999.00"))]
    found = anomalies.iqr_cost_anomalies(make_star(spark, rows)).collect()
    assert [(r["carrier_id"], r["date"]) for r in found] == [(1, MONDAY + timedelta(days=19))]
    row = found[0]
    # 20 values 2.000 .. 2.018 and 4: q1 2.00475, q3 2.01425, fence 2.0285
    assert row["upper_fence"] == 2.03
    assert row["excess_pct"] == pytest.approx((4 - 2.0285) / 2.0285 * 100, abs=0.06)
    assert row["volume"] == 3


def test_filters_and_counts(star):
    flags = anomalies.zscore_otp_anomalies(star)
    last = anomalies.anomalies_filtered(flags, limit=1).first()
    assert last["lane_id"] == 3
    assert anomalies.anomalies_filtered(flags, severity="LOW").count() == 0
    outliers = anomalies.iqr_cost_anomalies(star)
    as_of = MONDAY + timedelta(weeks=9, days=3)
    counts = {r[0]: r[1] for r in anomalies.anomaly_count(flags, outliers, as_of=as_of).collect()}
    assert counts == {"zscore": 2, "iqr": 0}
    late = anomalies.anomaly_count(flags, outliers, as_of=as_of + timedelta(days=8)).collect()
    assert {r[0]: r[1] for r in late} == {"zscore": 1, "iqr": 0}


def test_briefing_takes_last_day_by_default(star):
    rows = anomalies.briefing_rows(star).orderBy("section", F.desc("day")).collect()
    assert [r["section"] for r in rows] == ["headline", "headline", "zscore", "zscore"]
    assert {r["day"] for r in rows if r["section"] == "headline"} == {MONDAY + timedelta(weeks=9)}


def test_anomaly_window_otp(star):
    row = anomalies.anomaly_window_otp(star, first=MONDAY + timedelta(weeks=8)).first()
    assert row["otp"] == 0.2
    none = anomalies.anomaly_window_otp(star, before=MONDAY).first()
    assert none["otp"] is None


def test_carried_state_flags_like_the_full_run(spark):
    """Week after week from the state alone, with lanes that skip weeks or have too few shipments."""
    rng = random.Random(7)
    rows = []
    for lane in (1, 2, 3):
        for index in range(40):
            if lane == 3 and index % 3 == 0:
                continue
            late = 9 if rng.random() < 0.08 else rng.randint(0, 2)
            rows += week(lane, index, late, n=4 if lane == 2 and index % 5 == 0 else 10)
    star = make_star(spark, rows)
    full = anomalies.zscore_flags(star)
    weeks = anomalies.qualifying_weeks(star).cache()
    cut = [r.week_start for r in weeks.select("week_start").distinct().orderBy("week_start").collect()]
    later = cut[20]
    state = anomalies.last_weeks(weeks.where(F.col("week_start") < later))
    found = []
    for start, end in zip(cut[20::5], [*cut[25::5], cut[-1] + timedelta(days=7)], strict=False):
        new = weeks.where(F.col("week_start").between(start, end - timedelta(days=1)))
        flags, state = anomalies.zscore_next(state, new)
        found += flags.collect()
        state = spark.createDataFrame(state.collect(), state.schema)
        assert state.groupBy("lane_id").count().where("count > 8").isEmpty()
    wanted = full.where(F.col("week_start") >= later).collect()
    assert sorted(found) == sorted(wanted) and wanted
