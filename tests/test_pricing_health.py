from datetime import date, timedelta
from decimal import Decimal

import pytest

from loadstar.operators import pricing, shippers
from tests.small import make_star, shipment

AS_OF = date(2024, 12, 31)
RECENT, EARLIER = AS_OF - timedelta(days=10), AS_OF - timedelta(days=120)


def volume(shipper, recent, earlier, **changes):
    days = [RECENT] * recent + [EARLIER] * earlier
    return [
        shipment(f"{shipper}-{i}", day, shipper_id=shipper, **changes)
        for i, day in enumerate(days)
    ]


@pytest.fixture(scope="module")
def advice(spark):
    # revenue per shipment: 2.43 x 1.08 x 1000 miles = 2624.40
    rows = volume(1, 10, 10, total_cost_usd=Decimal("3149.28"), on_time_delivery=False)
    rows += volume(2, 6, 10, defect_flag=True)
    rows += volume(3, 12, 10)
    rows += volume(4, 10, 10)
    star = make_star(spark, rows)
    found = pricing.pricing_recommendations(star, as_of=AS_OF).collect()
    return {r["shipper_id"]: r for r in found}


def test_unprofitable_goes_up(advice):
    row = advice[1]
    assert (row["recommendation"], row["pct_change"]) == (pricing.RENEGOTIATE, 10.0)
    assert row["driver_1"] == "Unprofitable: cost exceeds revenue by 20%"
    assert row["driver_2"] == "Below-target OTD: 0.0%"
    assert row["is_profitable"] is False


def test_declining_gets_discount(advice):
    row = advice[2]
    assert (row["recommendation"], row["pct_change"]) == (pricing.DISCOUNT, -4.0)
    assert row["driver_1"] == "Volume declining -40% (90d vs prior 90d)"
    assert row["driver_2"] == "Elevated defect rate: 100.0%"


def test_growing_with_good_service_gets_discount(advice):
    row = advice[3]
    assert (row["recommendation"], row["pct_change"]) == (pricing.DISCOUNT, -4.0)
    assert row["driver_1"] == "Strong growth (+20%) with high OTD (100%)"
    assert row["driver_2"] == ""


def test_normal_is_held(advice):
    row = advice[4]
    assert (row["recommendation"], row["pct_change"]) == (pricing.HOLD, 0.0)
    assert row["driver_1"] == pricing.NO_DRIVER


def test_top_limits_by_volume(spark):
    rows = volume(1, 5, 0) + volume(2, 9, 0) + volume(3, 7, 0)
    found = pricing.pricing_recommendations(make_star(spark, rows), as_of=AS_OF, top=2)
    assert [r["shipper_id"] for r in found.collect()] == [2, 3]


def test_health_components(spark):
    rows = volume(1, 6, 4) + volume(2, 1, 0, total_cost_usd=Decimal("4000.00"))
    for i in range(5):
        rows[i]["on_time_pickup"] = False
    found = {
        r["shipper_id"]: r
        for r in shippers.shipper_health(make_star(spark, rows), as_of=AS_OF).collect()
    }
    one, two = found[1], found[2]
    assert one["growth_rate"] == 0.5
    assert one["service_score"] == 100.0
    assert one["growth_score"] == 100.0
    # half late: sample deviation of ten 0/1 values is .527, so the floor applies
    assert one["reliability_score"] == 0.0
    assert one["tenure_score"] == pytest.approx(23 / 24 * 100)
    tier = (10 * 2000 + 4000) / 11
    assert one["cost_score"] == 100.0
    assert two["cost_score"] == pytest.approx((1 - (4000 - tier) / tier) * 100)
    # a single shipment has no deviation, no earlier volume
    assert two["reliability_score"] == 0.0
    assert (two["vol_prior_90d"], two["growth_rate"], two["growth_score"]) == (0, 0.0, 50.0)
    expected = 0.30 * 100 + 0.25 * 100 + 0.20 * 100 + 0.15 * 0 + 0.10 * one["tenure_score"]
    assert one["shipper_health_score"] == pytest.approx(expected)


def test_health_weights_are_parameters(spark):
    only = {"service": 1.0, "cost": 0, "growth": 0, "reliability": 0, "tenure": 0}
    star = make_star(spark, volume(1, 2, 2))
    row = shippers.shipper_health(star, as_of=AS_OF, weights=only).first()
    assert row["shipper_health_score"] == row["service_score"]


def test_month_boundaries(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(date(2024, 1, 31),)], "d date")
    months = shippers.months_between_starts(F.col("d"), date(2024, 2, 1))
    assert df.select(months).first()[0] == 1


def test_shipper_tier_by_volume(spark):
    rows = volume(1, 3, 0) + volume(2, 2, 0) + volume(3, 1, 0)
    star = make_star(spark, rows)
    found = shippers.classify_shipper_tier(star, top=1, mid=1).collect()
    assert {r["shipper_id"]: r["volume_tier"] for r in found} == {
        1: "Top20",
        2: "Mid",
        3: "LongTail",
    }
