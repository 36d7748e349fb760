"""The growing warehouse: late days, reruns, failures halfway, stored KPI parts."""

import random
import shutil
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loadstar.operators import carriers, lanes, network, views
from loadstar.sources import increments
from loadstar.sources.increments import GRAINS, Warehouse
from tests.small import make_star, shipment

START = date(2024, 1, 20)


def shipments(days, per_day=6, seed=1):
    rng = random.Random(seed)
    rows = []
    for d in days:
        day = START + timedelta(days=d)
        for k in range(per_day):
            linehaul = Decimal(rng.randint(100, 900))
            rows.append(
                shipment(
                    f"{d}-{k}",
                    day,
                    carrier_id=rng.choice([1, 2, 3]),
                    lane_id=rng.choice([1, 2]),
                    shipper_id=rng.choice([1, 2, 3]),
                    on_time_pickup=rng.random() < 0.8,
                    dwell_minutes=rng.choice([-3.0, 10.0, 20.0, 45.5]),
                    linehaul_cost_usd=linehaul,
                    fuel_surcharge_usd=Decimal(10),
                    accessorial_cost_usd=Decimal(5),
                    total_cost_usd=linehaul + 15,
                )
            )
    return rows


def rows_of(df):
    return sorted(map(str, df.collect()))


def same_fact(found, wanted):
    assert rows_of(found.fact.select(*wanted.fact.columns)) == rows_of(wanted.fact)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """January to March, then a late day in February; only read from."""
    whole = make_star(spark, shipments(range(50)))
    late = 20240215
    house = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse") / "house"))
    house.load(whole.fact.where(F.col("shipment_date_key") != late), whole)
    first = house.manifest().collect()
    house.load(whole.fact.where(F.col("shipment_date_key") == late))
    return house, whole, first


@pytest.fixture
def grown(built, tmp_path):
    """A copy of it that a test may load more into."""
    house, whole, first = built
    shutil.copytree(house.path, tmp_path / "house")
    return Warehouse(house.spark, str(tmp_path / "house")), whole, first


def test_a_late_day_replaces_its_month_only(built):
    house, whole, first = built
    same_fact(house.star(), whole)
    before = {(r.table_name, r.ship_month): r.version for r in first}
    after = {(r.table_name, r.ship_month): r.version for r in house.manifest().collect()}
    assert before.keys() == after.keys()
    changed = {month for key, month in before if before[key, month] != after[key, month]}
    assert changed == {202402}
    # the snapshot before is still there
    assert house.star(1).fact.count() == whole.fact.count() - 6


def test_a_rerun_changes_nothing(grown):
    house, whole, _ = grown
    day = whole.fact.where("shipment_date_key = 20240215")
    assert house.snapshot() == 2
    assert house.load(day.repartition(3)) == 2
    assert house.load(whole.fact.limit(0)) == 2
    same_fact(house.star(), whole)


def test_a_changed_day_replaces_the_old_rows(spark, grown):
    house, whole, _ = grown
    new = make_star(spark, shipments([26], per_day=2, seed=9)).fact  # 15 February
    assert house.load(new) == 3
    kept = whole.fact.where("shipment_date_key <> 20240215").unionByName(new)
    assert rows_of(house.star().fact.select(*kept.columns)) == rows_of(kept)


@pytest.mark.parametrize("broken", ["parts_lane_id", "manifest"])
def test_a_failure_halfway_leaves_the_old_state(spark, grown, monkeypatch, broken):
    """The load dies after the fact was written, or just before the commit."""
    house, whole, _ = grown
    new = make_star(spark, shipments([26, 27], seed=5)).fact
    with monkeypatch.context() as m:
        if broken == "manifest":
            m.setattr(increments, "_MANIFEST", "no layout at all")
        else:
            m.setattr(increments, "gather", lambda *_: 1 / 0)
        with pytest.raises(Exception):  # noqa: B017
            house.load(new)
    assert house.snapshot() == 2
    same_fact(house.star(), whole)
    assert house.load(new) == 3  # and the next attempt goes through


def test_kpi_tables_from_parts_equal_those_of_the_fact(built):
    house, whole, _ = built
    star = house.star()
    for table in (
        views.weekly_kpis,
        views.carrier_scorecard,
        views.lane_performance,
        views.shipper_cost_to_serve,
    ):
        found = table(star)
        assert rows_of(found) == rows_of(table(whole))
        files = [f for f in found.inputFiles() if "/fact_shipment/" in f]
        assert not files and any("/parts_" in f for f in found.inputFiles())
    # an earlier day is not what the parts were gathered for
    bounded, _ = star.at(date(2024, 2, 1))
    assert not bounded.parts
    assert rows_of(views.lane_performance(bounded)) == rows_of(views.lane_performance(whole.at(date(2024, 2, 1))[0]))


def test_a_refresh_reads_and_gathers_one_month(grown, monkeypatch):
    house, _, _ = grown
    read = []
    real = Warehouse._read

    def spy(self, name, layout, versions):
        found = real(self, name, layout, versions)
        read.append((name, {v.ship_month for v in versions}, found))
        return found

    monkeypatch.setattr(Warehouse, "_read", spy)
    new = make_star(house.spark, shipments([27], seed=8)).fact
    plans = []
    plain = increments.gather
    monkeypatch.setattr(increments, "gather", lambda fact, keys, parts: plans.append((fact, keys)) or plain(fact, keys, parts))
    house.load(new)
    gathered = [fact for fact, keys in plans if "ship_month" in keys]
    assert len(gathered) == len(GRAINS)
    assert all("ship_month=202402" in f for fact in gathered for f in fact.inputFiles())


def test_checks_are_observed_while_writing(spark, tmp_path):
    rows = shipments(range(3)) + [
        shipment("odd", START, total_cost_usd=Decimal("1.00"), pickup_actual_ts=None, dwell_minutes=-9.0)
    ]
    star = make_star(spark, rows)
    house = Warehouse(spark, str(tmp_path / "house"))
    house.load(star.fact, star)
    found = {r.check_name: (r.value, r.passed) for r in house.checks().collect()}
    negative = sum(r["dwell_minutes"] < 0 for r in rows)
    assert found["row_count"] == (len(rows), True)
    assert found["cost_identity"] == (1, False)
    assert found["null_pickup"] == (1, True)
    assert found["negative_dwell"] == (negative, True)
    assert found["not_null_carrier_id"] == (0, True)


def test_the_first_load_needs_dimensions_and_days(spark, tmp_path):
    star = make_star(spark, shipments([0]))
    house = Warehouse(spark, str(tmp_path / "house"))
    with pytest.raises(ValueError, match="dimensions"):
        house.load(star.fact)
    with pytest.raises(ValueError, match="nothing has been loaded"):
        house.star()
    with pytest.raises(ValueError, match="no ship day"):
        house.load(star.fact.withColumn("shipment_date_key", F.lit(None).cast("int")), star)


def test_sketches_keep_their_rank_error_under_skew(spark):
    """One carrier has nearly all shipments, and a third of them one dwell value."""
    base = make_star(spark, [shipment(1, START)])
    dwell = F.when(F.col("id") % 3 == 0, 60.0).otherwise(F.exp(F.randn(3) * 2))
    rows = spark.range(200_000).select(
        F.when(F.col("id") < 100, 2).otherwise(1).alias("carrier_id"), dwell.alias("dwell_minutes")
    )
    plain = base.fact.drop("carrier_id", "dwell_minutes").crossJoin(F.broadcast(rows))
    star = type(base)(**{**base.__dict__, "fact": plain.select(*base.fact.columns)})
    errors = carriers.dwell_rank_errors(star, bound=0.004).collect()
    assert {r.carrier_id for r in errors} == {1, 2}
    assert all(r.within_bound for r in errors)


@pytest.mark.parametrize(
    "query", [carriers.dwell_percentiles_by_carrier, views.carrier_scorecard, network.utilization_by_service, lanes.dwell_outliers_by_lane]
)
def test_the_approximate_switch(built, query):
    """Same rows and columns; with few values a percentile is one of them."""
    house, whole, _ = built
    options = {"p99_min": 1} if query is lanes.dwell_outliers_by_lane else {}
    exact = query(whole, **options)
    for star in (whole, house.star()):
        found = query(star, approx=True, **options)
        assert found.columns == exact.columns and found.count() == exact.count() > 0
        for a, b in zip(sorted(found.collect(), key=str), sorted(exact.collect(), key=str), strict=True):
            for c in found.columns:
                if "p50" in c or "p90" in c or "p99" in c:
                    assert a[c] in {10.0, 20.0, 45.5, 80.0, None} and abs(a[c] - b[c]) < 36


def test_sketches_of_carriers_without_positive_dwell(spark):
    star = make_star(spark, [shipment(i, START, dwell_minutes=-1.0) for i in range(5)])
    row = carriers.dwell_percentiles_by_carrier(star, approx=True).first()
    assert (row.shipment_count, row.dwell_p50) == (5, None)


def test_distinct_counts_roll_up(built):
    house, whole, _ = built
    for level in ("day", "week", "month", "year", "network"):
        found = rows_of(views.active_parties(house.star(), level=level))
        assert found == rows_of(views.active_parties(whole, level=level))
    months = views.active_parties(whole, level="month").collect()
    assert [r.active_carriers for r in months] == [3, 3, 3]
    exact = whole.fact.agg(F.count_distinct("carrier_id", "lane_id"), F.count_distinct("shipper_id")).first()
    assert views.active_parties(whole, level="network").first().active_shippers == exact[1]
