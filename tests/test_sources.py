from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from loadstar import schema
from loadstar.functions import calendar
from loadstar.operators import quality, views
from loadstar.sources import session, warehouse
from tests.small import make_star, shipment

DAYS = [date(2024, 1, 5), date(2024, 2, 6), date(2024, 2, 7)]


@pytest.fixture()
def star(spark):
    rows = [shipment(i, day) for i, day in enumerate(DAYS)]
    rows[0]["pickup_actual_ts"] = None
    return make_star(spark, rows, first=date(2024, 1, 1), last=date(2024, 12, 31))


def write_csv_star(star, path):
    for name, table in star.tables().items():
        table.write.option("header", True).csv(f"{path}/{name}.csv")


def test_csv_star_keeps_types(spark, star, tmp_path):
    write_csv_star(star, str(tmp_path))
    back = warehouse.read_csv_star(spark, str(tmp_path), validate=True)
    for name, table in back.tables().items():
        assert [(f.name, f.dataType) for f in table.schema] == [
            (f.name, f.dataType) for f in schema.TABLES[name]
        ]
    assert back.lane.first()["origin_zip3"] == "071"
    assert back.fact.first()["total_cost_usd"] == Decimal("2000.00")
    assert sorted(back.fact.collect()) == sorted(star.fact.collect())


def test_malformed_csv_fails(spark, star, tmp_path):
    write_csv_star(star, str(tmp_path))
    good = next((tmp_path / "dim_service_type.csv").glob("part-*.csv"))
    good.with_name("part-99999-bad.csv").write_text(
        good.read_text().splitlines()[0] + "\nnot-a-number,X,1,0.5,0.1\n"
    )
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        warehouse.read_csv_star(spark, str(tmp_path)).service.collect()


def test_parquet_star_is_partitioned_by_month(spark, star, tmp_path):
    path = str(tmp_path / "star")
    warehouse.write_star(star, path)
    assert {p.name for p in (tmp_path / "star" / "fact_shipment").glob("ship_month=*")} == {
        "ship_month=202401",
        "ship_month=202402",
    }
    back = warehouse.read_star(spark, path, validate=True)
    assert sorted(back.fact.drop("ship_month").collect()) == sorted(star.fact.collect())
    recent = back.between(first=date(2024, 2, 6))
    assert recent.count() == 2
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ship_month" in plan
    assert "GreaterThanOrEqual(shipment_date_key,20240206)" in plan


def test_validation_refuses_bad_stars(spark, star, tmp_path):
    broken = make_star(
        spark,
        [
            shipment(1, DAYS[0], carrier_id=99),
            shipment(1, DAYS[0], total_cost_usd=Decimal("1.00")),
        ],
    )
    path = str(tmp_path / "star")
    warehouse.write_star(broken, path)
    with pytest.raises(ValueError) as error:
        warehouse.read_star(spark, path, validate=True)
    for check in ("orphan_carrier_id", "cost_identity", "duplicate_fact_shipment"):
        assert check in str(error.value)


def test_views_and_row_counts(spark, star):
    warehouse.register_views(star)
    assert spark.sql("SELECT COUNT(*) FROM fact_shipment").first()[0] == 3
    assert spark.sql("SELECT shipment_count FROM v_lane_performance").first()[0] == 3
    counts = {r[0]: r[1] for r in warehouse.row_counts(star).collect()}
    assert counts["fact_shipment"] == 3
    assert counts["dim_date"] == 366


def test_kpi_export(spark, star, tmp_path):
    paths = views.export_kpi_tables(star, str(tmp_path / "out"), as_of=date(2024, 12, 31))
    assert len(paths) == 4
    weekly = spark.read.option("header", True).csv(paths[0])
    assert weekly.columns == views.weekly_kpis(star).columns
    assert weekly.count() == 2


def test_default_as_of_is_last_ship_day(star):
    assert star.resolve_as_of(None) == DAYS[-1]
    with pytest.raises(ValueError):
        type(star)(**{**star.__dict__, "fact": star.fact.limit(0)}).resolve_as_of(None)


def test_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "named_folder", lambda _: "/shared")
    assert session.shared_folder(spark) == "/shared"
    assert session.new_folder(spark, "x") != session.new_folder(spark, "x")
    monkeypatch.setattr(session, "named_folder", lambda _: None)
    assert "loadstar-" in session.shared_folder(spark)


def test_session_star_is_stored_where_a_folder_is_named(
    spark, sf_dir, tmp_path, monkeypatch
):
    monkeypatch.setattr(session, "named_folder", lambda _: None)
    lazy = session.session_star(spark, sf_dir + "/")
    assert "ship_month" not in lazy.fact.columns
    monkeypatch.setattr(session, "named_folder", lambda _: str(tmp_path))
    stored = session.session_star(spark, sf_dir + "/.")
    assert session.session_star(spark, sf_dir + "/.") is stored
    assert "ship_month" in stored.fact.columns
    assert stored.fact.count() == lazy.fact.count()
    assert len(list(tmp_path.glob("star-*"))) == 1


def test_quality_rows(star):
    rows = {r["check_name"]: r for r in quality.all_checks(star, min_rows=3, min_lanes=4).collect()}
    assert rows["row_count"]["passed"] and rows["row_count"]["value"] == 3
    assert not rows["distinct_lanes"]["passed"]
    assert rows["null_pickup"]["value"] == 1
    assert rows["top20_concentration"]["value"] == 1.0
    assert all(rows[f"orphan_{c}"]["passed"] for c in schema.FOREIGN_KEYS)


def test_null_keys_count_as_orphans(star):
    nulled = star.fact.withColumn("lane_id", F.lit(None).cast("bigint"))
    broken = type(star)(**{**star.__dict__, "fact": nulled})
    rows = {r["check_name"]: r["value"] for r in quality.fk_orphans(broken).collect()}
    assert rows["orphan_lane_id"] == 3
    assert rows["orphan_carrier_id"] == 0


def test_domain_and_not_null(spark, star):
    assert all(r["passed"] for r in quality.domains(star).collect())
    few = make_star(spark, [shipment(1, DAYS[0])], carriers=((1, "Core"),))
    rows = {r["check_name"]: r for r in quality.domains(few).collect()}
    assert not rows["carrier_tiers"]["passed"]
    nulls = quality.not_null(star)
    assert nulls.count() == sum(
        not f.nullable for layout in schema.TABLES.values() for f in layout
    )
    assert all(r["passed"] for r in nulls.collect())


def test_null_audit_any_columns(star):
    rows = quality.null_audit(star.fact, ["pickup_actual_ts", "weight_lbs"]).collect()
    assert {r["column_name"]: (r["null_count"], r["null_pct"]) for r in rows} == {
        "pickup_actual_ts": (1, 33.333),
        "weight_lbs": (0, 0.0),
    }


def test_calendar(spark):
    days = calendar.dim_date(
        spark, date(2025, 12, 28), date(2026, 1, 1), holidays=[date(2026, 1, 1)]
    )
    rows = {r["date"]: r for r in days.collect()}
    assert [f.name for f in days.schema] == schema.DATE.fieldNames()
    assert len(rows) == 5
    new_year = rows[date(2026, 1, 1)]
    assert (new_year["date_key"], new_year["week_of_year"], new_year["day_of_week"]) == (20260101, 1, 3)
    assert new_year["is_holiday"] and not new_year["is_weekend"] and not new_year["is_peak_season"]
    sunday = rows[date(2025, 12, 28)]
    assert sunday["is_weekend"] and sunday["is_peak_season"] and sunday["quarter"] == 4
    iso = days.select("date", calendar.week_year("iso").alias("y")).collect()
    assert {r["date"].day: r["y"] for r in iso} == {28: 2025, 29: 2026, 30: 2026, 31: 2026, 1: 2026}


def test_on_time_tolerance(spark):
    from datetime import timedelta

    rows = [shipment(i, DAYS[0]) for i in range(3)]
    rows[0]["pickup_actual_ts"] += timedelta(minutes=15)
    rows[1]["pickup_actual_ts"] += timedelta(minutes=15, seconds=1)
    rows[2]["pickup_actual_ts"] = None
    fact = make_star(spark, rows).fact
    flags = [r["on_time_pickup"] for r in calendar.derive_on_time(fact).orderBy("shipment_id").collect()]
    assert flags == [True, False, None]
    strict = calendar.derive_on_time(fact, tolerance_minutes=14).orderBy("shipment_id")
    assert strict.first()["on_time_pickup"] is False


def test_lane_classes(spark):
    df = spark.createDataFrame([(500.0,), (500.1,), (1500.0,), (1500.1,)], "m double")
    found = [r[0] for r in df.orderBy("m").select(calendar.classify_lane(F.col("m"))).collect()]
    assert found == ["Short", "Mid", "Mid", "Long"]
