"""A freight star derived from order-line tables.

Each order line is read as one shipment: the supplier is the carrier, the
customer the shipper, and supplier nation x customer region the lane. The rules
use integer arithmetic only, so any engine derives exactly the same rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstar import schema
from loadstar.functions.calendar import classify_lane, day_literal, dim_date
from loadstar.star import Star

FIRST_DAY = date(2024, 1, 1)
LAST_DAY = date(2024, 12, 31)
AS_OF = LAST_DAY


def _table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


def _stride(spark: SparkSession, path: str) -> Column:
    """Lane ids per origin: one for every region key there can be."""
    return _table(spark, path, "region").agg(F.max("r_regionkey") + 1).scalar()


def _pick(index: Column, values: tuple) -> Column:
    """``values[index]`` for a small fixed tuple."""
    picked = None
    for i, value in enumerate(values):
        when = F.when if picked is None else picked.when
        picked = when(index == i, F.lit(value))
    return picked


def _tier(carrier: Column) -> Column:
    digit = carrier % 10
    return (
        F.when(digit <= 1, "Strategic")
        .when(digit <= 4, "Core")
        .when(digit <= 7, "Tactical")
        .otherwise("Spot")
    )


def _by_tier(values: dict) -> Column:
    tier = F.col("carrier_tier")
    picked = None
    for name in schema.CARRIER_TIERS:
        when = F.when if picked is None else picked.when
        picked = when(tier == name, F.lit(values[name]))
    return picked


def _lane_miles(lane_id: Column) -> Column:
    return (80 + (lane_id * 997) % 2320).cast("double")


def _carriers(spark: SparkSession, path: str) -> DataFrame:
    nation = _table(spark, path, "nation")
    region = _table(spark, path, "region")
    key = F.col("s_suppkey")
    return (
        _table(spark, path, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("carrier_tier", _tier(key))
        .select(
            key.alias("carrier_id"),
            F.col("s_name").alias("carrier_name"),
            "carrier_tier",
            _pick(key % 4, schema.EQUIPMENT_TYPES).alias("equipment_type"),
            F.col("r_name").alias("region_primary"),
            F.date_add(day_literal(date(2015, 1, 1)), (key % 3000).cast("int")).alias(
                "partnership_start_date"
            ),
            _by_tier(schema.TIER_OTP_TARGET).alias("target_otp_pct"),
            _by_tier(schema.TIER_CONTRACT).alias("contract_type"),
        )
    )


def _lanes(spark: SparkSession, path: str) -> DataFrame:
    nation = _table(spark, path, "nation")
    region = _table(spark, path, "region")
    origin = region.select(
        F.col("r_regionkey").alias("o_regionkey"), F.col("r_name").alias("o_region")
    )
    stride = _stride(spark, path)
    destinations = F.explode(F.sequence(F.lit(0), stride - 1))
    lane_id = F.col("n_nationkey").cast("bigint") * stride + F.col("r_regionkey")
    return (
        nation.withColumn("dest", destinations)
        .join(origin, F.col("n_regionkey") == F.col("o_regionkey"))
        .join(region, F.col("dest") == F.col("r_regionkey"))
        .select(
            lane_id.alias("lane_id"),
            F.col("n_name").alias("origin_city"),
            F.col("o_region").alias("origin_state"),
            F.lpad(F.col("n_nationkey").cast("string"), 3, "0").alias("origin_zip3"),
            F.concat(F.lit("CITY_"), F.col("dest")).alias("dest_city"),
            F.col("r_name").alias("dest_state"),
            F.lpad((F.col("dest") * 7).cast("string"), 3, "0").alias("dest_zip3"),
            F.concat(F.lit("FC"), F.col("dest")).alias("dest_fc_id"),
            _lane_miles(lane_id).alias("distance_miles"),
            classify_lane(_lane_miles(lane_id)).alias("lane_type"),
        )
    )


def _shippers(spark: SparkSession, path: str) -> DataFrame:
    key = F.col("c_custkey")
    return _table(spark, path, "customer").select(
        key.alias("shipper_id"),
        F.col("c_name").alias("shipper_name"),
        _pick(key % 3, schema.VENDOR_TYPES).alias("vendor_type"),
        F.when(key < 20, "Top20")
        .when(key < 100, "Mid")
        .otherwise("LongTail")
        .alias("ship_volume_tier"),
        F.date_add(day_literal(date(2022, 6, 1)), (key % 900).cast("int")).alias(
            "onboarding_date"
        ),
        F.concat(F.lit("Manager "), (key % 8).cast("string")).alias("account_manager"),
        F.col("c_mktsegment").alias("industry_segment"),
    )


def _services(spark: SparkSession) -> DataFrame:
    """One row per service; order priorities map to their numbers."""
    index = F.col("service_type_id") - 1
    numbers = spark.range(1, len(schema.SERVICES) + 1, numPartitions=1)
    return numbers.select(F.col("id").cast("int").alias("service_type_id")).select(
        "service_type_id",
        _pick(index, tuple(s[0] for s in schema.SERVICES)).alias("service_name"),
        _pick(index, tuple(s[1] for s in schema.SERVICES)).alias(
            "transit_time_sla_hours"
        ),
        _pick(index, tuple(s[2] for s in schema.SERVICES)).alias("target_otp_pct"),
        _pick(index, tuple(s[3] for s in schema.SERVICES)).alias(
            "target_defect_rate_pct"
        ),
    )


def _service_id(priority: Column) -> Column:
    return (
        F.when(priority == "4-NOT SPECIFIED", 2)
        .when(priority == "5-LOW", 3)
        .otherwise(1)
    )


def _dollars(cents: str) -> Column:
    return (F.col(cents) * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(10,2)")


def _after(timestamp: str, unit: str, count: Column) -> Column:
    return F.timestamp_add(unit, count.cast("int"), F.col(timestamp))


def _carrier_rules(spark: SparkSession, path: str) -> DataFrame:
    """What the carrier adds to each of its shipments, once per carrier."""
    key = F.col("s_suppkey")
    return (
        _table(spark, path, "supplier")
        .withColumn("carrier_tier", _tier(key))
        .select(
            "s_suppkey",
            "s_nationkey",
            _by_tier({"Strategic": 95, "Core": 90, "Tactical": 85, "Spot": 78}).alias(
                "on_time_percent"
            ),
            _by_tier({"Strategic": -17, "Core": 0, "Tactical": 12, "Spot": 36}).alias(
                "carrier_rate"
            ),
            F.when(F.col("carrier_tier") == "Spot", 8).otherwise(15).alias("defect_every"),
            F.when(key % 25 == 8, 20).otherwise(0).alias("carrier_dip"),
        )
    )


def _order_rules(spark: SparkSession, path: str) -> DataFrame:
    """Shipper, destination region and service of each order."""
    nation = _table(spark, path, "nation")
    customer_region = (
        _table(spark, path, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_regionkey").alias("dest_region"))
    )
    hours = tuple(s[1] for s in schema.SERVICES)
    return (
        _table(spark, path, "orders")
        .join(customer_region, F.col("o_custkey") == F.col("c_custkey"), "left")
        .select(
            "o_orderkey",
            "o_custkey",
            "dest_region",
            _service_id(F.col("o_orderpriority")).alias("service_type_id"),
        )
        .withColumn("sla_hours", _pick(F.col("service_type_id") - 1, hours))
    )


def _day_rules(spark: SparkSession) -> DataFrame:
    """What the calendar adds to each shipment, once per day of the year."""
    day, weekday = F.col("date"), F.col("day_of_week")

    def since(start: date) -> Column:
        return day >= day_literal(start)

    weekday_dip = (
        F.when(weekday == 0, 4)
        .when(weekday == 4, 1)
        .when(weekday == 5, 3)
        .when(weekday == 6, 5)
        .otherwise(0)
    )
    december_dip = F.when(since(date(2024, 12, 1)), 5).otherwise(0)
    august = since(date(2024, 8, 5)) & ~since(date(2024, 8, 19))
    return dim_date(spark, FIRST_DAY, LAST_DAY).select(
        F.date_diff("date", day_literal(FIRST_DAY)).alias("day_number"),
        F.col("date_key").alias("shipment_date_key"),
        F.expr("CAST(date_key div 100 AS INT)").alias("ship_month"),
        day.cast("timestamp_ntz").alias("day_start"),
        (weekday_dip + december_dip).alias("day_dip"),
        F.when(august, 40).otherwise(0).alias("august_dip"),
        F.when(since(date(2024, 12, 3)), 1).otherwise(0).alias("carrier_dip_on"),
        F.when(since(date(2024, 12, 18)), 2).otherwise(1).alias("late_dwell"),
        F.when(F.col("is_peak_season"), 272).otherwise(243).alias("base_rate"),
    )


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Order lines with everything their order, carrier and day decide.

    Customers go to orders first, so the widest table is shuffled only once, on
    the fine-grained order key. No join is forced to broadcast: Spark sends a
    side to all executors only when its measured size allows it. A line whose
    order, customer, supplier or day is missing stays, with what depends on it
    NULL, so that the data checks can see it.
    """
    # a day of the year for every date, also before 1970
    day_number = F.pmod(F.unix_date(F.col("l_shipdate").cast("date")), F.lit(366))
    lines = _table(spark, path, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("shipment_id"),
        "l_orderkey",
        F.col("l_suppkey").alias("carrier_id"),
        (
            F.col("l_orderkey") * 31
            + F.col("l_partkey") * 17
            + F.col("l_suppkey") * 13
            + F.col("l_linenumber") * 7
        ).alias("h"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("pc"),
        F.col("l_quantity").cast("int").alias("qty"),
        (F.col("l_returnflag") == "R").alias("returned"),
        day_number.alias("day_number"),
    )
    orders = _order_rules(spark, path)
    carriers = _carrier_rules(spark, path)
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
        .join(carriers, F.col("carrier_id") == F.col("s_suppkey"), "left")
        .join(_day_rules(spark), "day_number", "left")
        .withColumn(
            "lane_id",
            F.col("s_nationkey").cast("bigint") * _stride(spark, path)
            + F.col("dest_region"),
        )
        .drop("l_orderkey", "o_orderkey", "s_suppkey", "s_nationkey", "dest_region")
    )


def _fact(lines: DataFrame) -> DataFrame:
    lane, h, pc, qty = F.col("lane_id"), F.col("h"), F.col("pc"), F.col("qty")
    late_dwell = F.when(lane % 10 == 3, F.col("late_dwell")).otherwise(1)
    lane_dip = F.when(lane < 3, F.col("august_dip")).otherwise(0)
    chance = (
        F.col("on_time_percent")
        - F.col("day_dip")
        - lane_dip
        - F.col("carrier_dip") * F.col("carrier_dip_on")
    )
    rate = F.col("base_rate") + F.col("carrier_rate") + pc % 60
    shaped = lines.withColumns(
        {
            "on_time_pickup": h % 100 < chance,
            "on_time_delivery": pc % 100 < 96,
            "pickup_appt_ts": _after("day_start", "HOUR", 6 + h % 14),
            "defect_flag": F.col("returned") & (h % F.col("defect_every") == 0),
            "distance_miles": _lane_miles(lane),
        }
    ).withColumns(
        {
            "delivery_appt_ts": _after("pickup_appt_ts", "HOUR", F.col("sla_hours")),
            "linehaul_cents": F.col("distance_miles").cast("bigint") * rate,
        }
    )
    accessorial_pct = F.when(h % 400 == 0, 60).otherwise(pc % 30)
    costed = (
        shaped.withColumn("accessorial_pct", accessorial_pct)
        .withColumns(
            {
                "fuel_cents": F.expr("linehaul_cents * 20 div 100"),
                "accessorial_cents": F.expr("linehaul_cents * accessorial_pct div 100"),
            }
        )
        .withColumn(
            "total_cents",
            F.col("linehaul_cents") + F.col("fuel_cents") + F.col("accessorial_cents"),
        )
    )
    pickup_delay = F.when(F.col("on_time_pickup"), h % 16).otherwise(16 + h % 160)
    delivery_delay = F.when(F.col("on_time_delivery"), -(pc % 600)).otherwise(
        16 + pc % 600
    )
    early = -(1 + pc % 29)
    wait = 5 + F.expr("(pc % 100) * (pc % 100) div (40 + 20 * (lane_id % 3))") * late_dwell
    reasons = F.array(*[F.lit(r) for r in schema.DEFECT_REASONS])
    return costed.select(
        "shipment_id",
        "shipment_date_key",
        "carrier_id",
        "lane_id",
        F.col("o_custkey").alias("shipper_id"),
        "service_type_id",
        "pickup_appt_ts",
        F.when(h % 250 != 0, _after("pickup_appt_ts", "MINUTE", pickup_delay)).alias(
            "pickup_actual_ts"
        ),
        "delivery_appt_ts",
        _after("delivery_appt_ts", "MINUTE", delivery_delay).alias("delivery_actual_ts"),
        "on_time_pickup",
        "on_time_delivery",
        F.when(pc % 1000 == 7, early).otherwise(wait).cast("double").alias(
            "dwell_minutes"
        ),
        "defect_flag",
        F.when(F.col("defect_flag"), F.get(reasons, qty % 7)).alias("defect_reason"),
        (0.2 + qty * 0.8 / 50).alias("trailer_utilization_pct"),
        "distance_miles",
        (qty * 900).cast("double").alias("weight_lbs"),
        F.expr("CAST(1 + qty * 29 div 50 AS INT)").alias("pallet_count"),
        _dollars("linehaul_cents").alias("linehaul_cost_usd"),
        _dollars("fuel_cents").alias("fuel_surcharge_usd"),
        _dollars("accessorial_cents").alias("accessorial_cost_usd"),
        _dollars("total_cents").alias("total_cost_usd"),
        "ship_month",
    )


def derive_star(spark: SparkSession, path: str, *, by_month: bool = False) -> Star:
    """The freight star over the order-line tables in ``path`` (lazy).

    ``by_month`` lays the fact out for a table partitioned by month. The lines
    are rebalanced while they are still narrow, before the fact columns are
    computed; adaptive execution splits a heavy month over several tasks.
    """
    lines = _lines(spark, path)
    if by_month:
        lines = lines.hint("rebalance", F.col("ship_month"))
    fact = _fact(lines)
    return Star(
        fact=fact if by_month else fact.drop("ship_month"),
        carrier=_carriers(spark, path),
        lane=_lanes(spark, path),
        shipper=_shippers(spark, path),
        date=dim_date(spark, FIRST_DAY, LAST_DAY),
        service=_services(spark),
    )
