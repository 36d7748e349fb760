"""Table layouts and the fixed vocabulary of the freight model."""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = T.DecimalType(10, 2)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, null) for n, t, null in fields])


# Entity ids are 64-bit so that a network with more than 2^31 shippers still fits.
FACT = _struct(
    ("shipment_id", T.StringType(), False),
    ("shipment_date_key", T.IntegerType(), False),
    ("carrier_id", T.LongType(), False),
    ("lane_id", T.LongType(), False),
    ("shipper_id", T.LongType(), False),
    ("service_type_id", T.IntegerType(), False),
    ("pickup_appt_ts", T.TimestampNTZType(), False),
    ("pickup_actual_ts", T.TimestampNTZType(), True),
    ("delivery_appt_ts", T.TimestampNTZType(), False),
    ("delivery_actual_ts", T.TimestampNTZType(), True),
    ("on_time_pickup", T.BooleanType(), False),
    ("on_time_delivery", T.BooleanType(), False),
    ("dwell_minutes", T.DoubleType(), False),
    ("defect_flag", T.BooleanType(), False),
    ("defect_reason", T.StringType(), True),
    ("trailer_utilization_pct", T.DoubleType(), False),
    ("distance_miles", T.DoubleType(), False),
    ("weight_lbs", T.DoubleType(), False),
    ("pallet_count", T.IntegerType(), False),
    ("linehaul_cost_usd", _MONEY, False),
    ("fuel_surcharge_usd", _MONEY, False),
    ("accessorial_cost_usd", _MONEY, False),
    ("total_cost_usd", _MONEY, False),
)

CARRIER = _struct(
    ("carrier_id", T.LongType(), False),
    ("carrier_name", T.StringType(), False),
    ("carrier_tier", T.StringType(), False),
    ("equipment_type", T.StringType(), False),
    ("region_primary", T.StringType(), False),
    ("partnership_start_date", T.DateType(), False),
    ("target_otp_pct", T.DoubleType(), False),
    ("contract_type", T.StringType(), False),
)

LANE = _struct(
    ("lane_id", T.LongType(), False),
    ("origin_city", T.StringType(), False),
    ("origin_state", T.StringType(), False),
    ("origin_zip3", T.StringType(), False),
    ("dest_city", T.StringType(), False),
    ("dest_state", T.StringType(), False),
    ("dest_zip3", T.StringType(), False),
    ("dest_fc_id", T.StringType(), False),
    ("distance_miles", T.DoubleType(), False),
    ("lane_type", T.StringType(), False),
)

SHIPPER = _struct(
    ("shipper_id", T.LongType(), False),
    ("shipper_name", T.StringType(), False),
    ("vendor_type", T.StringType(), False),
    ("ship_volume_tier", T.StringType(), False),
    ("onboarding_date", T.DateType(), False),
    ("account_manager", T.StringType(), False),
    ("industry_segment", T.StringType(), False),
)

DATE = _struct(
    ("date_key", T.IntegerType(), False),
    ("date", T.DateType(), False),
    ("year", T.IntegerType(), False),
    ("quarter", T.IntegerType(), False),
    ("month", T.IntegerType(), False),
    ("week_of_year", T.IntegerType(), False),
    ("day_of_week", T.IntegerType(), False),
    ("is_weekend", T.BooleanType(), False),
    ("is_holiday", T.BooleanType(), False),
    ("is_peak_season", T.BooleanType(), False),
)

SERVICE = _struct(
    ("service_type_id", T.IntegerType(), False),
    ("service_name", T.StringType(), False),
    ("transit_time_sla_hours", T.IntegerType(), False),
    ("target_otp_pct", T.DoubleType(), False),
    ("target_defect_rate_pct", T.DoubleType(), False),
)

# Table name -> layout, in load order: dimensions first, then the fact.
TABLES = {
    "dim_carrier": CARRIER,
    "dim_lane": LANE,
    "dim_shipper": SHIPPER,
    "dim_date": DATE,
    "dim_service_type": SERVICE,
    "fact_shipment": FACT,
}

# Fact foreign key -> (dimension table, dimension key).
FOREIGN_KEYS = {
    "shipment_date_key": ("dim_date", "date_key"),
    "carrier_id": ("dim_carrier", "carrier_id"),
    "lane_id": ("dim_lane", "lane_id"),
    "shipper_id": ("dim_shipper", "shipper_id"),
    "service_type_id": ("dim_service_type", "service_type_id"),
}

# ---- Fixed values of the freight model ------------------------------------
CARRIER_TIERS = ("Strategic", "Core", "Tactical", "Spot")
TIER_OTP_TARGET = {"Strategic": 0.95, "Core": 0.90, "Tactical": 0.85, "Spot": 0.78}
TIER_CONTRACT = {
    "Strategic": "Dedicated",
    "Core": "Contract",
    "Tactical": "Contract",
    "Spot": "Spot",
}
# name, transit SLA hours, target OTP, target defect rate
SERVICES = (
    ("FTL", 48, 0.92, 0.020),
    ("LTL", 96, 0.88, 0.028),
    ("Intermodal", 120, 0.85, 0.025),
)
DEFECT_REASONS = (
    "damaged_freight",
    "wrong_count",
    "late_pickup",
    "late_delivery",
    "missing_paperwork",
    "temperature_excursion",
    "refused_shipment",
)
EQUIPMENT_TYPES = ("Dry Van", "Reefer", "Flatbed", "Intermodal Container")
VENDOR_TYPES = ("Brand", "Wholesaler", "3PL")
DAY_NAMES = (
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
    "Sunday",
)
PEAK_MONTHS = (10, 11, 12)
SHORT_HAUL_MAX_MILES = 500
MID_HAUL_MAX_MILES = 1500
BENCHMARK_CPM = 2.43
NETWORK_OTP_TARGET_PCT = 90.0
ON_TIME_TOLERANCE_MINUTES = 15
