"""Hand-made stars for tests with known answers."""

from datetime import date, datetime, timedelta
from decimal import Decimal

from loadstar import schema
from loadstar.functions.calendar import dim_date
from loadstar.star import Star, date_key

_MORNING = timedelta(hours=8)


def shipment(number, day, **changes):
    """One fact row as a dict, with unremarkable defaults."""
    pickup = datetime.combine(day, datetime.min.time()) + _MORNING
    row = {
        "shipment_id": f"S{number}",
        "shipment_date_key": date_key(day),
        "carrier_id": 1,
        "lane_id": 1,
        "shipper_id": 1,
        "service_type_id": 1,
        "pickup_appt_ts": pickup,
        "pickup_actual_ts": pickup,
        "delivery_appt_ts": pickup + timedelta(hours=48),
        "delivery_actual_ts": pickup + timedelta(hours=40),
        "on_time_pickup": True,
        "on_time_delivery": True,
        "dwell_minutes": 30.0,
        "defect_flag": False,
        "defect_reason": None,
        "trailer_utilization_pct": 0.8,
        "distance_miles": 1000.0,
        "weight_lbs": 20000.0,
        "pallet_count": 10,
        "linehaul_cost_usd": Decimal("1600.00"),
        "fuel_surcharge_usd": Decimal("300.00"),
        "accessorial_cost_usd": Decimal("100.00"),
        "total_cost_usd": Decimal("2000.00"),
    }
    unknown = set(changes) - set(row)
    assert not unknown, unknown
    return {**row, **changes}


def make_star(
    spark,
    shipments,
    *,
    carriers=((1, "Strategic"), (2, "Core"), (3, "Tactical"), (4, "Spot")),
    lanes=(1, 2, 3),
    shippers=(1, 2, 3, 4),
    first=date(2024, 1, 1),
    last=date(2026, 12, 31),
):
    def frame(layout, rows):
        names = layout.fieldNames()
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], layout)

    carrier_rows = [
        {
            "carrier_id": i,
            "carrier_name": f"C{i}",
            "carrier_tier": tier,
            "equipment_type": "Dry Van",
            "region_primary": "West",
            "partnership_start_date": date(2020, 1, 1),
            "target_otp_pct": schema.TIER_OTP_TARGET[tier],
            "contract_type": schema.TIER_CONTRACT[tier],
        }
        for i, tier in carriers
    ]
    lane_rows = [
        {
            "lane_id": i,
            "origin_city": f"O{i}",
            "origin_state": "NJ",
            "origin_zip3": "071",
            "dest_city": "D",
            "dest_state": "MD",
            "dest_zip3": "021",
            "dest_fc_id": f"FC{i}",
            "distance_miles": 1000.0,
            "lane_type": "Mid",
        }
        for i in lanes
    ]
    shipper_rows = [
        {
            "shipper_id": i,
            "shipper_name": f"P{i}",
            "vendor_type": "Brand",
            "ship_volume_tier": "Top20",
            "onboarding_date": date(2023, 1, 31),
            "account_manager": "M",
            "industry_segment": "X",
        }
        for i in shippers
    ]
    service_rows = [
        {
            "service_type_id": i + 1,
            "service_name": name,
            "transit_time_sla_hours": hours,
            "target_otp_pct": otp,
            "target_defect_rate_pct": defect,
        }
        for i, (name, hours, otp, defect) in enumerate(schema.SERVICES)
    ]
    return Star(
        fact=frame(schema.FACT, shipments),
        carrier=frame(schema.CARRIER, carrier_rows),
        lane=frame(schema.LANE, lane_rows),
        shipper=frame(schema.SHIPPER, shipper_rows),
        date=dim_date(spark, first, last),
        service=frame(schema.SERVICE, service_rows),
    )
