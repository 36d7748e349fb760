"""DuckDB SQL that answers every catalogued query from the raw order-line tables.

The SQL is written independently of the DataFrame code: it derives the star
itself, joins all dimensions into one wide relation ``s`` and aggregates rows
directly, with the engine's own percentile, rank, window and rounding functions.
"""

from __future__ import annotations

from statistics import NormalDist

from loadstar import schema
from loadstar.operators import anomalies, hypothesis, lanes, network, pricing

AS_OF = "DATE '2024-12-31'"


def _list(values: tuple) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# --------------------------------------------------------------------------
# The star
# --------------------------------------------------------------------------
STAR = f"""
WITH raw AS (
  SELECT l_orderkey || '-' || l_linenumber AS shipment_id,
         DATE '2024-01-01' + CAST((CAST(l_shipdate AS DATE) - DATE '1970-01-01') % 366 AS INTEGER) AS ship_date,
         l_suppkey AS carrier_id,
         s_nationkey::BIGINT * 5 + n_regionkey AS lane_id,
         o_custkey AS shipper_id,
         CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 2 WHEN '5-LOW' THEN 3 ELSE 1 END AS service_type_id,
         l_orderkey * 31 + l_partkey * 17 + l_suppkey * 13 + l_linenumber * 7 AS h,
         CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS pc,
         CAST(l_quantity AS INTEGER) AS qty,
         l_returnflag AS returnflag
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey
), carrier AS (
  SELECT s_suppkey AS carrier_id, s_name AS carrier_name,
         CASE WHEN s_suppkey % 10 < 2 THEN 'Strategic' WHEN s_suppkey % 10 < 5 THEN 'Core'
              WHEN s_suppkey % 10 < 8 THEN 'Tactical' ELSE 'Spot' END AS carrier_tier,
         {_list(schema.EQUIPMENT_TYPES)}[s_suppkey % 4 + 1] AS equipment_type,
         r_name AS region_primary,
         DATE '2015-01-01' + CAST(s_suppkey % 3000 AS INTEGER) AS partnership_start_date,
         CASE WHEN s_suppkey % 10 < 2 THEN 0.95::DOUBLE WHEN s_suppkey % 10 < 5 THEN 0.90::DOUBLE
              WHEN s_suppkey % 10 < 8 THEN 0.85::DOUBLE ELSE 0.78::DOUBLE END AS target_otp_pct,
         CASE WHEN s_suppkey % 10 < 2 THEN 'Dedicated' WHEN s_suppkey % 10 < 8 THEN 'Contract'
              ELSE 'Spot' END AS contract_type
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
), lane AS (
  SELECT n.n_nationkey::BIGINT * 5 + d.r_regionkey AS lane_id, n.n_name AS origin_city,
         o.r_name AS origin_state, LPAD(n.n_nationkey::VARCHAR, 3, '0') AS origin_zip3,
         'CITY_' || d.r_regionkey AS dest_city, d.r_name AS dest_state,
         LPAD((d.r_regionkey * 7)::VARCHAR, 3, '0') AS dest_zip3, 'FC' || d.r_regionkey AS dest_fc_id,
         (80 + ((n.n_nationkey::BIGINT * 5 + d.r_regionkey) * 997) % 2320)::DOUBLE AS lane_miles
  FROM nation n JOIN region o ON n.n_regionkey = o.r_regionkey CROSS JOIN region d
), lane_dim AS (
  SELECT *, CASE WHEN lane_miles <= 500 THEN 'Short' WHEN lane_miles <= 1500 THEN 'Mid' ELSE 'Long' END AS lane_type
  FROM lane
), shipper AS (
  SELECT c_custkey AS shipper_id, c_name AS shipper_name,
         {_list(schema.VENDOR_TYPES)}[c_custkey % 3 + 1] AS vendor_type,
         CASE WHEN c_custkey < 20 THEN 'Top20' WHEN c_custkey < 100 THEN 'Mid' ELSE 'LongTail' END AS ship_volume_tier,
         DATE '2022-06-01' + CAST(c_custkey % 900 AS INTEGER) AS onboarding_date,
         'Manager ' || (c_custkey % 8) AS account_manager, c_mktsegment AS industry_segment
  FROM customer
), cal AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date,
         year(d)::INTEGER AS year, quarter(d)::INTEGER AS quarter, month(d)::INTEGER AS month,
         week(d)::INTEGER AS week_of_year, (isodow(d) - 1)::INTEGER AS day_of_week,
         isodow(d) > 5 AS is_weekend, FALSE AS is_holiday, month(d) >= 10 AS is_peak_season,
         isoyear(d)::INTEGER AS iso_year
  FROM (SELECT DATE '2024-01-01' + CAST(i AS INTEGER) AS d FROM range(366) t(i))
), service AS (
  SELECT * FROM (VALUES (1, 'FTL', 48, 0.92::DOUBLE, 0.020::DOUBLE), (2, 'LTL', 96, 0.88::DOUBLE, 0.028::DOUBLE),
    (3, 'Intermodal', 120, 0.85::DOUBLE, 0.025::DOUBLE))
    t(service_type_id, service_name, transit_time_sla_hours, target_otp_pct, target_defect_rate_pct)
), flags AS (
  SELECT raw.*, carrier_tier, lane_miles, transit_time_sla_hours,
    h % 100 < CASE carrier_tier WHEN 'Strategic' THEN 95 WHEN 'Core' THEN 90 WHEN 'Tactical' THEN 85 ELSE 78 END
      - CASE isodow(ship_date) WHEN 1 THEN 4 WHEN 5 THEN 1 WHEN 6 THEN 3 WHEN 7 THEN 5 ELSE 0 END
      - CASE WHEN ship_date >= DATE '2024-12-01' THEN 5 ELSE 0 END
      - CASE WHEN lane_id < 3 AND ship_date BETWEEN DATE '2024-08-05' AND DATE '2024-08-18' THEN 40 ELSE 0 END
      - CASE WHEN carrier_id % 25 = 8 AND ship_date >= DATE '2024-12-03' THEN 20 ELSE 0 END AS on_time_pickup,
    pc % 100 < 96 AS on_time_delivery,
    ship_date::TIMESTAMP + to_hours(6 + h % 14) AS pickup_appt_ts,
    returnflag = 'R' AND h % CASE carrier_tier WHEN 'Spot' THEN 8 ELSE 15 END = 0 AS defect_flag,
    lane_miles::BIGINT * (243 + CASE carrier_tier WHEN 'Strategic' THEN -17 WHEN 'Core' THEN 0 WHEN 'Tactical' THEN 12 ELSE 36 END
      + CASE WHEN month(ship_date) >= 10 THEN 29 ELSE 0 END + pc % 60) AS lh
  FROM raw JOIN carrier USING (carrier_id) JOIN lane_dim USING (lane_id) JOIN service USING (service_type_id)
), fact AS (
  SELECT shipment_id, CAST(strftime(ship_date, '%Y%m%d') AS INTEGER) AS shipment_date_key, ship_date,
    carrier_id, lane_id, shipper_id, service_type_id, pickup_appt_ts,
    CASE WHEN h % 250 <> 0 THEN pickup_appt_ts
      + to_minutes(CASE WHEN on_time_pickup THEN h % 16 ELSE 16 + h % 160 END) END AS pickup_actual_ts,
    pickup_appt_ts + to_hours(transit_time_sla_hours) AS delivery_appt_ts,
    pickup_appt_ts + to_hours(transit_time_sla_hours)
      + to_minutes(CASE WHEN on_time_delivery THEN -(pc % 600) ELSE 16 + pc % 600 END) AS delivery_actual_ts,
    on_time_pickup, on_time_delivery,
    (CASE WHEN pc % 1000 = 7 THEN -(1 + pc % 29)
      ELSE 5 + ((pc % 100) * (pc % 100) // (40 + 20 * (lane_id % 3)))
        * CASE WHEN lane_id % 10 = 3 AND ship_date >= DATE '2024-12-18' THEN 2 ELSE 1 END END)::DOUBLE AS dwell_minutes,
    defect_flag,
    CASE WHEN defect_flag THEN {_list(schema.DEFECT_REASONS)}[qty % 7 + 1] END AS defect_reason,
    0.2::DOUBLE + qty * 0.8::DOUBLE / 50 AS trailer_utilization_pct,
    lane_miles AS distance_miles, (qty * 900)::DOUBLE AS weight_lbs, (1 + qty * 29 // 50)::INTEGER AS pallet_count,
    CAST(lh / 100.0::DOUBLE AS DECIMAL(10,2)) AS linehaul_cost_usd,
    CAST((lh * 20 // 100) / 100.0::DOUBLE AS DECIMAL(10,2)) AS fuel_surcharge_usd,
    CAST((lh * CASE WHEN h % 400 = 0 THEN 60 ELSE pc % 30 END // 100) / 100.0::DOUBLE AS DECIMAL(10,2)) AS accessorial_cost_usd,
    CAST((lh + lh * 20 // 100 + lh * CASE WHEN h % 400 = 0 THEN 60 ELSE pc % 30 END // 100) / 100.0::DOUBLE
      AS DECIMAL(10,2)) AS total_cost_usd
  FROM flags
), s AS (
  SELECT f.*, c.carrier_name, c.carrier_tier, c.equipment_type, c.contract_type, c.target_otp_pct AS carrier_target,
    l.origin_city, l.origin_state, l.dest_city, l.dest_state, l.dest_fc_id, l.lane_miles, l.lane_type,
    p.shipper_name, p.vendor_type, p.ship_volume_tier, p.onboarding_date, p.industry_segment,
    k.date, k.year, k.month, k.week_of_year, k.day_of_week, k.iso_year, v.service_name,
    f.total_cost_usd::DOUBLE / NULLIF(f.distance_miles, 0) AS cpm,
    f.total_cost_usd::DOUBLE / NULLIF(f.pallet_count, 0) AS cpp,
    f.accessorial_cost_usd::DOUBLE / NULLIF(f.total_cost_usd::DOUBLE, 0) AS acc_share,
    CASE WHEN f.dwell_minutes > 0 THEN f.dwell_minutes END AS dwell
  FROM fact f JOIN carrier c USING (carrier_id) JOIN lane_dim l USING (lane_id) JOIN shipper p USING (shipper_id)
    JOIN cal k ON f.shipment_date_key = k.date_key JOIN service v USING (service_type_id)
)"""

# --------------------------------------------------------------------------
# KPI expressions over rows of ``s``
# --------------------------------------------------------------------------
N = "COUNT(*)"
OTP = "COUNT(*) FILTER (WHERE on_time_pickup)::DOUBLE / COUNT(*)"
OTD = "COUNT(*) FILTER (WHERE on_time_delivery)::DOUBLE / COUNT(*)"
DEFECT = "COUNT(*) FILTER (WHERE defect_flag)::DOUBLE / COUNT(*)"
COST = "SUM(total_cost_usd)::DOUBLE / COUNT(*)"
TOTAL = "SUM(total_cost_usd)::DOUBLE"
# averages of doubles are settled at 9 decimals, as summation order is free
CPM = "ROUND(AVG(cpm), 9)"
CPP = "ROUND(AVG(cpp), 9)"
ACC_SHARE = "ROUND(AVG(acc_share), 9)"
DWELL = "ROUND(AVG(dwell), 9)"
UTIL = "ROUND(AVG(trailer_utilization_pct), 9)"
MILES = "ROUND(AVG(distance_miles), 9)"
LANE = "origin_city || ' -> ' || dest_fc_id"


def _pct(value: str, digits: int = 1) -> str:
    return f"ROUND(({value}) * 100, {digits})"


def _round(value: str, digits: int) -> str:
    return f"ROUND({value}, {digits})"


def _half_even(value: str, digits: int) -> str:
    scale = f"{10**digits}::DOUBLE"
    return f"round_even(({value}) * {scale}, 0) / {scale}"


def _p(p: float, value: str = "dwell") -> str:
    return f"ROUND(quantile_cont({value}, {p}), 9)"


def _since(days: int) -> str:
    return f"date >= {AS_OF} - {days}"


def _q(select: str, rest: str = "", ctes: str = "") -> str:
    """A query over the star; ``ctes`` are further common tables."""
    head = STAR + (", " + ctes if ctes else "")
    return f"{head}\nSELECT {select} {rest}"


def _text(literal: str) -> str:
    return "'" + literal.replace("'", "''") + "'"


# --------------------------------------------------------------------------
# Pieces used by several queries
# --------------------------------------------------------------------------
def _weekly(year: str) -> str:
    return f"""w AS (SELECT {year} AS year, week_of_year, MIN(date) AS week_start, COUNT(*) AS n,
      {OTP} AS otp FROM s GROUP BY {year}, week_of_year)"""


def _rolling(year: str) -> str:
    return _q(
        f"""year, week_of_year, week_start, n AS shipment_count, {_pct("otp")} AS otp_pct,
        {_pct("AVG(otp) OVER (ORDER BY year, week_of_year ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)")}
          AS rolling_4w_avg_pct, 90.0::DOUBLE AS network_target_pct""",
        "FROM w",
        _weekly(year),
    )


def _wow(year: str) -> str:
    return _q(
        """year, week_of_year, week_start, otp_pct, prev AS prev_week_otp,
        ROUND(otp_pct - prev, 1) AS wow_change_pp""",
        f"""FROM (SELECT year, week_of_year, week_start, {_pct("otp")} AS otp_pct,
            LAG({_pct("otp")}) OVER (ORDER BY year, week_of_year) AS prev FROM w)""",
        _weekly(year),
    )


def _weekly_view(year: str) -> str:
    return _q(
        f"""{year} AS year, week_of_year, MIN(date) AS week_start, COUNT(*) AS shipment_count,
        {OTP} AS otp_rate, {OTD} AS otd_rate, {DWELL} AS avg_dwell, {DEFECT} AS defect_rate,
        {UTIL} AS avg_utilization, {COST} AS avg_cost_per_shipment, {CPM} AS avg_cost_per_mile,
        {TOTAL} AS total_cost""",
        f"FROM s GROUP BY {year}, week_of_year",
    )


_FLAGS = f"""flagged AS (SELECT carrier_id, carrier_name, carrier_tier, lane_id, {LANE} AS lane_label, date,
    {OTP} AS daily_otp, {CPM} AS daily_cpm, COUNT(*) AS daily_volume FROM s WHERE {_since(14)}
    GROUP BY ALL)"""


def _summary(select: str, limit: int) -> str:
    return _q(
        select,
        f"""FROM (SELECT carrier_name, carrier_tier, lane_label, COUNT(*) AS flagged_days,
              {_pct("AVG(daily_otp)")} AS avg_otp_pct, {_round("AVG(daily_cpm)", 2)} AS avg_cpm,
              SUM(daily_volume)::BIGINT AS total_volume
            FROM flagged GROUP BY carrier_name, carrier_tier, lane_label
            HAVING ROUND(AVG(daily_otp), 9) < 0.80)
          ORDER BY avg_otp_pct, carrier_name, carrier_tier, lane_label LIMIT {limit}""",
        _FLAGS,
    )


def _zscore_ctes(year: str, mode: str) -> str:
    spot = "SUM(tn) FILTER (WHERE carrier_tier = 'Spot')"
    spot_share = (
        f"CASE WHEN {spot} > 0 THEN 1.0 ELSE 0.0 END"
        if mode == "reference"
        else f"COALESCE({spot}, 0)::DOUBLE / SUM(tn)"
    )
    return f"""lw AS (SELECT lane_id, {year} AS year, week_of_year, MIN(date) AS week_start, {OTP} AS otp
      FROM s GROUP BY lane_id, {year}, week_of_year HAVING COUNT(*) >= 5),
    scored AS (SELECT *, AVG(otp) OVER b AS expected, STDDEV_SAMP(otp) OVER b AS spread, COUNT(*) OVER b AS weeks
      FROM lw WINDOW b AS (PARTITION BY lane_id ORDER BY year, week_of_year ROWS BETWEEN 8 PRECEDING AND 1 PRECEDING)),
    zs AS (SELECT *, (otp - expected) / spread AS z FROM scored WHERE weeks = 8 AND ROUND(spread, 9) > 0),
    picked AS (SELECT * FROM zs WHERE ROUND(ABS(z), 9) > 2.5),
    tiers AS (SELECT p.lane_id, p.week_start, s.carrier_tier, {ACC_SHARE} AS acc, COUNT(*) AS tn, {DEFECT} AS defect
      FROM picked p JOIN s ON s.lane_id = p.lane_id AND s.date BETWEEN p.week_start AND p.week_start + 6
      GROUP BY ALL),
    hints AS (SELECT lane_id, week_start, CONCAT_WS('; ',
        CASE WHEN ROUND(AVG(acc), 9) > 0.30 THEN {_text(anomalies.HINT_ACCESSORIAL)} END,
        CASE WHEN {spot_share} > 0.20 THEN {_text(anomalies.HINT_SPOT)} END,
        CASE WHEN MAX(defect) > 0.60 THEN {_text(anomalies.HINT_DEFECT)} END) AS hint
      FROM tiers GROUP BY lane_id, week_start),
    zscores AS (SELECT lane_id, week_start, year, week_of_year, {_half_even("otp", 4)} AS otp_observed,
        {_half_even("expected", 4)} AS otp_expected, {_half_even("z", 3)} AS z_score,
        CASE WHEN ROUND(ABS(z), 9) > 3.5 THEN 'HIGH' WHEN ROUND(ABS(z), 9) > 3.0 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
        CASE WHEN hint <> '' THEN hint WHEN z < 0 THEN {_text(anomalies.HINT_COLLAPSE)}
          ELSE {_text(anomalies.HINT_IMPROVED)} END AS reason_hint
      FROM picked LEFT JOIN hints USING (lane_id, week_start))"""


_IQR = f"""cd AS (SELECT carrier_id, carrier_name, lane_type, date, {CPM} AS day_cpm, COUNT(*) AS volume
      FROM s WHERE distance_miles > 0 GROUP BY ALL HAVING COUNT(*) >= 3),
    fence AS (SELECT lane_type, q3 + 1.5 * (q3 - q1) AS upper_f
      FROM (SELECT lane_type, {_p(0.25, "day_cpm")} AS q1, {_p(0.75, "day_cpm")} AS q3 FROM cd GROUP BY lane_type)),
    iqr AS (SELECT carrier_id, carrier_name, lane_type, date, {_half_even("day_cpm", 2)} AS daily_cpm,
        {_half_even("upper_f", 2)} AS upper_fence, {_half_even("(day_cpm - upper_f) / upper_f * 100", 1)} AS excess_pct,
        volume FROM cd JOIN fence USING (lane_type) WHERE day_cpm > upper_f)"""

_PRIMARY = f"""pairs AS (SELECT lane_id, carrier_id, carrier_name, carrier_tier, COUNT(*) AS vol,
      {_pct(OTP)} AS otp, {_round(COST, 2)} AS avg_cost FROM s GROUP BY ALL),
    prim AS (SELECT * FROM pairs QUALIFY ROW_NUMBER() OVER (PARTITION BY lane_id ORDER BY vol DESC, carrier_id) = 1)"""

_HEALTH = f"""m AS (SELECT shipper_id, shipper_name, vendor_type, ship_volume_tier, industry_segment, onboarding_date,
      COUNT(*) AS total_shipments, {OTD} AS otd_rate, COUNT(*) FILTER (WHERE NOT defect_flag)::DOUBLE / COUNT(*) AS defect_free_rate,
      {COST} AS avg_cost_per_shipment, STDDEV_SAMP(on_time_pickup::INTEGER) AS otp_sd,
      COUNT(*) FILTER (WHERE {_since(90)}) AS vol_last_90d,
      COUNT(*) FILTER (WHERE {_since(180)} AND NOT {_since(90)}) AS vol_prior_90d
      FROM s GROUP BY ALL),
    bench AS (SELECT ship_volume_tier, {COST} AS tier_cost FROM s GROUP BY ship_volume_tier),
    parts AS (SELECT m.*, CASE WHEN vol_prior_90d > 0 THEN (vol_last_90d - vol_prior_90d)::DOUBLE / vol_prior_90d ELSE 0 END AS growth_rate,
      (otd_rate * 0.6 + defect_free_rate * 0.4) * 100 AS service_score,
      LEAST(100, GREATEST(0, (1 - (avg_cost_per_shipment - tier_cost) / NULLIF(tier_cost, 0)) * 100)) AS cost_score,
      LEAST(100, GREATEST(0, (1 - otp_sd * 2) * 100)) AS reliability_score,
      LEAST(100, (year({AS_OF}) * 12 + month({AS_OF}) - year(onboarding_date) * 12 - month(onboarding_date))::DOUBLE / 24 * 100) AS tenure_score
      FROM m JOIN bench USING (ship_volume_tier)),
    scored AS (SELECT *, LEAST(100, GREATEST(0, 50 + growth_rate * 100)) AS growth_score FROM parts),
    health AS (SELECT * REPLACE ({", ".join(f"ROUND({c}, 9) AS {c}" for c in ("service_score", "cost_score", "growth_score", "reliability_score", "tenure_score"))}),
      ROUND(0.30 * service_score + 0.25 * cost_score + 0.20 * growth_score
        + 0.15 * reliability_score + 0.10 * tenure_score, 9) AS shipper_health_score FROM scored)"""


def _money_text(value: str, digits: int) -> str:
    return f"printf('%.{digits}f', {value})"


def _join(*pieces: str) -> str:
    return " || ".join(pieces)


_PRICING = f"""pm AS (SELECT shipper_id, shipper_name, vendor_type, COUNT(*) AS n, {COST} AS cps, {CPM} AS cpm_avg, {TOTAL} AS total,
      {MILES} AS miles, {OTD} AS otd, {DEFECT} AS defect,
      COUNT(*) FILTER (WHERE {_since(90)}) AS v1, COUNT(*) FILTER (WHERE {_since(180)} AND NOT {_since(90)}) AS v0
      FROM s GROUP BY ALL ORDER BY n DESC, shipper_id LIMIT 20),
    pg AS (SELECT *, 2.43::DOUBLE * 1.08::DOUBLE * miles * n AS revenue, CASE WHEN v0 > 0 THEN (v1 - v0)::DOUBLE / v0 ELSE 0 END AS g FROM pm),
    pr AS (SELECT *, revenue > total AS is_profitable, (total - revenue) / revenue * 100 AS gap FROM pg),
    pd AS (SELECT *, is_profitable AND g >= -0.20 AND g > 0.10 AND otd > 0.92 AS rewarded FROM pr),
    pl AS (SELECT *, list_filter([
        CASE WHEN NOT is_profitable THEN {_join(_text(pricing.DRIVER_UNPROFITABLE[0]), _money_text("gap", 0), _text(pricing.DRIVER_UNPROFITABLE[1]))} END,
        CASE WHEN g < -0.20 THEN {_join(_text(pricing.DRIVER_DECLINE[0]), _money_text("g * 100", 0), _text(pricing.DRIVER_DECLINE[1]))} END,
        CASE WHEN otd < 0.85 THEN {_join(_text(pricing.DRIVER_OTD[0]), _money_text("otd * 100", 1), _text(pricing.DRIVER_OTD[1]))} END,
        CASE WHEN defect > 0.03 THEN {_join(_text(pricing.DRIVER_DEFECT[0]), _money_text("defect * 100", 1), _text(pricing.DRIVER_DEFECT[1]))} END,
        CASE WHEN rewarded THEN {_join(_text(pricing.DRIVER_GROWTH[0]), _money_text("g * 100", 0), _text(pricing.DRIVER_GROWTH[1]), _money_text("otd * 100", 0), _text(pricing.DRIVER_GROWTH[2]))} END
      ], lambda x: x IS NOT NULL) AS drivers FROM pd),
    recs AS (SELECT shipper_id, shipper_name, vendor_type, n AS shipment_count, {_half_even("cps", 2)} AS avg_cost_per_shipment,
      {_half_even("cpm_avg", 2)} AS avg_cpm, {_half_even("otd", 4)} AS otd_rate, {_half_even("defect", 4)} AS defect_rate,
      {_half_even("g", 4)} AS growth_rate, is_profitable,
      CASE WHEN NOT is_profitable THEN {_text(pricing.RENEGOTIATE)} WHEN g < -0.20 OR rewarded THEN {_text(pricing.DISCOUNT)}
        ELSE {_text(pricing.HOLD)} END AS recommendation,
      {_half_even("CASE WHEN NOT is_profitable THEN LEAST(15, GREATEST(3, gap / 2)) WHEN g < -0.20 THEN -LEAST(8, GREATEST(2, ABS(g) * 10)) WHEN rewarded THEN -LEAST(5, GREATEST(2, g * 20)) ELSE 0.0::DOUBLE END", 1)} AS pct_change,
      COALESCE(drivers[1], {_text(pricing.NO_DRIVER)}) AS driver_1, COALESCE(drivers[2], '') AS driver_2 FROM pl)"""

_Z95 = repr(NormalDist().inv_cdf(0.975))


def _forecast(
    series: str, key: str, time: str, value: str, period: int, horizon: int, least: int, names: tuple
) -> str:
    """Seasonal walk with drift. Earlier seasons are found by date, in a calendar without gaps."""
    part = f"PARTITION BY {key}" if key else ""
    keys = f"{key}, " if key else ""
    step, middle, low, high = names
    weekly = time == "week_start"
    every = 7 if weekly else 1
    day = f"date_trunc('week', {time})::DATE" if weekly else time
    last = f"date_trunc('week', {AS_OF})::DATE" if weekly else AS_OF
    same = f"a.{key} = b.{key} AND " if key else ""
    known = f"LAST_VALUE({value} IGNORE NULLS) OVER ({part} ORDER BY t)" if weekly else f"COALESCE({value}, 0.0::DOUBLE)"
    return _q(
        f"""{keys}step::INTEGER AS {step}, ROUND(ROUND(y + k * drift, 8), 6) AS {middle},
        ROUND(ROUND(y + k * drift - {_Z95}::DOUBLE * sigma * SQRT(k), 8), 6) AS {low},
        ROUND(ROUND(y + k * drift + {_Z95}::DOUBLE * sigma * SQRT(k), 8), 6) AS {high}""",
        f"""FROM (SELECT *, ((step - place) // {period} + 1)::DOUBLE AS k
              FROM last_season JOIN range(1, {horizon + 1}) h(step)
                ON step >= place AND (step - place) % {period} = 0)""",
        f"""ser AS ({series}),
        dated AS (SELECT {keys}{day} AS t, {value} FROM ser),
        steps AS (SELECT {keys}UNNEST(generate_series(MIN(t), {last}, INTERVAL {every} DAY))::DATE AS t
            FROM dated {"GROUP BY " + key if key else ""}),
        filled AS (SELECT {keys}t, {known} AS y FROM steps LEFT JOIN dated USING ({keys}t)),
        ch AS (SELECT {"a." + keys if key else ""}a.y, ROW_NUMBER() OVER ({part.replace("BY ", "BY a.")} ORDER BY a.t) AS t, a.y - b.y AS d
            FROM filled a LEFT JOIN filled b ON {same}b.t = a.t - {period * every}),
        fit AS (SELECT *, COUNT(*) OVER ({part}) AS n, AVG(d) OVER ({part}) AS drift,
            STDDEV_SAMP(d) OVER ({part}) AS sigma FROM ch),
        last_season AS (SELECT *, t - (n - {period}) AS place FROM fit WHERE n >= {least} AND t > n - {period})""",
    )


def _otp_series(key: str) -> str:
    keys = f"{key}, " if key else ""
    return f"""SELECT {keys}year, week_of_year, MIN(date) AS week_start, {OTP} AS otp
      FROM s GROUP BY {keys}year, week_of_year"""


def _cost_series(key: str) -> str:
    keys = f"{key}, " if key else ""
    return f"SELECT {keys}date, {TOTAL} AS daily_cost FROM s GROUP BY {keys}date"


_OTP_NAMES = ("week", "otp_forecast", "otp_lower", "otp_upper")
_COST_NAMES = ("day", "cost_forecast", "cost_lower", "cost_upper")


def _mix(x: str) -> str:
    """Twice: fold the high half in and multiply; then fold once more."""
    for _ in range(2):
        x = f"((xor({x}, ({x}) >> 16) * 73244475) & 4294967295)"
    return f"xor({x}, ({x}) >> 16)"


_BOOT = f"""hist AS (SELECT carrier_id, (total_cost_usd * 100)::BIGINT * 2 + on_time_pickup::BIGINT AS outcome,
      ROW_NUMBER() OVER (PARTITION BY carrier_id ORDER BY (total_cost_usd * 100)::BIGINT * 2 + on_time_pickup::BIGINT) - 1 AS pos FROM s),
    sizes AS (SELECT carrier_id, COUNT(*) AS n FROM s GROUP BY carrier_id HAVING COUNT(*) >= 30),
    m1 AS (SELECT carrier_id, n, (42 + carrier_id) & 4294967295 AS x FROM sizes),
    m2 AS (SELECT carrier_id, n, rep, ({_mix("x")} + rep) & 4294967295 AS x FROM m1, range(1000) r(rep)),
    m3 AS (SELECT carrier_id, n, rep, ({_mix("x")} + pick) & 4294967295 AS x FROM m2, range(1, 101) p(pick) WHERE pick <= n),
    draws AS (SELECT carrier_id, rep, floor({_mix("x")} / 4294967296.0::DOUBLE * n)::BIGINT AS pos FROM m3),
    means AS (SELECT carrier_id, rep, SUM(outcome % 2)::DOUBLE / COUNT(*) * 100 AS otp,
        SUM(outcome // 2)::DOUBLE / COUNT(*) / 100 AS cost
      FROM draws JOIN hist USING (carrier_id, pos) GROUP BY carrier_id, rep),
    boot AS (SELECT carrier_id, AVG(otp) AS otp_mean, quantile_cont(otp, 0.025) AS otp_low, quantile_cont(otp, 0.975) AS otp_high,
        AVG(cost) AS cost_mean, quantile_cont(cost, 0.025) AS cost_low, quantile_cont(cost, 0.975) AS cost_high
      FROM means GROUP BY carrier_id)"""

_LANE_DISPLAY = "origin_city || ', ' || origin_state || ' -> ' || dest_fc_id"

_DIMS = {
    "dim_carrier": ("carrier", "carrier_id"),
    "dim_lane": ("lane_dim", "lane_id"),
    "dim_shipper": ("shipper", "shipper_id"),
    "dim_date": ("cal", "date_key"),
    "dim_service_type": ("service", "service_type_id"),
    "fact_shipment": ("fact", "shipment_id"),
}


def _table_counts() -> str:
    parts = [
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {cte}"
        for name, (cte, _) in _DIMS.items()
    ]
    return f"{STAR}\n" + " UNION ALL ".join(parts)


def _pk_unique() -> str:
    parts = [
        f"""SELECT 'duplicate_{name}' AS check_name, (COUNT(*) - COUNT(DISTINCT {key}))::DOUBLE AS value,
        COUNT(*) = COUNT(DISTINCT {key}) AS passed FROM {cte}"""
        for name, (cte, key) in _DIMS.items()
    ]
    return f"{STAR}\n" + " UNION ALL ".join(parts)


def _not_null() -> str:
    parts = []
    for name, layout in schema.TABLES.items():
        for field in layout.fields:
            if field.nullable:
                continue
            column = field.name
            if (name, column) == ("dim_lane", "distance_miles"):
                column = "lane_miles"
            parts.append(
                f"""SELECT 'not_null_{name}.{field.name}' AS check_name,
                COUNT(*) FILTER (WHERE {column} IS NULL)::DOUBLE AS value,
                COUNT(*) FILTER (WHERE {column} IS NULL) = 0 AS passed FROM {_DIMS[name][0]}"""
            )
    return f"{STAR}\n" + " UNION ALL ".join(parts)


def _orphans() -> str:
    parts = []
    for column, (table, key) in schema.FOREIGN_KEYS.items():
        cte = _DIMS[table][0]
        parts.append(
            f"""SELECT 'orphan_{column}' AS check_name, COUNT(*)::DOUBLE AS value, COUNT(*) = 0 AS passed
            FROM fact f WHERE NOT EXISTS (SELECT 1 FROM {cte} d WHERE d.{key} = f.{column})"""
        )
    return f"{STAR}\n" + " UNION ALL ".join(parts)


def _check(name: str, value: str, passed: str, source: str = "s") -> str:
    return _q(
        f"'{name}' AS check_name, ({value})::DOUBLE AS value, {passed} AS passed",
        f"FROM {source}",
    )


_PERIODS = ("otp", "dwell", "defect", "cost")


def _period_delta() -> str:
    def side(condition: str) -> str:
        return f"""SELECT {_pct(OTP)} AS otp, {_round(DWELL, 1)} AS dwell, {_pct(DEFECT, 2)} AS defect,
          {_round(COST, 0)} AS cost FROM s WHERE {condition}"""

    columns = ", ".join(
        [f"a.{c}" for c in _PERIODS]
        + [f"b.{c} AS prior_{c}" for c in _PERIODS]
        + [f"ROUND(a.{c} - b.{c}, 2) AS {c}_delta" for c in _PERIODS]
    )
    return _q(
        columns,
        "FROM a CROSS JOIN b",
        f"a AS ({side(_since(30))}), b AS ({side(_since(60) + ' AND NOT ' + _since(30))})",
    )


ORACLE_SQL: dict[str, str] = {
    "q01_top10_lanes_by_volume": _q(
        f"""lane_id, origin_city || ', ' || origin_state AS origin, dest_fc_id AS destination,
        lane_miles AS distance_miles, lane_type, COUNT(*) AS shipment_count, {_pct(OTP)} AS otp_pct,
        {_round(COST, 2)} AS avg_cost""",
        "FROM s GROUP BY lane_id, origin_city, origin_state, dest_fc_id, lane_miles, lane_type "
        "ORDER BY shipment_count DESC, lane_id LIMIT 10",
    ),
    "q02_otp_by_carrier_tier": _q(
        f"""carrier_tier, carrier_name, n AS shipment_count, {_pct("otp")} AS otp_pct,
        carrier_target * 100 AS target_otp_pct,
        RANK() OVER (PARTITION BY carrier_tier ORDER BY otp DESC) AS rank_within_tier""",
        f"""FROM (SELECT carrier_tier, carrier_name, carrier_target, COUNT(*) AS n, {OTP} AS otp
             FROM s GROUP BY ALL)""",
    ),
    "q03_dwell_percentiles_by_carrier": _q(
        f"""carrier_name, carrier_tier, COUNT(*) AS shipment_count, {_round(_p(0.5), 1)} AS dwell_p50,
        {_round(_p(0.9), 1)} AS dwell_p90, {_round(_p(0.99), 1)} AS dwell_p99""",
        "FROM s GROUP BY carrier_name, carrier_tier",
    ),
    "q04_defect_rate_trend_monthly": _q(
        f"""year, month, COUNT(*) AS total_shipments, COUNT(*) FILTER (WHERE defect_flag) AS defect_count,
        {_pct(DEFECT, 2)} AS defect_rate_pct""",
        "FROM s GROUP BY year, month",
    ),
    "q05_carrier_lane_otp_matrix": _q(
        f"""carrier_name, carrier_tier, origin_city || '->' || dest_fc_id AS lane, COUNT(*) AS shipment_count,
        {_pct(OTP)} AS otp_pct, {_round(CPM, 2)} AS cost_per_mile""",
        "FROM s GROUP BY carrier_name, carrier_tier, lane HAVING COUNT(*) >= 50 "
        "ORDER BY otp_pct, carrier_name, lane LIMIT 50",
    ),
    "q06_otp_by_dayofweek": _q(
        f"""day_of_week, dayname(MIN(date)) AS day_name, COUNT(*) AS shipment_count, {_pct(OTP)} AS otp_pct,
        {_pct(DEFECT, 2)} AS defect_rate_pct, {_round(DWELL, 1)} AS avg_dwell_min""",
        "FROM s GROUP BY day_of_week",
    ),
    "q07_weekly_otp_trend_vs_target": _rolling("year"),
    "q07_weekly_otp_trend_vs_target_iso": _rolling("iso_year"),
    "q08_late_pickup_cascade": _q(
        f"""{_text(network.CASCADE_LABEL)} AS analysis, COUNT(*) AS total_shipments,
        COUNT(*) FILTER (WHERE NOT on_time_pickup AND NOT on_time_delivery) AS late_pickup_late_delivery,
        COUNT(*) FILTER (WHERE NOT on_time_pickup AND on_time_delivery) AS late_pickup_ontime_delivery,
        COUNT(*) FILTER (WHERE on_time_pickup AND NOT on_time_delivery) AS ontime_pickup_late_delivery,
        COUNT(*) FILTER (WHERE on_time_pickup AND on_time_delivery) AS ontime_pickup_ontime_delivery,
        {_pct("AVG((NOT on_time_delivery)::INTEGER) FILTER (WHERE NOT on_time_pickup)")}
          AS pct_late_pickup_leads_to_late_delivery,
        {_pct("AVG((NOT on_time_delivery)::INTEGER) FILTER (WHERE on_time_pickup)")}
          AS pct_ontime_pickup_still_late_delivery""",
        "FROM s WHERE pickup_actual_ts IS NOT NULL",
    ),
    "q09_defect_reason_pareto": _q(
        f"""defect_reason, c AS defect_count, {_pct("c::DOUBLE / SUM(c) OVER ()")} AS pct_of_total,
        {_pct("SUM(c) OVER (ORDER BY c DESC)::DOUBLE / SUM(c) OVER ()")} AS cumulative_pct""",
        """FROM (SELECT defect_reason, COUNT(*) AS c FROM s WHERE defect_flag AND defect_reason IS NOT NULL
             GROUP BY defect_reason)""",
    ),
    "q10_dwell_outliers_by_lane": _q(
        f"""lane_id, {_LANE_DISPLAY} AS lane, lane_type, COUNT(*) AS shipment_count,
        {_round(_p(0.5), 1)} AS dwell_p50, {_round(_p(0.9), 1)} AS dwell_p90, {_round(_p(0.99), 1)} AS dwell_p99""",
        f"FROM s GROUP BY lane_id, lane, lane_type HAVING {_p(0.99)} > 180",
    ),
    "q11_cost_per_mile_by_carrier_tier": _q(
        f"""carrier_tier, COUNT(*) AS shipment_count, {_round(CPM, 2)} AS avg_cost_per_mile,
        {_round("MIN(cpm)", 2)} AS min_cpm, {_round("MAX(cpm)", 2)} AS max_cpm, {_round(TOTAL, 2)} AS total_spend""",
        "FROM s GROUP BY carrier_tier",
    ),
    "q12_accessorial_pct_by_carrier": _q(
        f"""carrier_name, carrier_tier, COUNT(*) AS shipment_count,
        SUM(accessorial_cost_usd)::DOUBLE AS total_accessorial, {TOTAL} AS total_cost,
        {_pct("SUM(accessorial_cost_usd)::DOUBLE / NULLIF(SUM(total_cost_usd)::DOUBLE, 0)")} AS accessorial_pct""",
        "FROM s GROUP BY carrier_name, carrier_tier",
    ),
    "q13_top20_shippers_costtoserve": _q(
        f"""shipper_name, vendor_type, ship_volume_tier, industry_segment, COUNT(*) AS shipment_count,
        {TOTAL} AS total_cost, {_round(COST, 2)} AS avg_cost_per_shipment, {_round(CPM, 2)} AS avg_cpm,
        {_pct(OTD)} AS otd_pct, {_pct(DEFECT, 2)} AS defect_rate_pct""",
        "FROM s GROUP BY shipper_name, vendor_type, ship_volume_tier, industry_segment "
        "ORDER BY total_cost DESC, shipper_name LIMIT 20",
    ),
    "q14_lane_profitability_vs_benchmark": _q(
        f"""lane_id, {LANE} AS lane, lane_type, lane_miles AS distance_miles, COUNT(*) AS shipment_count,
        {_round(CPM, 2)} AS observed_cpm, 2.43::DOUBLE AS benchmark_cpm,
        {_pct(f"(2.43::DOUBLE - {CPM}) / 2.43::DOUBLE")} AS profitability_index_pct,
        CASE WHEN {CPM} > 2.43 THEN {_text(lanes.ABOVE_BENCHMARK)} ELSE {_text(lanes.BELOW_BENCHMARK)} END AS cost_status""",
        "FROM s GROUP BY lane_id, lane, lane_type, lane_miles HAVING COUNT(*) >= 100",
    ),
    "q15_seasonal_cost_lift_q4": _q(
        f"""CASE WHEN month >= 10 THEN {_text(network.PEAK_LABEL)} ELSE {_text(network.OFF_PEAK_LABEL)} END AS period,
        COUNT(*) AS shipment_count, {_round(COST, 2)} AS avg_cost_per_shipment, {_round(CPM, 2)} AS avg_cpm,
        {_round("SUM(linehaul_cost_usd)::DOUBLE / COUNT(*)", 2)} AS avg_linehaul,
        {_round("SUM(accessorial_cost_usd)::DOUBLE / COUNT(*)", 2)} AS avg_accessorial, {_pct(OTP)} AS otp_pct""",
        "FROM s GROUP BY period",
    ),
    "q16_accessorial_pareto_by_reason": _q(
        f"""reason, n AS shipment_count, total AS total_accessorial, {_round("total / n", 2)} AS avg_accessorial,
        {_pct("total / SUM(exact) OVER ()::DOUBLE")} AS pct_of_total,
        {_pct("SUM(exact) OVER (ORDER BY exact DESC)::DOUBLE / SUM(exact) OVER ()::DOUBLE")} AS cumulative_pct""",
        f"""FROM (SELECT COALESCE(defect_reason, {_text(network.NO_DEFECT_LABEL)}) AS reason, COUNT(*) AS n,
              SUM(accessorial_cost_usd) AS exact, SUM(accessorial_cost_usd)::DOUBLE AS total
            FROM s WHERE accessorial_cost_usd > 0 GROUP BY reason)""",
    ),
    "q17_cost_per_pallet_by_service_type": _q(
        f"""service_name, COUNT(*) AS shipment_count, {_round(CPP, 2)} AS avg_cost_per_pallet,
        {_round(COST, 2)} AS avg_cost_per_shipment, {_round("AVG(pallet_count)", 1)} AS avg_pallets_per_shipment,
        {_pct(UTIL)} AS avg_utilization_pct""",
        "FROM s GROUP BY service_name",
    ),
    "q18_haul_economics": _q(
        f"""lane_type, COUNT(*) AS shipment_count, {_round("AVG(lane_miles)", 0)} AS avg_distance,
        {_round(COST, 2)} AS avg_cost_per_shipment, {_round(CPM, 2)} AS avg_cpm,
        {_pct(ACC_SHARE)} AS accessorial_share_pct, {_pct(OTP)} AS otp_pct,
        {_pct(DEFECT, 2)} AS defect_rate_pct, {_pct(UTIL)} AS avg_utilization_pct""",
        "FROM s GROUP BY lane_type",
    ),
    "q19_trailer_utilization_by_service": _q(
        f"""service_name, COUNT(*) AS shipment_count, {_pct(UTIL)} AS avg_utilization_pct,
        {_pct(_p(0.25, "trailer_utilization_pct"))} AS util_p25, {_pct(_p(0.5, "trailer_utilization_pct"))} AS util_p50,
        {_pct(_p(0.75, "trailer_utilization_pct"))} AS util_p75,
        {_pct("COUNT(*) FILTER (WHERE trailer_utilization_pct < 0.5)::DOUBLE / COUNT(*)")} AS pct_under_50""",
        "FROM s GROUP BY service_name",
    ),
    "q20_underutilized_lanes_top20": _q(
        f"""lane_id, {LANE} AS lane, lane_type, COUNT(*) AS shipment_count, {_pct(UTIL)} AS avg_utilization_pct,
        {_round(COST, 2)} AS avg_cost_per_shipment, {_round(CPM, 2)} AS avg_cpm""",
        "FROM s GROUP BY lane_id, lane, lane_type HAVING COUNT(*) >= 50 ORDER BY avg_utilization_pct, lane_id LIMIT 20",
    ),
    **{
        f"q21_modal_mismatch_candidates{suffix}": _q(
            f"""lane_id, {LANE} AS lane, COUNT(*) AS ltl_shipment_count, {_pct(UTIL)} AS avg_utilization_pct,
            {_round("AVG(weight_lbs)", 0)} AS avg_weight_lbs, {_round("AVG(pallet_count)", 1)} AS avg_pallets,
            {_round(COST, 2)} AS avg_cost_ltl, {_text(lanes.CONSIDER_FTL)} AS recommendation""",
            f"""FROM s WHERE service_name = 'LTL' GROUP BY lane_id, lane
            HAVING {UTIL} > {util} AND AVG(weight_lbs) > {weight} AND COUNT(*) >= 20""",
        )
        for suffix, util, weight in (("", 0.70, 30000), ("_low", 0.62, 23500))
    },
    "q22_intermodal_candidates": _q(
        f"""lane_id, {LANE} AS lane, lane_miles AS distance_miles, COUNT(*) AS ftl_volume,
        {_round(CPM, 2)} AS current_cpm, {_round(f"{CPM} * 0.8::DOUBLE", 2)} AS est_intermodal_cpm,
        {_round(_round(f"{CPM} * 0.2::DOUBLE * {MILES} * COUNT(*)", 6), 0)} AS est_annual_savings,
        {_text(lanes.EVALUATE_INTERMODAL)} AS recommendation""",
        """FROM s WHERE service_name = 'FTL' AND lane_miles > 1500 GROUP BY lane_id, lane, lane_miles
        HAVING COUNT(*) >= 100 ORDER BY est_annual_savings DESC, lane_id LIMIT 15""",
    ),
    "q23_carrier_concentration": _q(
        f"""carrier_name, carrier_tier, n AS shipment_count, {_pct("n::DOUBLE / SUM(n) OVER ()")} AS volume_share_pct,
        {_pct("SUM(n) OVER (ORDER BY n DESC)::DOUBLE / SUM(n) OVER ()")} AS cumulative_share_pct""",
        """FROM (SELECT carrier_name, carrier_tier, COUNT(*) AS n FROM s GROUP BY ALL)
        ORDER BY n DESC, carrier_name LIMIT 10""",
    ),
    "q24_shipper_volume_pareto": _q(
        f"""r::INTEGER AS rank, shipper_name, ship_volume_tier, n AS shipment_count,
        {_pct("n::DOUBLE / SUM(n) OVER ()", 2)} AS pct_of_total,
        {_pct("SUM(n) OVER (ORDER BY r)::DOUBLE / SUM(n) OVER ()")} AS cumulative_pct""",
        """FROM (SELECT shipper_name, ship_volume_tier, COUNT(*) AS n,
             ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, shipper_name, ship_volume_tier) AS r
           FROM s GROUP BY shipper_name, ship_volume_tier)
        ORDER BY r LIMIT 50""",
    ),
    "q25_origin_state_volume": _q(
        f"""origin_state, COUNT(DISTINCT lane_id) AS lane_count, COUNT(*) AS shipment_count, {_pct(OTP)} AS otp_pct,
        {_round(COST, 2)} AS avg_cost_per_shipment, {_round(TOTAL, 0)} AS total_cost""",
        "FROM s GROUP BY origin_state",
    ),
    "q26_inbound_node_load_balance": _q(
        f"""dest_fc_id, dest_city || ', ' || dest_state AS fc_location, COUNT(*) AS shipment_count,
        {_pct("COUNT(*)::DOUBLE / SUM(COUNT(*)) OVER ()")} AS volume_share_pct, {_pct(OTP)} AS otp_pct,
        {_round(DWELL, 1)} AS avg_dwell, {_round(COST, 2)} AS avg_cost_per_shipment""",
        "FROM s GROUP BY dest_fc_id, fc_location",
    ),
    "q27_otp_wow_pct_change": _wow("year"),
    "q27_otp_wow_pct_change_iso": _wow("iso_year"),
    "q28_carriers_otp_decline": _q(
        f"""carrier_name, carrier_tier, {_pct("prior")} AS otp_prior_4w_pct, {_pct("recent")} AS otp_last_4w_pct,
        {_pct("recent - prior")} AS change_pp""",
        f"""FROM (SELECT carrier_id, carrier_name, carrier_tier,
              AVG(on_time_pickup::INTEGER) FILTER (WHERE {_since(28)}) AS recent,
              AVG(on_time_pickup::INTEGER) FILTER (WHERE NOT {_since(28)}) AS prior
            FROM s WHERE {_since(56)} GROUP BY ALL) WHERE recent - prior < -0.05""",
    ),
    "q29_lanes_dwell_spike": _q(
        f"""lane, base AS baseline_dwell_p90, recent AS recent_dwell_p90,
        {_pct("(recent - base) / NULLIF(base, 0)")} AS pct_change, recent_volume""",
        f"""FROM (SELECT lane_id, {LANE} AS lane, ROUND(quantile_cont(dwell, 0.9) FILTER (WHERE NOT {_since(14)}), 9) AS base,
              ROUND(quantile_cont(dwell, 0.9) FILTER (WHERE {_since(14)}), 9) AS recent, COUNT(*) FILTER (WHERE {_since(14)}) AS recent_volume
            FROM s GROUP BY lane_id, lane) WHERE recent > base * 1.5 AND recent_volume >= 10""",
    ),
    "q30_anomaly_summary_14d": _summary("*", 20),
    "q31_paired_t_test": _q(
        f"""COUNT(*) AS paired_lanes, {_pct("AVG(d)", 2)} AS mean_otp_diff_pp, {_pct("STDDEV_SAMP(d)", 2)} AS std_diff_pp,
        ROUND(AVG(d) / (STDDEV_SAMP(d) / SQRT(COUNT(*))), 3) AS t_statistic, 1.96::DOUBLE AS critical_value_alpha_05,
        CASE WHEN ABS(AVG(d) / (STDDEV_SAMP(d) / SQRT(COUNT(*)))) > 1.96 THEN {_text(hypothesis.PAIRED_REJECT)}
          ELSE {_text(hypothesis.PAIRED_KEEP)} END AS conclusion""",
        f"""FROM (SELECT a.otp - b.otp AS d FROM g a JOIN g b USING (lane_id)
             WHERE a.carrier_tier = 'Strategic' AND b.carrier_tier = 'Tactical')""",
        f"g AS (SELECT lane_id, carrier_tier, {OTP} AS otp FROM s GROUP BY lane_id, carrier_tier HAVING COUNT(*) >= 30)",
    ),
    "q32_chi_square": _q(
        f"""{_text(hypothesis.CHI_NAME)} AS test_name, ROUND(SUM(x), 3) AS chi_square_statistic,
        (COUNT(*) / 2 - 1)::INTEGER AS degrees_of_freedom, 7.815::DOUBLE AS critical_value_alpha_05,
        CASE WHEN SUM(x) > 7.815 THEN {_text(hypothesis.CHI_REJECT)} ELSE {_text(hypothesis.CHI_KEEP)} END AS conclusion""",
        """FROM (SELECT POWER(o - r::DOUBLE * c / t, 2) / (r::DOUBLE * c / t) AS x FROM (
             SELECT n AS o, SUM(n) OVER (PARTITION BY carrier_tier) AS r, SUM(n) OVER (PARTITION BY defect_flag) AS c,
               SUM(n) OVER () AS t FROM (SELECT carrier_tier, defect_flag, COUNT(*) AS n FROM s GROUP BY ALL)))""",
    ),
    "q33_mann_whitney": _q(
        f"""n1 AS q4_sample_size, n2 AS nonq4_sample_size, ROUND(m1, 2) AS q4_avg_cpm, ROUND(m2, 2) AS nonq4_avg_cpm,
        ROUND(u, 0) AS u_statistic, ROUND(z, 3) AS z_score, 1.96::DOUBLE AS critical_value_alpha_05,
        CASE WHEN ABS(z) > 1.96 THEN {_text(hypothesis.RANK_REJECT)} ELSE {_text(hypothesis.RANK_KEEP)} END AS conclusion""",
        """FROM (SELECT *, (u - n1::DOUBLE * n2 / 2) / SQRT(n1::DOUBLE * n2 * (n1 + n2 + 1) / 12) AS z FROM (
             SELECT *, r1::DOUBLE - n1::DOUBLE * (n1 + 1) / 2 AS u FROM (
               SELECT COUNT(*) FILTER (WHERE q4) AS n1, COUNT(*) FILTER (WHERE NOT q4) AS n2,
                 AVG(cpm) FILTER (WHERE q4) AS m1, AVG(cpm) FILTER (WHERE NOT q4) AS m2, SUM(r) FILTER (WHERE q4) AS r1
               FROM (SELECT month >= 10 AS q4, cpm, RANK() OVER (ORDER BY cpm) AS r FROM s WHERE distance_miles > 0))))""",
    ),
    "q34_null_audit": _q(
        """column_name, null_count, total_rows, ROUND(null_count::DOUBLE / total_rows * 100, 3) AS null_pct""",
        """FROM (SELECT 'pickup_actual_ts' AS column_name, COUNT(*) - COUNT(pickup_actual_ts) AS null_count, COUNT(*) AS total_rows FROM fact
          UNION ALL SELECT 'delivery_actual_ts', COUNT(*) - COUNT(delivery_actual_ts), COUNT(*) FROM fact
          UNION ALL SELECT 'defect_reason', COUNT(*) - COUNT(defect_reason), COUNT(*) FROM fact)""",
    ),
    "q35_negative_dwell_audit": _q(
        f"""COUNT(*) FILTER (WHERE dwell_minutes < 0) AS negative_dwell_count, COUNT(*) AS total_shipments,
        {_pct("COUNT(*) FILTER (WHERE dwell_minutes < 0)::DOUBLE / COUNT(*)", 3)} AS negative_dwell_pct,
        ROUND(MIN(dwell_minutes) FILTER (WHERE dwell_minutes < 0), 1) AS most_negative_minutes,
        ROUND(AVG(dwell_minutes) FILTER (WHERE dwell_minutes < 0), 1) AS avg_negative_minutes,
        {_text(network.EARLY_ARRIVAL_NOTE)} AS handling_note""",
        "FROM s",
    ),
    # ---- views and KPI tables
    "v_carrier_scorecard": _q(
        f"""carrier_id, carrier_name, carrier_tier, equipment_type, contract_type, carrier_target AS target_otp_pct,
        COUNT(*) AS shipment_count, {OTP} AS otp_rate, {OTD} AS otd_rate, {_p(0.5)} AS dwell_p50, {_p(0.9)} AS dwell_p90,
        {DEFECT} AS defect_rate, {UTIL} AS avg_utilization, {CPM} AS avg_cost_per_mile,
        {COST} AS avg_cost_per_shipment, {TOTAL} AS total_cost""",
        "FROM s GROUP BY carrier_id, carrier_name, carrier_tier, equipment_type, contract_type, carrier_target",
    ),
    "v_lane_performance": _q(
        f"""lane_id, origin_city, origin_state, dest_fc_id, lane_miles AS distance_miles, lane_type,
        COUNT(*) AS shipment_count, {OTP} AS otp_rate, {OTD} AS otd_rate, {DWELL} AS avg_dwell_minutes,
        {DEFECT} AS defect_rate, {UTIL} AS avg_utilization, {COST} AS avg_cost_per_shipment,
        {CPM} AS avg_cost_per_mile, {TOTAL} AS total_cost""",
        "FROM s GROUP BY lane_id, origin_city, origin_state, dest_fc_id, lane_miles, lane_type",
    ),
    "v_weekly_kpis": _weekly_view("year"),
    "v_weekly_kpis_iso": _weekly_view("iso_year"),
    "v_shipper_costtoserve": _q(
        f"""shipper_id, shipper_name, vendor_type, ship_volume_tier, COUNT(*) AS shipment_count, {TOTAL} AS total_cost,
        {COST} AS avg_cost_per_shipment, {CPM} AS avg_cost_per_mile, {CPP} AS avg_cost_per_pallet,
        {ACC_SHARE} AS accessorial_share, {OTD} AS otd_rate, {DEFECT} AS defect_rate""",
        "FROM s GROUP BY shipper_id, shipper_name, vendor_type, ship_volume_tier",
    ),
    "v_shipper_health": _q(
        """shipper_id, shipper_name, vendor_type, ship_volume_tier, industry_segment, total_shipments, otd_rate,
        defect_free_rate, avg_cost_per_shipment, vol_last_90d, vol_prior_90d, growth_rate, service_score, cost_score,
        growth_score, reliability_score, tenure_score, shipper_health_score""",
        "FROM health",
        _HEALTH,
    ),
    "v_anomaly_flags": _q("*", "FROM flagged", _FLAGS),
    "network_kpis": _q(
        f"""COUNT(*) AS total_shipments, {_pct(OTP)} AS otp_pct, {_pct(OTD)} AS otd_pct, {_round(DWELL, 1)} AS avg_dwell,
        {_pct(DEFECT, 2)} AS defect_rate_pct, {_pct(UTIL)} AS avg_utilization_pct,
        {_round(COST, 2)} AS avg_cost_per_shipment, {_round(CPM, 2)} AS avg_cpm, {_round(TOTAL, 0)} AS total_cost""",
        "FROM s",
    ),
    "network_kpis_known_pickup": _q(
        f"""COUNT(*) AS total_shipments,
        {_pct("COUNT(*) FILTER (WHERE on_time_pickup AND pickup_actual_ts IS NOT NULL)::DOUBLE / COUNT(pickup_actual_ts)")} AS otp_pct,
        {_pct(OTD)} AS otd_pct, {_round(DWELL, 1)} AS avg_dwell,
        {_pct(DEFECT, 2)} AS defect_rate_pct, {_pct(UTIL)} AS avg_utilization_pct,
        {_round(COST, 2)} AS avg_cost_per_shipment, {_round(CPM, 2)} AS avg_cpm, {_round(TOTAL, 0)} AS total_cost""",
        "FROM s",
    ),
    "export_kpi_tables": _q(
        "*",
        """FROM (SELECT 'weekly_kpis' AS table_name, COUNT(DISTINCT (year, week_of_year)) AS row_count FROM s
          UNION ALL SELECT 'carrier_scorecard', COUNT(DISTINCT carrier_id) FROM s
          UNION ALL SELECT 'lane_performance', COUNT(DISTINCT lane_id) FROM s
          UNION ALL SELECT 'shipper_health', COUNT(DISTINCT shipper_id) FROM s)""",
    ),
    "mom_cost_change": _q(
        """year, month, total_cost, prev AS prev_month_cost, ROUND((total_cost - prev) / prev * 100, 9) AS mom_change_pct""",
        f"""FROM (SELECT year, month, {TOTAL} AS total_cost, LAG({TOTAL}) OVER (ORDER BY year, month) AS prev
             FROM s GROUP BY year, month)""",
    ),
    "bi_extract_60d": _q(
        """shipment_id, date, carrier_name, carrier_tier, origin_city, origin_state, dest_fc_id, lane_type, shipper_name,
        vendor_type, service_name, on_time_pickup, on_time_delivery, dwell_minutes, defect_flag, defect_reason,
        trailer_utilization_pct, distance_miles, total_cost_usd, cpm AS cost_per_mile""",
        f"FROM s WHERE {_since(60)}",
    ),
    "derive_on_time": _q(
        """pickup AS on_time_pickup, delivery AS on_time_delivery, COUNT(*) AS shipments,
        COUNT(*) FILTER (WHERE pickup <> on_time_pickup) AS pickup_differs,
        COUNT(*) FILTER (WHERE delivery <> on_time_delivery) AS delivery_differs""",
        """FROM (SELECT on_time_pickup, on_time_delivery,
             pickup_actual_ts <= pickup_appt_ts + INTERVAL 15 MINUTE AS pickup,
             delivery_actual_ts <= delivery_appt_ts + INTERVAL 15 MINUTE AS delivery FROM fact)
        GROUP BY pickup, delivery""",
    ),
    "dim_date": _q(
        """date_key, date, year, quarter, month, week_of_year, day_of_week, is_weekend, is_holiday, is_peak_season,
        (SELECT COUNT(*) FROM fact WHERE shipment_date_key = date_key) AS shipments""",
        "FROM cal",
    ),
    "classify_lane": _q(
        """CASE WHEN distance_miles <= 500 THEN 'Short' WHEN distance_miles <= 1500 THEN 'Mid' ELSE 'Long' END AS haul,
        COUNT(*) AS shipments, MIN(distance_miles) AS min_miles, MAX(distance_miles) AS max_miles""",
        "FROM fact GROUP BY haul",
    ),
    "classify_shipper_tier": _q(
        """shipper_id, n AS shipment_count,
        CASE WHEN r <= 20 THEN 'Top20' WHEN r <= 100 THEN 'Mid' ELSE 'LongTail' END AS volume_tier""",
        """FROM (SELECT shipper_id, COUNT(*) AS n, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, shipper_id) AS r
             FROM fact GROUP BY shipper_id)""",
    ),
    "global_rank": _q(
        f"carrier_id, {TOTAL} AS total_cost, RANK() OVER (ORDER BY SUM(total_cost_usd) DESC) AS cost_rank",
        "FROM fact GROUP BY carrier_id",
    ),
    "table_row_counts": _table_counts(),
    # ---- anomalies, pricing, forecasts
    "zscore_otp_anomalies": _q("*", "FROM zscores", _zscore_ctes("year", "reference")),
    "zscore_otp_anomalies_iso": _q(
        "*", "FROM zscores", _zscore_ctes("iso_year", "reference")
    ),
    "anomaly_reason_hints_share": _q("*", "FROM zscores", _zscore_ctes("year", "share")),
    "iqr_cost_anomalies": _q("*", "FROM iqr", _IQR),
    "anomaly_count_14d": _q(
        "*",
        f"""FROM (SELECT 'zscore' AS detector, COUNT(*) AS anomaly_count FROM zscores WHERE week_start >= {AS_OF} - 14
          UNION ALL SELECT 'iqr', COUNT(*) FROM iqr WHERE {_since(14)})""",
        _zscore_ctes("year", "reference") + ", " + _IQR,
    ),
    "briefing_rows": _q(
        "*",
        f"""FROM (SELECT 'headline' AS section, 'network OTP %' AS subject, {AS_OF} AS day, {_pct(OTP)} AS value,
            90.0::DOUBLE AS against, NULL::DOUBLE AS score, NULL::VARCHAR AS note FROM s WHERE {_since(7)}
          UNION ALL SELECT 'headline', 'average cost per shipment', {AS_OF}, {_round(COST, 0)}, NULL, NULL, NULL FROM s WHERE {_since(7)}
          UNION ALL SELECT 'zscore', {LANE}, week_start, otp_observed, otp_expected, z_score, reason_hint
            FROM (SELECT * FROM zscores ORDER BY week_start DESC, lane_id LIMIT 10) JOIN lane_dim USING (lane_id)
          UNION ALL SELECT 'iqr', carrier_name, date, daily_cpm, upper_fence, excess_pct, lane_type
            FROM (SELECT * FROM iqr ORDER BY date DESC, carrier_id, lane_type LIMIT 5))""",
        _zscore_ctes("year", "reference") + ", " + _IQR,
    ),
    "pricing_recommendations": _q("*", "FROM recs", _PRICING),
    "whatif_bootstrap_ci": _q(
        """p.lane_id, p.carrier_id, prim.carrier_id AS current_carrier_id, ROUND(otp_mean, 9) AS otp_mean,
        ROUND(otp_low, 9) AS otp_low, ROUND(otp_high, 9) AS otp_high, ROUND(otp_mean - prim.otp, 9) AS otp_delta_pp,
        ROUND(cost_mean, 9) AS cost_mean, ROUND(cost_low, 9) AS cost_low, ROUND(cost_high, 9) AS cost_high,
        ROUND(cost_mean - prim.avg_cost, 9) AS cost_delta""",
        "FROM pairs p JOIN boot USING (carrier_id) JOIN prim ON p.lane_id = prim.lane_id",
        _PRIMARY + ", " + _BOOT,
    ),
    "lane_primary_carrier": _q("*", "FROM prim", _PRIMARY),
    "otp_weekly_series": _q("*", f"FROM ({_otp_series('')})"),
    "cost_daily_series": _q("*", f"FROM ({_cost_series('')})"),
    "forecast_otp": _forecast(
        _otp_series(""), "", "week_start", "otp", 4, 4, 20, _OTP_NAMES
    ),
    "forecast_cost": _forecast(
        _cost_series(""), "", "date", "daily_cost", 7, 28, 30, _COST_NAMES
    ),
    "forecast_otp_by_lane": _forecast(
        _otp_series("lane_id"), "lane_id", "week_start", "otp", 4, 4, 20, _OTP_NAMES
    ),
    "forecast_cost_by_carrier": _forecast(
        _cost_series("carrier_id"), "carrier_id", "date", "daily_cost", 7, 28, 30, _COST_NAMES
    ),
    # ---- data quality
    "dq_row_count": _check("row_count", "COUNT(*)", "COUNT(*) >= 1000000"),
    "dq_distinct_lanes": _check(
        "distinct_lanes", "COUNT(DISTINCT lane_id)", "COUNT(DISTINCT lane_id) >= 200", "lane_dim"
    ),
    "dq_fk_orphans": _orphans(),
    "dq_cost_identity": _check(
        "cost_identity",
        "COUNT(*) FILTER (WHERE linehaul_cost_usd + fuel_surcharge_usd + accessorial_cost_usd <> total_cost_usd)",
        "COUNT(*) FILTER (WHERE linehaul_cost_usd + fuel_surcharge_usd + accessorial_cost_usd <> total_cost_usd) = 0",
    ),
    "dq_null_pickup": _check("null_pickup", "COUNT(*) - COUNT(pickup_actual_ts)", "TRUE"),
    "dq_negative_dwell": _check(
        "negative_dwell", "COUNT(*) FILTER (WHERE dwell_minutes < 0)", "TRUE"
    ),
    "dq_top20_concentration": _check(
        "top20_concentration",
        "SUM(n) / (SELECT COUNT(*) FROM fact)",
        "SUM(n) / (SELECT COUNT(*) FROM fact) >= 0.5",
        "(SELECT shipper_id, COUNT(*)::DOUBLE AS n FROM fact GROUP BY shipper_id ORDER BY n DESC LIMIT 20)",
    ),
    "dq_pk_unique": _pk_unique(),
    "dq_not_null": _not_null(),
    "dq_domain": _q(
        "*",
        """FROM (SELECT 'carrier_tiers' AS check_name, COUNT(DISTINCT carrier_tier)::DOUBLE AS value,
            list_sort(array_agg(DISTINCT carrier_tier)) = ['Core', 'Spot', 'Strategic', 'Tactical'] AS passed FROM carrier
          UNION ALL SELECT 'service_names', COUNT(DISTINCT service_name)::DOUBLE,
            list_sort(array_agg(DISTINCT service_name)) = ['FTL', 'Intermodal', 'LTL'] FROM s)""",
    ),
    # ---- report tables
    "report_kpi_snapshot": _q(
        f"""COUNT(*) AS shipments, {_pct(OTP)} AS otp, {_pct(DEFECT, 2)} AS defect, {_round(COST, 2)} AS avg_cost,
        {_round(DWELL, 1)} AS avg_dwell""",
        "FROM s",
    ),
    "report_carrier_month": _q(
        f"""carrier_name, carrier_tier, month, {_pct(OTP)} AS otp_pct, {_pct(DEFECT, 2)} AS defect_pct,
        {_round(CPM, 2)} AS cpm""",
        "FROM s GROUP BY carrier_name, carrier_tier, month",
    ),
    "report_lane_heatmap": _q(
        """*, CASE WHEN otp_pct >= 90 THEN 'green' WHEN otp_pct >= 80 THEN 'yellow' ELSE 'red' END AS band""",
        f"""FROM (SELECT origin_city, dest_fc_id, {_pct(OTP)} AS otp_pct, COUNT(*) AS volume
             FROM s GROUP BY origin_city, dest_fc_id)""",
    ),
    "report_shipper_service_cts": _q(
        f"""shipper_name, ship_volume_tier, service_name, {TOTAL} AS total_cost, COUNT(*) AS shipment_count,
        {_round(COST, 2)} AS cps""",
        "FROM s WHERE ship_volume_tier = 'Top20' GROUP BY shipper_name, ship_volume_tier, service_name",
    ),
    "report_accessorial_drivers": _q(
        """COALESCE(defect_reason, 'Standard') AS reason, month, SUM(accessorial_cost_usd)::DOUBLE AS total_accessorial,
        COUNT(*) AS shipment_count""",
        "FROM s GROUP BY reason, month",
    ),
    "report_daily_trend": _q(
        f"""date, COUNT(*) AS shipments, {_pct(OTP)} AS otp_pct, {_pct(DEFECT, 2)} AS defect_pct,
        {_round(COST, 2)} AS avg_cost, {_round(DWELL, 1)} AS avg_dwell""",
        "FROM s GROUP BY date ORDER BY date DESC LIMIT 90",
    ),
    # ---- dashboard datasets
    "exec_kpi_period_delta": _period_delta(),
    "exec_weekly_otp_26": _q(
        "week_start, otp * 100 AS otp_pct",
        "FROM w ORDER BY year DESC, week_of_year DESC LIMIT 26",
        _weekly("year"),
    ),
    "exec_top_issues": _summary(
        "carrier_name, carrier_tier, lane_label, avg_otp_pct AS avg_otp, total_volume AS volume", 5
    ),
    "health_filtered": _q(
        """h.shipper_id, h.shipper_name, h.vendor_type, ship_volume_tier, total_shipments, h.otd_rate,
        h.avg_cost_per_shipment, h.growth_rate, service_score, cost_score, growth_score, reliability_score,
        shipper_health_score, recommendation, pct_change, driver_1""",
        """FROM (SELECT * FROM health WHERE vendor_type = 'Brand' ORDER BY shipper_health_score DESC, shipper_id LIMIT 50) h
        LEFT JOIN recs ON h.shipper_id = recs.shipper_id""",
        _HEALTH + ", " + _PRICING,
    ),
    "lane_otp_pivot": _q(
        "origin_city AS origin, "
        + ", ".join(
            f"""ROUND(COUNT(*) FILTER (WHERE on_time_pickup AND dest_fc_id = 'FC{i}')::DOUBLE
            / NULLIF(COUNT(*) FILTER (WHERE dest_fc_id = 'FC{i}'), 0) * 100, 1) AS FC{i}"""
            for i in range(5)
        ),
        "FROM s GROUP BY origin_city",
    ),
    "lane_otp_long": _q(
        f"origin_city AS origin, dest_fc_id, {_pct(OTP)} AS otp", "FROM s GROUP BY origin_city, dest_fc_id"
    ),
    "lane_best_worst_10": _q(
        "side, origin_city, dest_fc_id, shipment_count, otp_rate, avg_cost_per_mile",
        """FROM (SELECT 'best' AS side, * FROM (SELECT * FROM lp ORDER BY otp_rate DESC, shipment_count DESC, lane_id LIMIT 10)
          UNION ALL SELECT 'worst', * FROM (SELECT * FROM lp ORDER BY otp_rate, shipment_count DESC, lane_id LIMIT 10))""",
        f"""lp AS (SELECT lane_id, origin_city, dest_fc_id, COUNT(*) AS shipment_count, {OTP} AS otp_rate,
          {CPM} AS avg_cost_per_mile FROM s GROUP BY lane_id, origin_city, dest_fc_id)""",
    ),
    "carrier_filtered": _q(
        f"""carrier_name, carrier_tier, COUNT(*) AS shipment_count, {OTP} AS otp_rate, {OTD} AS otd_rate,
        {_p(0.9)} AS dwell_p90, {DEFECT} AS defect_rate, {CPM} AS avg_cost_per_mile""",
        "FROM s WHERE carrier_tier = 'Spot' GROUP BY carrier_id, carrier_name, carrier_tier",
    ),
    "carrier_lane_mix": _q(
        f"""carrier_name, {LANE} AS lane, COUNT(*) AS volume, {_pct(OTP)} AS otp_pct, {_round(CPM, 2)} AS cpm""",
        """FROM s GROUP BY carrier_name, lane
        QUALIFY ROW_NUMBER() OVER (PARTITION BY carrier_name ORDER BY volume DESC, lane) <= 15""",
    ),
    "carrier_defects": _q(
        "carrier_name, defect_reason, COUNT(*) AS defect_count",
        "FROM s WHERE defect_flag GROUP BY carrier_name, defect_reason",
    ),
    "anomalies_filtered": _q(
        "*",
        "FROM zscores WHERE severity = 'HIGH' ORDER BY week_start DESC, lane_id LIMIT 50",
        _zscore_ctes("year", "reference"),
    ),
    "cost_anomalies_filtered": _q(
        "*",
        "FROM iqr WHERE lane_type = 'Long' ORDER BY date DESC, carrier_id, lane_type LIMIT 50",
        _IQR,
    ),
    "whatif_lanes_top50": _q(
        f"lane_id, {LANE} AS lane_label, COUNT(*) AS shipment_count",
        "FROM s GROUP BY lane_id, lane_label ORDER BY shipment_count DESC, lane_id LIMIT 50",
    ),
    "tier_overview": _q(
        f"""carrier_tier, COUNT(*) AS shipments, {_pct(OTP)} AS otp_pct, {_pct(DEFECT, 2)} AS defect_pct,
        {_round(CPM, 2)} AS cost_per_mile""",
        "FROM s GROUP BY carrier_tier",
    ),
    "filter_values": _q(
        "*",
        """FROM (SELECT DISTINCT 'vendor_type' AS field, vendor_type AS value FROM shipper
          UNION ALL SELECT DISTINCT 'ship_volume_tier', ship_volume_tier FROM shipper
          UNION ALL SELECT DISTINCT 'industry_segment', industry_segment FROM shipper)""",
    ),
    "anomaly_window_otp": _q(
        "AVG(on_time_pickup::INTEGER) AS otp",
        "FROM s WHERE carrier_tier = 'Spot' AND lane_id IN (1, 2, 3)",
    ),
}


#: Tables that are written, read back and compared in full.
SINKS = (
    "v_weekly_kpis",
    "v_carrier_scorecard",
    "v_lane_performance",
    "v_shipper_health",
    "zscore_otp_anomalies",
    "iqr_cost_anomalies",
    "pricing_recommendations",
    "forecast_otp",
    "forecast_cost",
    "bi_extract_60d",
)
PAST = "DATE '2024-08-18'"
#: Queries that look back from a day, and so are also asked in the middle of the year.
DATED = (
    "q28_carriers_otp_decline",
    "q29_lanes_dwell_spike",
    "q30_anomaly_summary_14d",
    "v_shipper_health",
    "v_anomaly_flags",
    "bi_extract_60d",
    "anomaly_count_14d",
    "briefing_rows",
    "pricing_recommendations",
    "exec_kpi_period_delta",
    "exec_top_issues",
    "health_filtered",
    "forecast_otp",
    "forecast_cost",
    "forecast_otp_by_lane",
    "forecast_cost_by_carrier",
)


def at_past(sql: str) -> str:
    """The same question asked on an earlier day, when nothing later had shipped."""
    bounded = sql.replace("  FROM flags\n), s AS", f"  FROM flags WHERE ship_date <= {PAST}\n), s AS")
    assert bounded != sql
    return bounded.replace(AS_OF, PAST)


ORACLE_SQL["dq_report"] = " UNION ALL ".join(
    f"SELECT check_name, value, passed FROM ({ORACLE_SQL[name]})"
    for name in (
        "dq_row_count",
        "dq_distinct_lanes",
        "dq_fk_orphans",
        "dq_cost_identity",
        "dq_null_pickup",
        "dq_negative_dwell",
        "dq_top20_concentration",
    )
)
ORACLE_SQL |= {f"{name}_past": at_past(ORACLE_SQL[name]) for name in DATED}
ORACLE_SQL |= {f"sink_{name}": ORACLE_SQL[name] for name in SINKS}

#: The same answers from a warehouse that got one day late, and from its stored parts.
GROWN = ("v_weekly_kpis", "v_carrier_scorecard", "v_lane_performance", "v_shipper_costtoserve", "network_kpis")
ORACLE_SQL |= {f"grown_{name}": ORACLE_SQL[name] for name in GROWN}
ORACLE_SQL["grown_months"] = _q(
    f"""(year(date) * 100 + month(date))::INTEGER AS month, COUNT(*) AS shipments, {TOTAL} AS total_cost,
    COUNT(DISTINCT date) AS days""",
    "FROM s GROUP BY 1",
)
ORACLE_SQL["approx_dwell_ranks"] = _q(
    "carrier_id, COUNT(dwell)::BIGINT AS shipments, TRUE AS within_bound",
    "FROM s WHERE dwell IS NOT NULL GROUP BY carrier_id",
)
_ACTIVE = """COUNT(*) AS shipment_count, COUNT(DISTINCT carrier_id) AS active_carriers,
    COUNT(DISTINCT lane_id) AS active_lanes, COUNT(DISTINCT shipper_id) AS active_shippers"""
_LEVELS = {
    "day": ("date",),
    "week": ("iso_year", "week_of_year"),
    "month": ("year", "month"),
    "year": ("year",),
    "network": (),
}
ORACLE_SQL |= {
    f"active_parties_{level}": _q(
        ", ".join([*keys, _ACTIVE]), "FROM s" + (f" GROUP BY {', '.join(keys)}" if keys else "")
    )
    for level, keys in _LEVELS.items()
}


def _table_sums() -> str:
    sums = {"fact_shipment": "total_cost_usd"}
    parts = [
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count, SUM({sums.get(name, key)})::DOUBLE AS total FROM {cte}"
        for name, (cte, key) in _DIMS.items()
    ]
    return f"{STAR}\n" + " UNION ALL ".join(parts)


ORACLE_SQL["csv_star_loaded"] = _table_sums()
ORACLE_SQL["csv_star_rejects"] = f"""{STAR}
SELECT 'fact_shipment' AS table_name,
  CASE lane_id WHEN 1 THEN 'carrier_id' WHEN 2 THEN 'total_cost_usd' WHEN 3 THEN 'pickup_appt_ts' ELSE '' END AS column_name,
  CASE lane_id WHEN 1 THEN 'not a bigint' WHEN 2 THEN 'missing' WHEN 3 THEN 'not a timestamp_ntz' ELSE 'kept' END AS reason,
  COUNT(*) AS shipments
FROM fact GROUP BY ALL"""
ORACLE_SQL["zscore_carried"] = _q(
    "lane_id, week_start, year, week_of_year, otp_observed, otp_expected, z_score, severity",
    "FROM zscores WHERE week_start > DATE '2024-08-18'",
    _zscore_ctes("iso_year", "reference"),
)
