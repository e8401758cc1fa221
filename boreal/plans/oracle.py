"""DuckDB SQL answering each bound job independently (row-by-row formulas, no pre-aggregation).

Tables are the pre-registered views ``region nation customer supplier part orders lineitem ...``.
Column names and types follow the Spark results (integers cast to INTEGER/BIGINT, no DECIMAL).
"""

from __future__ import annotations

import datetime as dt

from boreal.functions.geo import EARTH_RADIUS_KM
from boreal.operators.forecast import (
    FORECAST_HOURS,
    H_DATE,
    H_DISTANCE,
    H_TIME,
    LOOKBACK_DAYS,
)
from boreal.plans import bindings as B


def _d(x: dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


def _period(lo: int, hi: int, col: str = "l_shipdate") -> str:
    return f"{col} >= {_d(dt.date(lo, 1, 1))} AND {col} < {_d(dt.date(hi + 1, 1, 1))}"


Y = "CAST(year(l_shipdate) AS INTEGER)"
M = "CAST(month(l_shipdate) AS INTEGER)"
P = _period(*B.PERIOD)
def _readings(target: dt.date) -> str:
    start = target - dt.timedelta(days=LOOKBACK_DAYS)
    return f"""
  SELECT l_suppkey AS station, l_shipdate AS date, CAST(l_orderkey % 24 AS INTEGER) AS hour,
         l_quantity AS value
  FROM lineitem
  WHERE l_shipdate < {_d(target)} AND l_shipdate >= {_d(start)}"""


READINGS = _readings(B.TARGET_DATE)

STATIONS = """
  SELECT s_suppkey AS station,
         CAST(55.0 AS DOUBLE) + CAST(0.2 AS DOUBLE) * CAST(s_suppkey % 50 AS DOUBLE) AS lat,
         CAST(11.0 AS DOUBLE) + CAST(0.3 AS DOUBLE) * CAST(s_suppkey % 37 AS DOUBLE) AS lon
  FROM supplier"""

_TLAT, _TLON = f"CAST({B.TARGET_LAT} AS DOUBLE)", f"CAST({B.TARGET_LON} AS DOUBLE)"
KM = (f"2 * {EARTH_RADIUS_KM} * asin(sqrt(pow(sin(radians({_TLAT} - lat) / 2), 2) + "
      f"cos(radians(lat)) * cos(radians({_TLAT})) * pow(sin(radians({_TLON} - lon) / 2), 2)))")

LEAP = "((year(date) % 4 = 0 AND year(date) % 100 <> 0) OR year(date) % 400 = 0)"


def _raw_days(target: dt.date) -> str:
    # the target's month and day moved into the reading's year (these targets exist every year)
    return f"abs(dayofyear(date) - dayofyear(make_date(year(date), {target.month}, {target.day})))"


def _day_distance(target: dt.date) -> str:
    raw = _raw_days(target)
    return (f"CAST(CASE WHEN {LEAP} THEN least({raw}, 366 - {raw}) "
            f"ELSE least({raw}, 365 - {raw}) END AS INTEGER)")


def _day_distance_recorded(target: dt.date) -> str:
    raw = _raw_days(target)
    return (f"CAST(CASE WHEN {LEAP} THEN {raw} "
            f"WHEN {raw} < 182 THEN {raw} ELSE 365 - {raw} END AS INTEGER)")


DAY_DIST = _day_distance(B.TARGET_DATE)


def _hour_dist(a: str, b: str) -> str:
    return f"(CASE WHEN abs({a} - {b}) <= 12 THEN abs({a} - {b}) ELSE 24 - abs({a} - {b}) END)"


HOURS = ", ".join(f"({h})" for h in FORECAST_HOURS)


def _km(lat: str, lon: str) -> str:
    return (f"2 * {EARTH_RADIUS_KM} * asin(sqrt(pow(sin(radians({lat} - lat) / 2), 2) + "
            f"cos(radians(lat)) * cos(radians({lat})) * pow(sin(radians({lon} - lon) / 2), 2)))")


#: Day of year of the target's month and day in a reading's year: the targets are all on a 15th.
_TARGET_DAYS = "abs(dayofyear(date) - dayofyear(make_date(year(date), month(t.tdate), day(t.tdate))))"
TARGET_FORECASTS = f"""
WITH t AS (
  SELECT c_custkey AS target, CAST(55.1 AS DOUBLE) + CAST(0.25 AS DOUBLE) * CAST(c_custkey % 40 AS DOUBLE) AS tlat,
         CAST(11.2 AS DOUBLE) + CAST(0.35 AS DOUBLE) * CAST(c_custkey % 31 AS DOUBLE) AS tlon,
         make_date({B.TARGET_YEAR}, c_custkey % 4 * 3 + 1, 15) AS tdate, CAST(c_custkey % 24 AS INTEGER) AS th FROM customer),
s AS ({STATIONS}),
r AS (SELECT l_suppkey AS station, CAST(l_shipdate AS DATE) AS date, l_orderkey % 24 AS hour, l_quantity AS value FROM lineitem),
w AS (SELECT target, station, exp(-(km * km) / {B.TARGET_H_DISTANCE}) AS kd
      FROM (SELECT target, station, {_km("t.tlat", "t.tlon")} AS km FROM t, s)),
x AS (SELECT t.target, value, kd, exp(-(dd * dd) / {H_DATE}) AS ky, exp(-(hd * hd) / {H_TIME}) AS kt
      FROM (SELECT t.target, r.station, r.value,
                   CASE WHEN {LEAP} THEN least({_TARGET_DAYS}, 366 - {_TARGET_DAYS}) ELSE least({_TARGET_DAYS}, 365 - {_TARGET_DAYS}) END AS dd,
                   least(abs(r.hour - t.th), 24 - abs(r.hour - t.th)) AS hd
            FROM t JOIN r ON r.date < t.tdate AND r.date >= t.tdate - {LOOKBACK_DAYS}) t JOIN w ON w.target = t.target AND w.station = t.station)
SELECT t.target, CAST(t.tdate AS VARCHAR) AS date, t.th AS hour, round(sum((kd + ky + kt) * value) / sum(kd + ky + kt), 6) AS forecast_sum,
       round(sum(kd * ky * kt * value) / nullif(sum(kd * ky * kt), 0), 6) AS forecast_prod
FROM t LEFT JOIN x ON x.target = t.target GROUP BY t.target, t.tdate, t.th"""


def _forecast_sql(day_distance: str, readings: str) -> str:
    return f"""
WITH r AS ({readings}),
w AS (SELECT station, exp(-(km * km) / {H_DISTANCE}) AS kd
      FROM (SELECT station, {KM} AS km FROM ({STATIONS}))),
rd AS (SELECT r.value, r.hour, w.kd, {day_distance} AS dd FROM r JOIN w USING (station)),
h AS (SELECT * FROM (VALUES {HOURS}) t(th)),
x AS (SELECT th, value, kd, exp(-(dd * dd) / {H_DATE}) AS ky,
             exp(-({_hour_dist('hour', 'th')} * {_hour_dist('hour', 'th')}) / {H_TIME}) AS kt
      FROM rd CROSS JOIN h),
f AS (SELECT CAST(th AS INTEGER) AS hour,
             sum((kd + ky + kt) * value) / sum(kd + ky + kt) AS forecast_sum,
             sum(kd * ky * kt * value) / sum(kd * ky * kt) AS forecast_prod
      FROM x GROUP BY th)"""


FORECAST = _forecast_sql(DAY_DIST, READINGS)
FORECAST_RECORDED = _forecast_sql(_day_distance_recorded(B.WINTER_TARGET_DATE),
                                  _readings(B.WINTER_TARGET_DATE))

LARGE_EARLY = (f"SELECT DISTINCT l_partkey FROM lineitem WHERE l_quantity > {B.LARGE_QUANTITY} "
               f"AND l_shipdate < TIMESTAMP '{B.EARLY}'")

ORACLE_SQL = {
    # ------------------------------------------------------------ readings
    "yearly_extrema": f"""
SELECT {Y} AS year, min(l_extendedprice) AS min_value, max(l_extendedprice) AS max_value
FROM lineitem WHERE {P} GROUP BY 1 ORDER BY 1""",
    "yearly_argmax": f"""
SELECT {Y} AS year, max(l_extendedprice) AS max_value,
       arg_max(l_suppkey, row(l_extendedprice, l_suppkey)) AS station
FROM lineitem WHERE {P} AND l_extendedprice IS NOT NULL GROUP BY 1""",
    "monthly_exceedance_count": f"""
SELECT {Y} AS year, {M} AS month, count(l_suppkey) AS n_readings
FROM lineitem WHERE {P} AND l_quantity > {B.THRESHOLD} GROUP BY 1, 2""",
    "monthly_exceedance_station_count": f"""
SELECT {Y} AS year, {M} AS month, count(DISTINCT l_suppkey) AS n_stations
FROM lineitem WHERE {P} AND l_quantity > {B.THRESHOLD} GROUP BY 1, 2""",
    "station_monthly_mean": f"""
SELECT l_suppkey AS station, {Y} AS year, {M} AS month, round(avg(l_extendedprice), 6) AS mean_value
FROM lineitem WHERE {_period(*B.MEAN_PERIOD)} GROUP BY 1, 2, 3""",
    "station_monthly_mean_sumcount": f"""
SELECT l_suppkey AS station, {Y} AS year, {M} AS month, round(avg(l_extendedprice), 6) AS mean_value
FROM lineitem WHERE {_period(*B.MEAN_PERIOD)} GROUP BY 1, 2, 3""",
    "extremes_band_join": f"""
WITH t AS (SELECT l_suppkey AS station, max(l_extendedprice) AS max_temperature FROM lineitem
           GROUP BY 1 HAVING max(l_extendedprice) BETWEEN {B.TEMP_BAND[0]} AND {B.TEMP_BAND[1]}),
d AS (SELECT l_suppkey AS station, CAST(l_shipdate AS DATE) AS day, sum(l_quantity) AS daily
      FROM lineitem GROUP BY 1, 2),
p AS (SELECT station, max(daily) AS max_daily_precipitation FROM d GROUP BY 1
      HAVING max(daily) BETWEEN {B.DAILY_BAND[0]} AND {B.DAILY_BAND[1]})
SELECT t.station, t.max_temperature, p.max_daily_precipitation FROM t JOIN p USING (station)""",
    "extremes_prefilter_join": f"""
WITH a AS (SELECT l_suppkey AS station, l_extendedprice AS t FROM lineitem
           WHERE l_extendedprice BETWEEN {B.PREFILTER_TEMP_BAND[0]} AND {B.PREFILTER_TEMP_BAND[1]}),
b AS (SELECT l_suppkey AS station, l_quantity AS p FROM lineitem
      WHERE l_quantity BETWEEN {B.PREFILTER_PRECIP_BAND[0]} AND {B.PREFILTER_PRECIP_BAND[1]})
SELECT a.station, max(a.t) AS max_temperature, max(b.p) AS max_precipitation
FROM a JOIN b ON a.station = b.station GROUP BY a.station""",
    "extremes_total_band_join": f"""
WITH t AS (SELECT l_suppkey AS station, max(l_extendedprice) AS max_temperature FROM lineitem
           GROUP BY 1 HAVING max(l_extendedprice) BETWEEN {B.TEMP_BAND[0]} AND {B.TEMP_BAND[1]}),
p AS (SELECT l_suppkey AS station, sum(l_quantity) AS total_precipitation FROM lineitem GROUP BY 1
      HAVING sum(l_quantity) BETWEEN {B.TOTAL_BAND[0]} AND {B.TOTAL_BAND[1]})
SELECT t.station, t.max_temperature, p.total_precipitation FROM t JOIN p USING (station)""",
    "regional_monthly_mean": f"""
WITH rs AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (
              SELECT n_nationkey FROM nation WHERE n_regionkey IN (
                SELECT r_regionkey FROM region WHERE r_name = '{B.REGION}'))),
m AS (SELECT {Y} AS year, {M} AS month, l_suppkey, sum(l_quantity) AS total FROM lineitem
      WHERE l_suppkey IN (SELECT s_suppkey FROM rs) AND {_period(*B.REGION_PERIOD)}
      GROUP BY 1, 2, 3)
SELECT year, month, round(avg(total), 6) AS mean_monthly_total FROM m GROUP BY 1, 2""",
    # ------------------------------------------------------------ forecast
    "station_kernel_weights": f"""
SELECT station, round(km, 6) AS distance_km, round(exp(-(km * km) / {H_DISTANCE}), 6) AS distance_weight
FROM (SELECT station, {KM} AS km FROM ({STATIONS}))""",
    "seasonal_distance": f"""
SELECT {DAY_DIST} AS day_distance, count(value) AS n_readings,
       round(exp(-({DAY_DIST} * {DAY_DIST}) / {H_DATE}), 6) AS day_weight
FROM ({READINGS}) GROUP BY 1""",
    "hourly_distance": f"""
SELECT hour_distance, count(value) AS n_readings,
       round(exp(-(hour_distance * hour_distance) / {H_TIME}), 6) AS hour_weight
FROM (SELECT CAST({_hour_dist('hour', str(B.TARGET_HOUR))} AS INTEGER) AS hour_distance, value
      FROM ({READINGS}))
GROUP BY 1""",
    "lookback_filter": READINGS,
    "kernel_regression": FORECAST + """
SELECT hour, round(forecast_sum, 6) AS forecast_sum, round(forecast_prod, 6) AS forecast_prod
FROM f""",
    "kernel_regression_as_recorded": FORECAST_RECORDED + """
SELECT hour, round(forecast_sum, 6) AS forecast_sum, round(forecast_prod, 6) AS forecast_prod
FROM f""",
    "kernel_peak_hour": FORECAST + """
SELECT 'sum' AS kernel, arg_max(hour, row(forecast_sum, hour)) AS hour,
       round(max(forecast_sum), 6) AS forecast FROM f
UNION ALL
SELECT 'prod' AS kernel, arg_max(hour, row(forecast_prod, hour)) AS hour,
       round(max(forecast_prod), 6) AS forecast FROM f""",
    "kernel_regression_targets": TARGET_FORECASTS,
    # ------------------------------------------------------------ daily table
    "daily_summary": f"""
SELECT l_suppkey AS station, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS day, count(l_quantity) AS n_readings, round(sum(l_quantity), 6) AS total,
       min(l_quantity) AS low, max(l_quantity) AS high, count(*) FILTER (l_quantity > {B.THRESHOLD}) AS n_above,
       max(l_quantity) FILTER (l_quantity BETWEEN {B.PREFILTER_PRECIP_BAND[0]} AND {B.PREFILTER_PRECIP_BAND[1]}) AS high_in_band
FROM lineitem GROUP BY 1, 2""",
    # ------------------------------------------------------------ warehouse
    "list_all": "SELECT * FROM supplier",
    "manager_employee": """
SELECT m.s_name AS manager, e.s_name AS employee, e.s_suppkey, e.s_nationkey
FROM supplier e, supplier m WHERE e.s_nationkey = m.s_suppkey""",
    "order_by_name": "SELECT * FROM supplier WHERE s_suppkey IS NOT NULL ORDER BY s_name",
    "equality_filter": f"""
SELECT * FROM (SELECT * REPLACE (CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS o_orderkey) FROM orders)
WHERE o_orderkey IS NOT NULL AND o_orderpriority = '{B.ORDER_PRIORITY}'""",
    "between_sorted": "SELECT * FROM customer WHERE c_acctbal BETWEEN 9000 AND 10000 ORDER BY c_acctbal",
    "derived_age": "SELECT *, p_retailprice - p_size AS price_less_size FROM part",
    "prefix_suffix_like": """
SELECT * FROM part WHERE substring(p_name, 1, position(' ' IN p_name) - 1) LIKE '%ll'""",
    "in_subquery": f"""
SELECT * FROM lineitem WHERE l_suppkey IN (
  SELECT s_suppkey FROM supplier WHERE lower(trim(s_name)) = '{B.SUPPLIER_NAME}')""",
    "join_filter": f"""
SELECT l.*, s.s_name FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
WHERE lower(trim(s.s_name)) = '{B.SUPPLIER_NAME}'""",
    "in_subquery_distinct": f"SELECT * FROM part WHERE p_partkey IN ({LARGE_EARLY})",
    "count_in_subquery": f"SELECT count(*) AS n FROM part WHERE p_partkey IN ({LARGE_EARLY})",
    "scalar_subquery_compare": f"""
SELECT p_name, p_brand FROM part
WHERE p_retailprice > (SELECT p_retailprice FROM part WHERE p_partkey = {B.REFERENCE_PART})""",
    "theta_self_join": f"""
SELECT p1.p_partkey, p1.p_name, p1.p_brand, count(*) AS matches FROM part p1, part p2
WHERE p1.p_retailprice > p2.p_retailprice AND p2.p_brand = '{B.REFERENCE_BRAND}'
GROUP BY p1.p_partkey, p1.p_name, p1.p_brand""",
    "constant_filtered_avg": f"""
SELECT p_type, round(avg(p_size), 6) AS avg_value FROM part WHERE p_type = '{B.PART_TYPE}'
GROUP BY p_type""",
    "star_join_weighted_sum": f"""
SELECT s.s_name AS name, round(sum(p.p_size * l.l_quantity), 6) AS total_weight
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
JOIN lineitem l ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE lower(trim(n.n_name)) = '{B.STATE_NATION}' GROUP BY s.s_name""",
    "below_average_table": """
SELECT * FROM part WHERE p_retailprice < (SELECT avg(p_retailprice) FROM part)""",
    # ------------------------------------------------------------ integrity
    "pk_violations": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows,
       CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL THEN 'null_key' ELSE 'duplicate_key' END
         AS violation
FROM lineitem GROUP BY 1, 2
HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL""",
    "fk_orphans": f"""
SELECT * FROM lineitem l WHERE l.l_partkey IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM part p WHERE p.p_size > {B.PARENT_MIN_SIZE} AND p.p_partkey = l.l_partkey)""",
    "fk_set_null": f"""
SELECT l_orderkey,
       CASE WHEN EXISTS (SELECT 1 FROM part p WHERE p.p_size > {B.PARENT_MIN_SIZE}
                         AND p.p_partkey = l.l_partkey) THEN l_partkey END AS l_partkey,
       l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
       l_linestatus, l_shipdate
FROM lineitem l""",
    "column_checks": f"""
WITH li AS (SELECT l_orderkey, CASE WHEN l_partkey % 11 <> 0 THEN l_partkey END AS l_partkey,
                   CASE WHEN l_returnflag <> 'R' THEN l_shipdate ELSE TIMESTAMP '{B.DEFAULT_SHIPDATE}' END AS l_shipdate,
                   l_discount, l_linestatus, l_quantity - 10 AS balance, CAST(l_orderkey AS VARCHAR) AS l_shipmark
            FROM lineitem)
SELECT 'l_orderkey_not_null' AS rule, count(*) FILTER (WHERE l_orderkey IS NULL) AS violations FROM li
UNION ALL SELECT 'l_partkey_not_null', count(*) FILTER (WHERE l_partkey IS NULL) FROM li
UNION ALL SELECT 'l_shipdate_not_null', count(*) FILTER (WHERE l_shipdate IS NULL) FROM li
UNION ALL SELECT 'balance_non_negative', count(*) FILTER (WHERE balance < 0) FROM li
UNION ALL SELECT 'l_discount_in_0_0.05', count(*) FILTER (WHERE NOT (l_discount BETWEEN 0.0 AND 0.05)) FROM li
UNION ALL SELECT 'l_shipmark_max_length_3', count(*) FILTER (WHERE length(l_shipmark) > 3) FROM li
UNION ALL SELECT 'l_shipdate_is_default', count(*) FILTER (WHERE l_shipdate = TIMESTAMP '{B.DEFAULT_SHIPDATE}') FROM li
UNION ALL SELECT 'l_linestatus_max_length_1', count(*) FILTER (WHERE length(l_linestatus) > 1) FROM li""",
    # ------------------------------------------------------------ sources / sinks
    "delimited_roundtrip": "SELECT * FROM supplier",
    "csv_sink_roundtrip": "SELECT * FROM customer",
    "text_sink_roundtrip": """
SELECT concat_ws(';', p_partkey, p_name, p_brand, p_type, p_size, p_retailprice) AS value FROM part""",
    "delimited_rejects": """
WITH lines AS (
  SELECT *, CASE WHEN c_custkey % 25 = 0 THEN concat_ws(';', c_custkey, c_name, c_nationkey, c_mktsegment, 'extra')
              WHEN c_custkey % 10 = 3 THEN concat_ws(';', c_custkey, c_name, 'x', c_mktsegment)
              WHEN c_custkey % 10 = 7 THEN concat_ws(';', c_custkey, c_name, c_nationkey) END AS line FROM customer)
SELECT CASE WHEN line IS NULL THEN c_custkey END AS c_custkey, CASE WHEN line IS NULL THEN c_name END AS c_name,
       CASE WHEN line IS NULL THEN c_nationkey END AS c_nationkey, CASE WHEN line IS NULL THEN c_mktsegment END AS c_mktsegment, line
FROM lines""",
    "key_list_readings": """
SELECT l_suppkey, count(*) AS n FROM lineitem
WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 3 = 0) GROUP BY l_suppkey""",
}


def _long_form(question: str, value: str, value_2: str = "NULL", *keys: str) -> str:
    key = {k: k if k in keys else "NULL" for k in ("station", "year", "month")}
    return (f"SELECT '{question}' AS question, CAST({key['station']} AS BIGINT) AS station, CAST({key['year']} AS INTEGER) AS year, "
            f"CAST({key['month']} AS INTEGER) AS month, round(CAST({value} AS DOUBLE), 6) AS value, "
            f"round(CAST({value_2} AS DOUBLE), 6) AS value_2 FROM ({ORACLE_SQL[question]})")


ORACLE_SQL["daily_answers"] = "\nUNION ALL ".join([
    _long_form("yearly_extrema", "min_value", "max_value", "year"),
    _long_form("yearly_argmax", "max_value", "NULL", "year", "station"),
    _long_form("monthly_exceedance_count", "n_readings", "NULL", "year", "month"),
    _long_form("monthly_exceedance_station_count", "n_stations", "NULL", "year", "month"),
    _long_form("station_monthly_mean", "mean_value", "NULL", "station", "year", "month"),
    _long_form("extremes_band_join", "max_temperature", "max_daily_precipitation", "station"),
    _long_form("extremes_prefilter_join", "max_temperature", "max_precipitation", "station"),
    _long_form("extremes_total_band_join", "max_temperature", "total_precipitation", "station"),
    _long_form("regional_monthly_mean", "mean_monthly_total", "NULL", "year", "month")])
