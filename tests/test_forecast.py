"""Kernel forecast against a per-reading brute force on a small fixture (leap years, 29 February,
unknown stations, underflowing weights)."""

import calendar
import datetime as dt
import math
import random

import pytest
from pyspark.sql import types as T

from boreal.operators import forecast as K
from boreal.operators.integrity import fk_orphans

STATIONS = [("1", 58.0, 15.0), ("2", 59.5, 17.9), ("3", 56.2, 12.8), ("4", 63.8, 20.3)]
READING_SCHEMA = T.StructType([
    T.StructField("station", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("hour", T.IntegerType()), T.StructField("value", T.DoubleType())])


def _readings():
    rnd = random.Random(7)
    start = dt.date(2006, 1, 1)
    rows = []
    for _ in range(600):
        d = start + dt.timedelta(days=rnd.randrange(0, 2900))
        st = rnd.choice(["1", "2", "3", "4", "4", "999"])  # 999: unknown station
        rows.append((st, d, rnd.randrange(0, 24), round(rnd.uniform(-20, 30), 1)))
    rows.append(("1", dt.date(2012, 2, 29), 13, 4.0))
    rows.append(("2", dt.date(2011, 2, 28), 1, 2.0))
    rows.append(("3", dt.date(2012, 12, 31), 23, -3.0))
    rows.append(("3", dt.date(2013, 1, 1), 0, None))
    return rows


def _haversine(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = (math.sin((p2 - p1) / 2) ** 2
         + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * 6367 * math.asin(math.sqrt(a))


def _day_distance(d, target, wrap_leap, exact_half):
    y = d.year
    t = dt.date(y, target.month, min(target.day, calendar.monthrange(y, target.month)[1]))
    raw = abs(d.timetuple().tm_yday - t.timetuple().tm_yday)
    if calendar.isleap(y):
        return min(raw, 366 - raw) if wrap_leap else raw
    return min(raw, 365 - raw) if exact_half else (raw if raw < 182 else 365 - raw)


def brute_force(readings, lat, lon, target, hours, hd, hy, ht, lookback, wrap_leap, exact_half):
    coords = {s: (a, b) for s, a, b in STATIONS}
    out = {}
    for t in hours:
        ns = ds = np_ = dp = 0.0
        for st, d, h, v in readings:
            if st not in coords or v is None or not (d < target and (target - d).days <= lookback):
                continue
            kd = math.exp(-(_haversine(*coords[st], lat, lon) ** 2) / hd)
            ky = math.exp(-(_day_distance(d, target, wrap_leap, exact_half) ** 2) / hy)
            dh = abs(h - t)
            kt = math.exp(-(min(dh, 24 - dh) ** 2) / ht)
            ns, ds = ns + (kd + ky + kt) * v, ds + (kd + ky + kt)
            np_, dp = np_ + kd * ky * kt * v, dp + kd * ky * kt
        out[t] = (ns / ds if ds else None, np_ / dp if dp else None)
    return out


@pytest.fixture(scope="module")
def frames(spark):
    readings = spark.createDataFrame(_readings(), READING_SCHEMA)
    stations = spark.createDataFrame(STATIONS, "station string, latitude double, longitude double")
    return readings, stations


@pytest.mark.parametrize("target, wrap_leap, exact_half", [
    (dt.date(2013, 7, 4), True, True),
    (dt.date(2013, 7, 4), False, False),
    (dt.date(2012, 2, 29), True, True),
    (dt.date(2013, 12, 31), False, False),
    (dt.date(2013, 1, 1), True, True),
])
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_matches_brute_force(spark, frames, target, wrap_leap, exact_half, threshold):
    readings, stations = frames
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    got = {r.hour: (r.forecast_sum, r.forecast_prod) for r in K.kernel_regression(
        readings, stations, 58.4274, 14.826, target, wrap_leap=wrap_leap,
        exact_half=exact_half).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    want = brute_force(_readings(), 58.4274, 14.826, target, K.FORECAST_HOURS, K.H_DISTANCE,
                       K.H_DATE, K.H_TIME, K.LOOKBACK_DAYS, wrap_leap, exact_half)
    assert set(got) == set(K.FORECAST_HOURS)
    for h in K.FORECAST_HOURS:
        for g, w in zip(got[h], want[h]):
            assert math.isclose(g, w, rel_tol=1e-9), (h, g, w)


def test_broadcast_and_shuffled_weights_agree(spark, frames):
    readings, stations = frames
    def run(threshold):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        return K.kernel_regression(readings, stations, 58.4, 14.8, dt.date(2013, 7, 4)).orderBy("hour").collect()

    b, a = run("-1"), run("10m")
    # a station listed twice weighs once
    twice = K.kernel_regression(readings, stations.union(stations), 58.4, 14.8, dt.date(2013, 7, 4)).orderBy("hour").collect()
    assert [r.forecast_sum for r in twice] == pytest.approx([r.forecast_sum for r in a])
    for x, y in zip(a, b):
        assert x.hour == y.hour and math.isclose(x.forecast_sum, y.forecast_sum, rel_tol=1e-12)


def test_underflowing_product_is_null(frames):
    readings, stations = frames
    out = K.kernel_regression(readings, stations, 58.4, 14.8, dt.date(2013, 7, 4),
                              h_distance=1e-9).collect()
    assert all(r.forecast_prod is None and r.forecast_sum is not None for r in out)


def test_no_usable_readings_gives_null_rows(frames):
    readings, stations = frames
    out = K.kernel_regression(readings, stations, 58.4, 14.8, dt.date(1990, 1, 1)).collect()
    assert sorted(r.hour for r in out) == sorted(K.FORECAST_HOURS)
    assert all(r.forecast_sum is None and r.forecast_prod is None for r in out)


def test_unknown_station_reported(frames):
    readings, stations = frames
    orphans = fk_orphans(readings, "station", stations, "station")
    assert {r.station for r in orphans.collect()} == {"999"}


def test_peak_hour(frames):
    readings, stations = frames
    f = K.kernel_regression(readings, stations, 58.4274, 14.826, dt.date(2013, 7, 4))
    rows = {r.hour: r for r in f.collect()}
    peak = {r.kernel: r for r in K.kernel_peak_hour(f).collect()}
    assert peak["sum"].forecast == pytest.approx(max(r.forecast_sum for r in rows.values()))
    assert peak["prod"].forecast == pytest.approx(max(r.forecast_prod for r in rows.values()))
    assert rows[peak["sum"].hour].forecast_sum == pytest.approx(peak["sum"].forecast)


def test_seasonal_and_hourly_tables(frames):
    readings, _ = frames
    target = dt.date(2013, 7, 4)
    usable = [r for r in _readings() if r[1] < target and (target - r[1]).days <= 2190
              and r[3] is not None]
    sd = {r.day_distance: r.n_readings for r in K.seasonal_distance(readings, target).collect()}
    assert sum(sd.values()) == len(usable)
    assert max(sd) <= 183
    hd = {r.hour_distance: r.n_readings
          for r in K.hourly_distance(readings, target, 14).collect()}
    assert sum(hd.values()) == len(usable) and max(hd) <= 12
