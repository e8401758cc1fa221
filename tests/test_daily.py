"""The daily table: same answers as the readings, batch by batch, without shuffling daily rows."""

import datetime as dt
import glob
import os
import random
import uuid

import pytest

from boreal.operators import daily as D
from boreal.operators import readings as R
from boreal.plans.inspect import plan_text
from boreal.session import scratch_path

THRESHOLD, BAND, BUCKETS = 10.0, (5.0, 12.0), 4


def some_readings(seed, n=1500):
    """Readings of a dozen stations, one of which sends a third; NULL stations, dates and values among them."""
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        station = "hot" if rnd.random() < 0.33 else rnd.choice([f"s{k}" for k in range(12)] + [None])
        day = dt.date(2000, 1, 1) + dt.timedelta(days=rnd.randrange(900))
        rows.append((station, rnd.choice([day] * 30 + [None]), rnd.choice([round(rnd.uniform(-5, 15) * 4) / 4] * 20 + [None])))
    return rows


def store(spark, batches, location=None):
    name = f"daily_{uuid.uuid4().hex}"
    location = location or scratch_path(spark, name)
    D.open_table(spark, name, location, BUCKETS)
    for batch, rows in batches:
        readings = spark.createDataFrame(rows, "station string, date date, value double")
        D.add_batch(D.summarise(readings, THRESHOLD, BAND), name, batch)
    return name, location


def rows_of(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def both(spark):
    t, p = some_readings(1), some_readings(2)
    tables = [store(spark, [("a", x[::3]), ("b", x[1::3]), ("c", x[:5]), ("c", x[2::3]), ("b", x[1::3])])[0] for x in (t, p)]
    frames = [spark.createDataFrame(x, "station string, date date, value double") for x in (t, p)]
    return [D.daily_rows(spark, n) for n in tables], frames


def test_questions_equal_those_on_readings(spark, both):
    (dt_, dp), (t, p) = both
    period = (2000, 2001)
    region = spark.createDataFrame([("s1",), ("s4",), ("hot",), ("none",)], "station string")
    wide = ((0.0, 100.0), (0.0, 60.0))
    pairs = [
        (D.yearly_extrema(dt_, *period), R.yearly_extrema(t, *period)),
        (D.yearly_extrema(dt_, None, None), R.yearly_extrema(t, None, None)),
        (D.yearly_argmax(dt_, *period), R.yearly_argmax(t.where("station IS NOT NULL"), *period)),
        (D.monthly_exceedance_count(dt_, *period), R.monthly_exceedance_count(t, THRESHOLD, *period)),
        (D.monthly_exceedance_station_count(dt_, *period), R.monthly_exceedance_station_count(t, THRESHOLD, *period)),
        (D.station_monthly_mean(dt_, *period), R.station_monthly_mean(t, *period)),
        (D.extremes_band_join(dt_, dp, *wide), R.extremes_band_join(t, p, *wide)),
        (D.extremes_prefilter_join(dt_, dp), R.extremes_prefilter_join(t, p, BAND, BAND)),
        (D.extremes_total_band_join(dt_, dp, wide[0], (-1e4, 1e4)), R.extremes_total_band_join(t, p, wide[0], (-1e4, 1e4))),
        (D.regional_monthly_mean(dp, region, *period), R.regional_monthly_mean(p, region, *period))]
    for k, (mine, direct) in enumerate(pairs):
        direct = direct.select(*mine.columns)
        assert rows_of(mine) == rows_of(direct) and rows_of(mine), k


def test_a_batch_leaves_others_alone_and_a_new_session_finds_them(spark):
    rows = some_readings(3, 300)
    name, location = store(spark, [("a", rows[:100])])
    files = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{location.replace('file:', '')}/batch=a/*.parquet")}
    assert 0 < len(files) <= BUCKETS  # one file per bucket at most
    readings = spark.createDataFrame(rows[100:], "station string, date date, value double")
    D.add_batch(D.summarise(readings, THRESHOLD, BAND), name, "b")
    assert files == {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{location.replace('file:', '')}/batch=a/*.parquet")}
    spark.sql(f"DROP TABLE {name}")  # as after the end of a session: the files stay
    again, _ = store(spark, [], location)
    whole = D.summarise(spark.createDataFrame(rows, "station string, date date, value double"), THRESHOLD, BAND)
    assert rows_of(D.daily_rows(spark, again)) == rows_of(whole)


def test_daily_rows_are_never_shuffled(spark, both):
    """Also where no side is small enough to broadcast: means and joins use the buckets."""
    (t, p), _ = both
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (D.station_monthly_mean(t, 2000, 2001), D.extremes_band_join(t, p), D.extremes_prefilter_join(t, p),
                   D.extremes_total_band_join(t, p)):
            text = plan_text(df, "simple")
            assert text.count("Exchange") == 1 and "Exchange rangepartitioning" in text, text  # the order of the result
        region = spark.createDataFrame([("s1",)], "station string")
        text = plan_text(D.regional_monthly_mean(p, region, 2000, 2001), "simple")
        assert "Bucketed: true" in text or "bucketed" in text.lower()
        facts = text[text.index("left_semi") if "left_semi" in text else 0:]
        assert facts.count("Exchange hashpartitioning(year") == 1  # only the sums per station and month move
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_an_empty_batch(spark):
    name, _ = store(spark, [("a", []), ("b", [("s", dt.date(2000, 1, 1), 11.0)])])
    assert [tuple(r) for r in D.daily_rows(spark, name).collect()] == [("s", dt.date(2000, 1, 1), 1, 11.0, 11.0, 11.0, 1, 11.0)]


def test_buckets_grow_with_the_readings(spark, tmp_path, monkeypatch):
    """No task holds more of the table because the table grows."""
    from boreal.plans import bindings as B

    rnd = random.Random(5)
    rows = [(k, rnd.randrange(40), k % 3, float(rnd.randrange(50)), dt.datetime(1996, 1, 1) + dt.timedelta(days=rnd.randrange(60)))
            for k in range(3000)]
    spark.createDataFrame(rows, "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_shipdate timestamp_ntz") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    plain = rows_of(B.daily_summary(spark, str(tmp_path)))
    monkeypatch.setattr(D, "BUCKET_READINGS", 100)
    made, open_table = [], D.open_table
    monkeypatch.setattr(D, "open_table", lambda s, name, location, buckets, kind: (made.append(buckets), open_table(s, name, location, buckets, kind)))
    assert rows_of(B.daily_summary(spark, str(tmp_path))) == plain and sum(r[2] for r in plain) == len(rows)
    assert made == [30] and [D.bucket_count(n, 8) for n in (0, 800, 801, 3000)] == [8, 8, 9, 30]
