"""Readings jobs on a hand-made fixture read through the delimited scan (cases of FIXTURES.md §1)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boreal.functions import hour_of_time
from boreal.operators import readings as R
from boreal.sources import (
    PRECIPITATION_READINGS,
    REGION_STATIONS,
    TEMPERATURE_READINGS,
    read_delimited,
    read_keys,
)

TEMPERATURE_LINES = """\
100;2000-06-01;12:00:00;28.0;G
100;2000-06-02;12:00:00;26.0;G
200;2000-06-01;12:00:00;35.0;G
200;2000-06-02;12:00:00;27.0;G
300;2000-07-01;12:00:00;29.0;G
400;2000-07-01;12:00:00;9.5;G
400;2000-07-02;12:00:00;10.5;G
500;1949-12-31;12:00:00;50.0;G
500;1950-01-01;06:00:00;-5.0;G
500;2014-12-31;06:00:00;11.0;G
500;2015-01-01;06:00:00;60.0;G
600;2000-08-01;12:00:00;10.0;G
600;2000-08-02;12:00:00;10.1;G
700;2000-09-01;12:00:00;35.0;G
"""

PRECIPITATION_LINES = """\
100;2000-06-01;06:00:00;60.0;G
100;2000-06-01;18:00:00;60.0;G
200;2000-06-01;06:00:00;150.0;G
300;2000-07-01;06:00:00;50.0;G
300;2000-07-02;06:00:00;50.0;G
300;2000-07-03;06:00:00;50.0;G
"""

REGION_LINES = """\
100;Station A;12;58.4;15.6
300;Station C;40;58.1;16.1
"""


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("readings")
    out = {}
    for name, text in [("temp", TEMPERATURE_LINES), ("prec", PRECIPITATION_LINES),
                       ("region", REGION_LINES)]:
        p = d / f"{name}.csv"
        p.write_text(text)
        out[name] = str(p)
    return out


@pytest.fixture(scope="module")
def temps(spark, files):
    return read_delimited(spark, files["temp"], TEMPERATURE_READINGS)


@pytest.fixture(scope="module")
def precip(spark, files):
    return read_delimited(spark, files["prec"], PRECIPITATION_READINGS)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_yearly_extrema_inclusive_period(temps):
    assert rows(R.yearly_extrema(temps)) == [(1950, -5.0, -5.0), (2000, 9.5, 35.0),
                                             (2014, 11.0, 11.0)]


def test_numeric_not_string_maximum(temps):
    out = rows(R.yearly_extrema(temps.where(F.col("station") == "400")))
    assert out == [(2000, 9.5, 10.5)]


def test_yearly_argmax_tie_takes_larger_station(temps):
    assert rows(R.yearly_argmax(temps)) == [(2014, 11.0, "500"), (2000, 35.0, "700"),
                                            (1950, -5.0, "500")]


def test_monthly_counts_strict_threshold_and_tie_order(temps):
    assert rows(R.monthly_exceedance_count(temps)) == [
        (2000, 6, 4), (2000, 7, 2), (2000, 8, 1), (2000, 9, 1), (2014, 12, 1)]
    assert rows(R.monthly_exceedance_station_count(temps)) == [
        (2000, 6, 2), (2000, 7, 2), (2000, 8, 1), (2000, 9, 1), (2014, 12, 1)]


def test_station_monthly_mean_forms_agree(temps):
    a = rows(R.station_monthly_mean(temps, 1950, 2014))
    b = rows(R.station_monthly_mean_sumcount(temps, 1950, 2014))
    assert a == b
    assert ("100", 2000, 6, 27.0) in a
    assert len(a) == 8  # station-months with readings only, period bounds inclusive


def test_band_join_sums_days_first(temps, precip):
    assert rows(R.extremes_band_join(temps, precip)) == [("100", 28.0, 120.0)]


def test_prefilter_join(temps, precip):
    assert rows(R.extremes_prefilter_join(temps, precip)) == [("200", 27.0, 150.0)]


def test_total_band_join(temps, precip):
    assert rows(R.extremes_total_band_join(temps, precip)) == [("300", 29.0, 150.0),
                                                               ("100", 28.0, 120.0)]


def test_regional_mean_only_over_region_stations_with_readings(spark, files, precip):
    region = read_keys(spark, files["region"])
    assert rows(R.regional_monthly_mean(precip, region)) == [(2000, 7, 150.0), (2000, 6, 120.0)]
    # the region list may hold more columns; the same answer from the full station schema
    region_full = read_delimited(spark, files["region"], REGION_STATIONS).select("station")
    assert rows(R.regional_monthly_mean(precip, region_full)) == [(2000, 7, 150.0),
                                                                  (2000, 6, 120.0)]


def test_regional_mean_without_broadcast(spark, files, precip):
    region = read_keys(spark, files["region"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    out = R.regional_monthly_mean(precip, region)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")
    assert rows(out) == [(2000, 7, 150.0), (2000, 6, 120.0)]


def test_one_sided_periods_and_the_last_year(spark):
    days = ["0001-01-01", "1989-12-31", "1990-01-01", "9998-12-31", "9999-12-31"]
    df = spark.createDataFrame([(d, float(i)) for i, d in enumerate(days)] + [(None, 9.0)], "d string, value double")
    df = df.select(F.col("d").cast("date").alias("date"), "value")

    def years(first, last):
        return sorted(r.year for r in R.yearly_extrema(df, first, last).collect())

    assert years(1990, None) == [1990, 9998, 9999]
    assert years(None, 1990) == [1, 1989, 1990]
    assert years(1990, 9999) == [1990, 9998, 9999] and years(1990, 9998) == [1990, 9998]


def test_typed_key_lists(spark, tmp_path):
    p = tmp_path / "keys.csv"
    p.write_text("1;a\nx2;b\n\n3;c\n")
    with pytest.raises(Exception):
        read_keys(spark, str(p), key_type=T.IntegerType()).collect()
    lenient = read_keys(spark, str(p), key_type=T.IntegerType(), mode="PERMISSIVE")
    assert [r.station for r in lenient.collect()] == [1, None, 3]
    assert [r.station for r in read_keys(spark, str(p)).collect()] == ["1", "x2", "3"]
    with pytest.raises(ValueError):
        read_keys(spark, str(p), mode="DROPMALFORMED")


def test_malformed_time_is_null(spark):
    df = spark.createDataFrame([("13:05:00",), ("xx",), (None,)], "t string")
    assert [r[0] for r in df.select(hour_of_time("t")).collect()] == [13, None, None]


def test_malformed_value_fails_or_nulls(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("100;2000-01-01;00:00:00;abc;G\n100;2000-01-02;00:00:00;1.5;G\n")
    with pytest.raises(Exception):
        read_delimited(spark, str(p), TEMPERATURE_READINGS).collect()
    lenient = read_delimited(spark, str(p), TEMPERATURE_READINGS, mode="PERMISSIVE")
    assert sorted(r.value for r in lenient.collect() if r.value is not None) == [1.5]
    assert lenient.where(F.col("value").isNull()).count() == 1


def test_scan_modes_never_drop_rows(spark, files):
    with pytest.raises(ValueError):
        read_delimited(spark, files["temp"], TEMPERATURE_READINGS, mode="DROPMALFORMED")
