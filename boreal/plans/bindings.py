"""Every job bound to the shared test tables: ``QUERIES[name](spark, data_dir) -> DataFrame``.

Roles played by the TPC-H-like tables:

* readings: ``lineitem`` — station ``l_suppkey``, date ``l_shipdate``, value ``l_extendedprice``
  (temperature-like) or ``l_quantity`` (precipitation-like);
* a region's stations: suppliers whose nation lies in region ``EUROPE``;
* forecast readings: ``lineitem`` with ``l_suppkey`` as station, ``l_orderkey mod 24`` as the hour
  and ``l_quantity`` as the value; forecast stations: ``supplier`` placed on a grid by key
  (latitude ``55 + 0.2 (k mod 50)``, longitude ``11 + 0.3 (k mod 37)``);
* company tables: ``supplier`` (people with a manager: ``s_nationkey`` names the manager's key),
  ``part``, ``customer``, ``lineitem``.

Every binding reads tables that grow with the scale factor.

Floating means and weighted sums are rounded to 6 places: summation order differs between engines.
The bindings only name columns, pick parameters and place the forecast stations on a grid;
all work is done by ``boreal.operators``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boreal.functions.text import normalized_equals
from boreal.operators import daily as D
from boreal.operators import forecast as K
from boreal.operators import forecast_targets as KT
from boreal.operators import integrity as I
from boreal.operators import readings as R
from boreal.operators import warehouse as W
from boreal.session import scratch_path
from boreal.sinks import write_csv, write_delimited, write_text
from boreal.sources import load_table, read_delimited, read_keys, split_delimited

# Parameters of the bindings (shared with the oracle SQL), the questions' periods,
# threshold, place and dates among them.
PERIOD = (1996, 2000)
MEAN_PERIOD = (1995, 2001)
REGION_PERIOD = (1993, 2016)
THRESHOLD = 10.0
REGION = "EUROPE"
TEMP_BAND = (104500.0, 104900.0)
DAILY_BAND = (100.0, 120.0)
PREFILTER_TEMP_BAND = (90000.0, 100000.0)
PREFILTER_PRECIP_BAND = (20.0, 30.0)
TOTAL_BAND = (14500.0, 15500.0)
TARGET_LAT, TARGET_LON = 58.4274, 14.826
TARGET_DATE = dt.date(2000, 7, 4)
WINTER_TARGET_DATE = dt.date(2001, 1, 2)
TARGET_HOUR = 14
SUPPLIER_NAME = "supplier#000000007"
REFERENCE_PART = 42
REFERENCE_BRAND = "Brand#11"
ORDER_PRIORITY = "1-URGENT"
LARGE_QUANTITY, EARLY = 45, dt.datetime(1995, 3, 1)
PART_TYPE = "ECONOMY"
STATE_NATION = "nation_3"
PARENT_MIN_SIZE = 5
TARGET_YEAR, TARGET_H_DISTANCE, TARGET_TAIL = 2000, 2000.0, 1e-13
DAILY_BUCKETS = 8  # at least
DEFAULT_SHIPDATE = dt.datetime(1992, 1, 1)

LI = dict(station="l_suppkey", date="l_shipdate")


def _t(spark, d, name):
    return load_table(spark, d, name)


def _r6(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*[F.round(F.col(c), 6).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ---------------------------------------------------------------- readings
def yearly_extrema(spark, d):
    return R.yearly_extrema(_t(spark, d, "lineitem"), *PERIOD, date="l_shipdate",
                            value="l_extendedprice")


def yearly_argmax(spark, d):
    return R.yearly_argmax(_t(spark, d, "lineitem"), *PERIOD, **LI, value="l_extendedprice")


def monthly_exceedance_count(spark, d):
    return R.monthly_exceedance_count(_t(spark, d, "lineitem"), THRESHOLD, *PERIOD, **LI,
                                      value="l_quantity")


def monthly_exceedance_station_count(spark, d):
    return R.monthly_exceedance_station_count(_t(spark, d, "lineitem"), THRESHOLD, *PERIOD, **LI,
                                              value="l_quantity")


def station_monthly_mean(spark, d):
    return _r6(R.station_monthly_mean(_t(spark, d, "lineitem"), *MEAN_PERIOD, **LI,
                                      value="l_extendedprice"), "mean_value")


def station_monthly_mean_sumcount(spark, d):
    return _r6(R.station_monthly_mean_sumcount(_t(spark, d, "lineitem"), *MEAN_PERIOD, **LI,
                                               value="l_extendedprice"), "mean_value")


def _temps(spark, d):
    return _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("station"),
                                           F.col("l_shipdate").alias("date"),
                                           F.col("l_extendedprice").alias("value"))


def _precip(spark, d):
    return _t(spark, d, "lineitem").select(F.col("l_suppkey").alias("station"),
                                           F.col("l_shipdate").alias("date"),
                                           F.col("l_quantity").alias("value"))


def extremes_band_join(spark, d):
    return R.extremes_band_join(_temps(spark, d), _precip(spark, d), TEMP_BAND, DAILY_BAND)


def extremes_prefilter_join(spark, d):
    return R.extremes_prefilter_join(_temps(spark, d), _precip(spark, d), PREFILTER_TEMP_BAND,
                                     PREFILTER_PRECIP_BAND)


def extremes_total_band_join(spark, d):
    return R.extremes_total_band_join(_temps(spark, d), _precip(spark, d), TEMP_BAND, TOTAL_BAND)


def region_stations(spark, d) -> DataFrame:
    """Supplier keys of the region (supplier -> nation -> region). The key list is sized once,
    where it meets the readings, by ``regional_monthly_mean``."""
    regions = _t(spark, d, "region").where(F.col("r_name") == REGION)
    nations = _t(spark, d, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"),
                                          "left_semi")
    return (_t(spark, d, "supplier")
            .join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
            .select("s_suppkey"))


def regional_monthly_mean(spark, d):
    return _r6(R.regional_monthly_mean(_t(spark, d, "lineitem"), region_stations(spark, d),
                                       *REGION_PERIOD, **LI, region_station="s_suppkey",
                                       value="l_quantity"), "mean_monthly_total")


# ---------------------------------------------------------------- forecast
def forecast_readings(spark, d) -> DataFrame:
    """(station, date, hour, value) from lineitem: supplier key, ship date, order key mod 24,
    quantity."""
    return _t(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("station"), F.col("l_shipdate").alias("date"),
        (F.col("l_orderkey") % 24).cast("int").alias("hour"), F.col("l_quantity").alias("value"))


def forecast_stations(spark, d) -> DataFrame:
    """(station, latitude, longitude): suppliers placed on a grid by key."""
    k = F.col("s_suppkey")
    return _t(spark, d, "supplier").select(
        k.alias("station"), (F.lit(55.0) + F.lit(0.2) * (k % 50).cast("double")).alias("latitude"),
        (F.lit(11.0) + F.lit(0.3) * (k % 37).cast("double")).alias("longitude"))


def station_kernel_weights(spark, d):
    return _r6(K.station_kernel_weights(forecast_stations(spark, d), TARGET_LAT, TARGET_LON),
               "distance_km", "distance_weight")


def seasonal_distance(spark, d):
    return _r6(K.seasonal_distance(forecast_readings(spark, d), TARGET_DATE), "day_weight")


def hourly_distance(spark, d):
    return _r6(K.hourly_distance(forecast_readings(spark, d), TARGET_DATE, TARGET_HOUR),
               "hour_weight")


def lookback_filter(spark, d):
    return K.lookback_filter(forecast_readings(spark, d), TARGET_DATE)


def _forecast(spark, d):
    return K.kernel_regression(forecast_readings(spark, d), forecast_stations(spark, d),
                               TARGET_LAT, TARGET_LON, TARGET_DATE)


def kernel_regression(spark, d):
    return _r6(_forecast(spark, d), "forecast_sum", "forecast_prod")


def kernel_regression_as_recorded(spark, d):
    """The forecast with the day distance of the recorded results: no wrap-around in leap years,
    and a common-year distance of 182 counted as 183. The target sits at the turn of the year,
    where the two distance rules differ (late-December readings of leap years)."""
    return _r6(K.kernel_regression(forecast_readings(spark, d), forecast_stations(spark, d),
                                   TARGET_LAT, TARGET_LON, WINTER_TARGET_DATE, wrap_leap=False,
                                   exact_half=False), "forecast_sum", "forecast_prod")


def kernel_peak_hour(spark, d):
    return _r6(K.kernel_peak_hour(_forecast(spark, d)), "forecast")


def forecast_targets(spark, d) -> DataFrame:
    """(target, latitude, longitude, date, hour): customers on a grid of their own by key, on the 15th of a month."""
    k = F.col("c_custkey")
    return _t(spark, d, "customer").select(
        k.alias("target"), (F.lit(55.1) + F.lit(0.25) * (k % 40).cast("double")).alias("latitude"),
        (F.lit(11.2) + F.lit(0.35) * (k % 31).cast("double")).alias("longitude"),
        F.make_date(F.lit(TARGET_YEAR), (k % 4 * 3 + 1).cast("int"), F.lit(15)).alias("date"), (k % 24).cast("int").alias("hour"))


def kernel_regression_targets(spark, d):
    """Forecasts for every customer's place, date and hour; a short distance kernel, so that most stations are far."""
    out = KT.kernel_regression_targets(forecast_readings(spark, d), forecast_stations(spark, d), forecast_targets(spark, d),
                                       h_distance=TARGET_H_DISTANCE, tail=TARGET_TAIL)
    out = out.drop("bound_sum", "bound_prod").withColumn("date", F.col("date").cast("string"))
    return _r6(out, "forecast_sum", "forecast_prod")


# ---------------------------------------------------------------- daily table
def _daily(spark, d, readings: DataFrame, band, what: str) -> DataFrame:
    """The daily table of ``readings`` (station, date, value, part), stored in two batches that share days; the second
    is stored twice, as after a retry."""
    name = f"boreal_daily_{what}_{uuid.uuid4().hex}"
    D.open_table(spark, name, scratch_path(spark, name), D.bucket_count(readings.count(), DAILY_BUCKETS), "BIGINT")
    for part in (0, 1, 1):
        D.add_batch(D.summarise(readings.where(F.col("part") == part), THRESHOLD, band), name, f"part-{part}")
    return D.daily_rows(spark, name)


def _parted(spark, d, value: str) -> DataFrame:
    return _t(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("station"), F.col("l_shipdate").alias("date"), F.col(value).alias("value"),
        (F.col("l_linenumber") % 2).alias("part"))


def _daily_precipitation(spark, d) -> DataFrame:
    return _daily(spark, d, _parted(spark, d, "l_quantity"), PREFILTER_PRECIP_BAND, "precipitation")


def daily_summary(spark, d):
    return _r6(_daily_precipitation(spark, d), "total").withColumn("day", F.col("day").cast("string"))


def daily_answers(spark, d):
    """All questions on readings from the two daily tables: question, station, year, month, value, value_2."""
    temps = _daily(spark, d, _parted(spark, d, "l_extendedprice"), PREFILTER_TEMP_BAND, "temperature")
    precip = _daily_precipitation(spark, d)
    answers = {
        "yearly_extrema": (D.yearly_extrema(temps, *PERIOD), "min_value", "max_value"),
        "yearly_argmax": (D.yearly_argmax(temps, *PERIOD), "max_value", None),
        "monthly_exceedance_count": (D.monthly_exceedance_count(precip, *PERIOD), "n_readings", None),
        "monthly_exceedance_station_count": (D.monthly_exceedance_station_count(precip, *PERIOD), "n_stations", None),
        "station_monthly_mean": (D.station_monthly_mean(temps, *MEAN_PERIOD), "mean_value", None),
        "extremes_band_join": (D.extremes_band_join(temps, precip, TEMP_BAND, DAILY_BAND), "max_temperature",
                               "max_daily_precipitation"),
        "extremes_prefilter_join": (D.extremes_prefilter_join(temps, precip), "max_temperature", "max_precipitation"),
        "extremes_total_band_join": (D.extremes_total_band_join(temps, precip, TEMP_BAND, TOTAL_BAND), "max_temperature",
                                     "total_precipitation"),
        "regional_monthly_mean": (D.regional_monthly_mean(precip, region_stations(spark, d), *REGION_PERIOD,
                                                          region_station="s_suppkey"), "mean_monthly_total", None)}

    def rows(question: str, df: DataFrame, *values: str | None) -> DataFrame:
        key = {c: F.col(c) if c in df.columns else F.lit(None) for c in ("station", "year", "month")}
        return df.select(
            F.lit(question).alias("question"), key["station"].cast("long").alias("station"), key["year"].cast("int").alias("year"),
            key["month"].cast("int").alias("month"), *[F.round(F.col(v).cast("double") if v else F.lit(None).cast("double"), 6).alias(c)
                                                       for c, v in zip(("value", "value_2"), values)])

    return reduce(DataFrame.unionByName, [rows(q, *a) for q, a in answers.items()])


# ---------------------------------------------------------------- warehouse
def list_all(spark, d):
    return W.list_all(_t(spark, d, "supplier"))


def manager_employee(spark, d):
    return W.manager_employee(_t(spark, d, "supplier"), key="s_suppkey", manager="s_nationkey",
                              name="s_name", columns=("s_suppkey", "s_nationkey"))


def order_by_name(spark, d):
    return W.sorted_by(_t(spark, d, "supplier").where(F.col("s_suppkey").isNotNull()), "s_name")


def equality_filter(spark, d):
    """Orders of the first priority with a key; keys that 7 divides are NULL here, as if missing."""
    key = F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderkey"))
    orders = _t(spark, d, "orders").withColumn("o_orderkey", key)
    return W.equality_filter(orders, "o_orderpriority", ORDER_PRIORITY, not_null="o_orderkey")


def between_sorted(spark, d):
    return W.between_sorted(_t(spark, d, "customer"), "c_acctbal", 9000, 10000)


def derived_age(spark, d):
    return W.with_derived(_t(spark, d, "part"), "price_less_size",
                          F.col("p_retailprice") - F.col("p_size"))


def prefix_suffix_like(spark, d):
    return W.prefix_suffix_like(_t(spark, d, "part"), "p_name", " ", "ll")


def _supplier_named():
    return normalized_equals("s_name", SUPPLIER_NAME)


def in_subquery(spark, d):
    return W.in_subquery(_t(spark, d, "lineitem"), "l_suppkey", _t(spark, d, "supplier"),
                         "s_suppkey", _supplier_named())


def join_filter(spark, d):
    return W.join_filter(_t(spark, d, "lineitem"), "l_suppkey", _t(spark, d, "supplier"),
                         "s_suppkey", _supplier_named(), dim_columns=("s_name",))


def in_subquery_distinct(spark, d):
    """Parts that were shipped in large quantities early on."""
    return W.in_subquery(_t(spark, d, "part"), "p_partkey", _t(spark, d, "lineitem"), "l_partkey",
                         (F.col("l_quantity") > LARGE_QUANTITY) & (F.col("l_shipdate") < F.lit(EARLY)))


def count_in_subquery(spark, d):
    return W.count_rows(in_subquery_distinct(spark, d))


def scalar_subquery_compare(spark, d):
    return W.scalar_subquery_compare(_t(spark, d, "part"), "p_retailprice",
                                     F.col("p_partkey") == REFERENCE_PART,
                                     columns=("p_name", "p_brand"))


def theta_self_join(spark, d):
    """Every part dearer than some part of the reference brand, with the number of those."""
    return W.theta_self_join(_t(spark, d, "part"), "p_retailprice",
                             F.col("p_brand") == REFERENCE_BRAND, columns=("p_partkey", "p_name", "p_brand"))


def constant_filtered_avg(spark, d):
    return _r6(W.constant_filtered_avg(_t(spark, d, "part"), "p_type", PART_TYPE, "p_size"),
               "avg_value")


def star_join_weighted_sum(spark, d):
    return _r6(W.star_join_weighted_sum(
        _t(spark, d, "supplier"), _t(spark, d, "nation"), _t(spark, d, "lineitem"),
        _t(spark, d, "part"), normalized_equals("n_name", STATE_NATION),
        supplier_id="s_suppkey", supplier_name="s_name", supplier_city="s_nationkey",
        city_id="n_nationkey", supply_supplier="l_suppkey", supply_part="l_partkey",
        supply_quantity="l_quantity", part_id="p_partkey", part_weight="p_size"),
        "total_weight")


def below_average_table(spark, d):
    return W.below_average_table(
        spark, _t(spark, d, "part"), "p_retailprice", "boreal_below_average_parts",
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE", scratch_path(spark, "below_average_table"))


# ---------------------------------------------------------------- integrity
def pk_violations(spark, d):
    return I.pk_violations(_t(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _parents(spark, d):
    return _t(spark, d, "part").where(F.col("p_size") > PARENT_MIN_SIZE)


def fk_orphans(spark, d):
    return I.fk_orphans(_t(spark, d, "lineitem"), "l_partkey", _parents(spark, d), "p_partkey")


def fk_set_null(spark, d):
    return I.fk_set_null(_t(spark, d, "lineitem"), "l_partkey", _parents(spark, d), "p_partkey")


def column_rules() -> dict:
    return {
        "l_orderkey_not_null": I.not_null("l_orderkey"),
        "l_partkey_not_null": I.not_null("l_partkey"),
        "l_shipdate_not_null": I.not_null("l_shipdate"),
        "balance_non_negative": I.non_negative("balance"),
        "l_discount_in_0_0.05": I.in_range("l_discount", 0.0, 0.05),
        "l_shipmark_max_length_3": I.max_length("l_shipmark", 3),
        "l_linestatus_max_length_1": I.max_length("l_linestatus", 1),
    }


def column_checks(spark, d):
    """Rules over all shipments: part keys that 11 divides and the ship dates of returned goods are NULL
    here, as if missing; the dates get their default, the keys do not."""
    li = _t(spark, d, "lineitem").select(
        "l_orderkey", F.when(F.col("l_partkey") % 11 != 0, F.col("l_partkey")).alias("l_partkey"),
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).alias("l_shipdate"), "l_discount", "l_linestatus",
        (F.col("l_quantity") - 10).alias("balance"), F.col("l_orderkey").cast("string").alias("l_shipmark"))
    li = I.with_default(li, "l_shipdate", F.lit(DEFAULT_SHIPDATE.isoformat(sep=" ")).cast("timestamp_ntz"))
    defaulted = {"l_shipdate_is_default": F.col("l_shipdate") == F.lit(DEFAULT_SHIPDATE)}
    return I.column_checks(li, {**column_rules(), **defaulted})


# ---------------------------------------------------------------- sources / sinks
SUPPLIER_SCHEMA = T.StructType([
    T.StructField("s_suppkey", T.LongType()), T.StructField("s_name", T.StringType()),
    T.StructField("s_nationkey", T.IntegerType()), T.StructField("s_acctbal", T.DoubleType())])
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType())])


def delimited_roundtrip(spark, d):
    path = scratch_path(spark, "delimited")
    write_delimited(_t(spark, d, "supplier"), path)
    return read_delimited(spark, path, SUPPLIER_SCHEMA)


def csv_sink_roundtrip(spark, d):
    path = scratch_path(spark, "csv")
    write_csv(_t(spark, d, "customer"), path, sort_columns=[F.col("c_acctbal").desc(), "c_custkey"])
    return spark.read.schema(CUSTOMER_SCHEMA).option("header", "true").csv(path)


def text_sink_roundtrip(spark, d):
    path = scratch_path(spark, "text")
    write_text(_t(spark, d, "part"), path, sort_columns=[F.col("p_partkey").desc()])
    return spark.read.text(path)


def key_list_readings(spark, d):
    """Readings per station of a key list that lies in a file, first field of wider lines."""
    path = scratch_path(spark, "keys")
    write_delimited(_t(spark, d, "supplier").where(F.col("s_suppkey") % 3 == 0), path)
    keys = read_keys(spark, path, key="s_suppkey", key_type=T.LongType())
    chosen = W.in_subquery(_t(spark, d, "lineitem"), "l_suppkey", keys, "s_suppkey")
    return chosen.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n"))


REJECT_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()), T.StructField("c_mktsegment", T.StringType())])


def delimited_rejects(spark, d):
    """Customers as lines, some of them with a field too many, a nation that is no number or a field missing: good
    rows and rejected lines."""
    k, fields = F.col("c_custkey"), [F.col(c).cast("string") for c in REJECT_SCHEMA.names]
    line = F.when(k % 25 == 0, F.concat_ws(";", *fields, F.lit("extra"))) \
        .when(k % 10 == 3, F.concat_ws(";", *fields[:2], F.lit("x"), fields[3])) \
        .when(k % 10 == 7, F.concat_ws(";", *fields[:3])).otherwise(F.concat_ws(";", *fields))
    path = scratch_path(spark, "lines")
    _t(spark, d, "customer").select(line.alias("value")).write.text(path)
    good, rejects = split_delimited(spark, path, REJECT_SCHEMA, scratch_path(spark, "split"))
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in REJECT_SCHEMA.fields}
    return good.select("*", F.lit(None).cast("string").alias("line")).unionByName(rejects.select(*none.values(), "line"))


QUERIES = {f.__name__: f for f in [
    yearly_extrema, yearly_argmax, monthly_exceedance_count, monthly_exceedance_station_count,
    station_monthly_mean, station_monthly_mean_sumcount, extremes_band_join,
    extremes_prefilter_join, extremes_total_band_join, regional_monthly_mean,
    station_kernel_weights, seasonal_distance, hourly_distance, lookback_filter,
    kernel_regression, kernel_regression_as_recorded, kernel_peak_hour, kernel_regression_targets,
    daily_summary, daily_answers,
    list_all, manager_employee, order_by_name, equality_filter, between_sorted, derived_age,
    prefix_suffix_like, in_subquery, join_filter, in_subquery_distinct, count_in_subquery,
    scalar_subquery_compare, theta_self_join, constant_filtered_avg, star_join_weighted_sum,
    below_average_table,
    pk_violations, fk_orphans, fk_set_null, column_checks,
    delimited_roundtrip, csv_sink_roundtrip, text_sink_roundtrip, key_list_readings,
    delimited_rejects,
]}
