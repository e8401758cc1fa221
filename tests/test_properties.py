"""Property tests: calendar distances and readings aggregates against plain Python on random data."""

import calendar
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from boreal.functions import circular_hour_distance, seasonal_day_distance
from boreal.operators import readings as R

DATES = st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))
SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_day_distance(d, target, wrap_leap, exact_half):
    y = d.year
    t = dt.date(y, target.month, min(target.day, calendar.monthrange(y, target.month)[1]))
    raw = abs(d.timetuple().tm_yday - t.timetuple().tm_yday)
    if calendar.isleap(y):
        return min(raw, 366 - raw) if wrap_leap else raw
    return min(raw, 365 - raw) if exact_half else (raw if raw < 182 else 365 - raw)


@SETTINGS
@given(dates=st.lists(DATES, min_size=1, max_size=150), target=DATES,
       wrap_leap=st.booleans(), exact_half=st.booleans())
def test_seasonal_day_distance(spark, dates, target, wrap_leap, exact_half):
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    got = [r.x for r in df.select(
        seasonal_day_distance(F.col("d"), target, wrap_leap, exact_half).alias("x")).collect()]
    assert got == [py_day_distance(d, target, wrap_leap, exact_half) for d in dates]


@SETTINGS
@given(pairs=st.lists(st.tuples(st.integers(0, 23), st.integers(0, 23)), min_size=1, max_size=100))
def test_circular_hour_distance(spark, pairs):
    df = spark.createDataFrame(pairs, "a int, b int")
    got = [r.x for r in df.select(circular_hour_distance("a", F.col("b")).alias("x")).collect()]
    assert got == [min(abs(a - b), 24 - abs(a - b)) for a, b in pairs]


READING = st.tuples(st.sampled_from(["1", "2", "3", "9"]),
                    st.dates(min_value=dt.date(1945, 1, 1), max_value=dt.date(2020, 12, 31)),
                    st.floats(min_value=-40, max_value=40, allow_nan=False).map(lambda x: round(x, 1)))


@SETTINGS
@given(rows=st.lists(READING, min_size=1, max_size=200))
def test_readings_aggregates(spark, rows):
    df = spark.createDataFrame(rows, "station string, date date, value double")
    inside = [r for r in rows if 1950 <= r[1].year <= 2014]
    years = {}
    for _, d, v in inside:
        lo, hi = years.get(d.year, (v, v))
        years[d.year] = (min(lo, v), max(hi, v))
    assert {r.year: (r.min_value, r.max_value) for r in R.yearly_extrema(df).collect()} == years
    counts, stations = {}, {}
    for s, d, v in inside:
        if v > 10:
            counts[(d.year, d.month)] = counts.get((d.year, d.month), 0) + 1
            stations.setdefault((d.year, d.month), set()).add(s)
    assert {(r.year, r.month): r.n_readings
            for r in R.monthly_exceedance_count(df).collect()} == counts
    assert {(r.year, r.month): r.n_stations
            for r in R.monthly_exceedance_station_count(df).collect()} == \
        {k: len(v) for k, v in stations.items()}
    region = spark.createDataFrame([("1",), ("3",)], "station string")
    per = {}
    for s, d, v in rows:
        if s in ("1", "3") and 1993 <= d.year <= 2016:
            per[(d.year, d.month, s)] = per.get((d.year, d.month, s), 0.0) + v
    means = {}
    for (y, m, _), tot in per.items():
        means.setdefault((y, m), []).append(tot)
    got = {(r.year, r.month): r.mean_monthly_total
           for r in R.regional_monthly_mean(df, region).collect()}
    assert set(got) == set(means)
    for k, v in means.items():
        assert abs(got[k] - sum(v) / len(v)) < 1e-9


KEYS = st.one_of(st.none(), st.integers(0, 12))


@SETTINGS
@given(child=st.lists(st.tuples(KEYS, KEYS), min_size=1, max_size=80),
       parent=st.lists(KEYS, min_size=0, max_size=15))
def test_integrity_audits(spark, child, parent):
    from collections import Counter

    from boreal.operators import integrity as I
    c = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(child)],
                              "row int, k int, v int")
    p = spark.createDataFrame([(k,) for k in parent], "id int")
    # primary key (k, v): groups repeated or with a NULL part
    counts = Counter((a, b) for a, b in child)
    want_pk = {(a, b, n) for (a, b), n in counts.items() if n > 1 or a is None or b is None}
    got_pk = {(r.k, r.v, r.n_rows) for r in I.pk_violations(c, ["k", "v"]).collect()}
    assert got_pk == want_pk
    # foreign key k -> parent id: non-NULL keys without a parent; NULL kept as allowed
    parents = {k for k in parent if k is not None}
    want_orphans = sorted(i for i, (a, _) in enumerate(child) if a is not None and a not in parents)
    assert sorted(r.row for r in I.fk_orphans(c, "k", p, "id").collect()) == want_orphans
    fixed = {r.row: r.k for r in I.fk_set_null(c, "k", p, "id").collect()}
    assert fixed == {i: (a if a in parents else None) for i, (a, _) in enumerate(child)}
    # column rules in one pass
    got = {r.rule: r.violations for r in I.column_checks(
        c, {"k_null": I.not_null("k"), "v_neg": I.non_negative("v"),
            "v_range": I.in_range("v", 2, 9)}).collect()}
    assert got == {"k_null": sum(a is None for a, _ in child),
                   "v_neg": 0,
                   "v_range": sum(b is not None and not 2 <= b <= 9 for _, b in child)}


@SETTINGS
@given(suppliers=st.lists(st.tuples(st.integers(0, 5), st.sampled_from("ABC"), st.integers(0, 3)),
                          min_size=1, max_size=8),
       cities=st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["mass", "tex"])),
                       min_size=1, max_size=6),
       supply=st.lists(st.tuples(st.integers(0, 5), st.integers(0, 4), st.integers(1, 9)),
                       min_size=1, max_size=25),
       parts=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 50)), min_size=1, max_size=7),
       threshold=st.sampled_from(["-1", "10m"]))
def test_star_join_matches_four_way_join(spark, suppliers, cities, supply, parts, threshold):
    from boreal.functions.text import normalized_equals
    from boreal.operators import warehouse as W
    want = {}
    for sid, name, city in suppliers:
        for cid, state in cities:
            if cid != city or state != "mass":
                continue
            for s_sup, s_part, quan in supply:
                if s_sup != sid:
                    continue
                for pid, weight in parts:
                    if pid == s_part:
                        want[name] = want.get(name, 0) + weight * quan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    out = W.star_join_weighted_sum(
        spark.createDataFrame(suppliers, "id int, name string, city int"),
        spark.createDataFrame(cities, "id int, state string"),
        spark.createDataFrame(supply, "supplier int, part int, quan int"),
        spark.createDataFrame(parts, "id int, weight int"),
        normalized_equals("state", "mass"))
    assert {r.name: r.total_weight for r in out.collect()} == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.sampled_from("ab"),
                               st.one_of(st.none(), st.integers(-20, 20).map(lambda x: x / 4))),
                     min_size=1, max_size=120))
def test_theta_join_matches_pairs(spark, rows):
    from boreal.operators import warehouse as W
    df = spark.createDataFrame([(i, n, w) for i, (n, w) in enumerate(rows)],
                               "id int, name string, w double")
    ref = [w for n, w in rows if n == "a" and w is not None]
    want = {i: n for i, (_, w) in enumerate(rows) if w is not None and (n := sum(w > v for v in ref))}
    out = W.theta_self_join(df, "w", F.col("name") == "a", columns=("id",))
    assert {r.id: r.matches for r in out.collect()} == want
