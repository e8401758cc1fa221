"""The packaged question sets: weather files (and the command line) and the company tables."""

import glob
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from boreal.plans import company_questions as CQ
from boreal.plans import weather_questions as WQ
from boreal.session import scratch_path
from company_tables import company_tables
from test_readings import PRECIPITATION_LINES, REGION_LINES, TEMPERATURE_LINES

STATION_LINES = """\
100;Station A;12;58.4;15.6
200;Station B;30;59.3;18.0
300;Station C;40;58.1;16.1
400;Station D;5;57.7;12.0
500;Station E;8;63.8;20.3
600;Station F;2;55.6;13.0
700;Station G;90;67.8;20.2
"""
# readings on the forecast's look-back window, so every hour has weights
FORECAST_LINES = "".join(f"{100 * (1 + i % 7)};2013-0{1 + i % 6}-1{i % 9};{(i * 5) % 24:02d}:00:00;"
                         f"{(i % 30) - 5}.5;G\n" for i in range(120))


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("weather")
    out = {}
    for name, text in [("temperature", TEMPERATURE_LINES + FORECAST_LINES),
                       ("precipitation", PRECIPITATION_LINES), ("region", REGION_LINES),
                       ("stations", STATION_LINES)]:
        (d / f"{name}.csv").write_text(text)
        out[name] = str(d / f"{name}.csv")
    return out


def test_weather_answers(spark, files):
    res = WQ.answers(spark, files["temperature"], files["precipitation"], files["region"],
                     files["stations"])
    assert len(res) == 12
    assert [tuple(r) for r in res["extremes_band_join"].collect()] == [("100", 28.0, 120.0)]
    assert [tuple(r) for r in res["regional_monthly_mean"].collect()] == [(2000, 7, 150.0),
                                                                          (2000, 6, 120.0)]
    f = res["kernel_regression"].collect()
    assert len(f) == 11 and all(r.forecast_sum is not None for r in f)
    assert {r.kernel for r in res["kernel_peak_hour"].collect()} == {"sum", "prod"}
    staged = WQ.answers(spark, files["temperature"], files["precipitation"], files["region"],
                        files["stations"], stage_dir=scratch_path(spark, "stage"))
    for name in ("yearly_extrema", "monthly_exceedance_station_count", "regional_monthly_mean",
                 "kernel_regression"):
        assert sorted(map(tuple, staged[name].collect())) == \
            sorted(map(tuple, res[name].collect())), name
    out = scratch_path(spark, "weather-answers")
    WQ.write_answers(res, out)
    files_written = glob.glob(os.path.join(out.replace("file:", ""), "*", "part-*.csv"))
    assert {os.path.basename(os.path.dirname(f)) for f in files_written} == set(res)

    def stored(name):
        parts = sorted(glob.glob(os.path.join(out.replace("file:", ""), name, "part-*.csv")))
        return [line.split(",") for f in parts for line in open(f).read().split()[1:]]

    for name in ("monthly_exceedance_count", "monthly_exceedance_station_count"):
        counts = [int(r[2]) for r in stored(name)]
        assert counts == sorted(counts, reverse=True) and counts
    means = [float(r[3]) for r in stored("station_monthly_mean")]
    assert means == sorted(means, reverse=True)
    assert [int(r[0]) for r in stored("kernel_regression")] == [0, 22, 20, 18, 16, 14, 12, 10, 8, 6, 4]
    assert stored("regional_monthly_mean")[0][:2] == ["2000", "7"]


def test_weather_command_line(files, tmp_path):
    out = tmp_path / "answers"
    cmd = [sys.executable, "-m", "boreal.plans.weather_questions",
           "--temperature", files["temperature"], "--precipitation", files["precipitation"],
           "--region-stations", files["region"], "--stations", files["stations"],
           "--out", str(out)]
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run(cmd, cwd=root, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    extrema = glob.glob(str(out / "yearly_extrema" / "part-*.csv"))
    assert len(extrema) == 1
    lines = open(extrema[0]).read().split()
    assert lines[0] == "year,min_value,max_value" and lines[1].startswith("1950,")


def test_company_answers_and_audits(spark):
    t = company_tables(spark)
    res = CQ.answers(t)
    counts = {k: v.count() for k, v in res.items()}
    assert counts == {
        "q01_list_all": 25, "q01_manager_employee": 23, "q02_departments_by_name": 19,
        "q03_parts_out_of_stock": 4, "q04_salary_9000_10000": 4, "q05_age_at_start": 25,
        "q06_last_name_son": 1, "q07_items_by_subquery": 3, "q08_items_by_join": 3,
        "q09_cities_with_suppliers": 15, "q09_count_cities_with_suppliers": 1,
        "q10_heavier_than_card_reader": 4, "q11_heavier_by_self_join": 4,
        "q12_black_parts_avg_weight": 1, "q13_weight_per_supplier_in_state": 2}
    assert res["q12_black_parts_avg_weight"].first().avg_weight == 347.25
    assert res["q09_count_cities_with_suppliers"].first().n == 15
    items = CQ.below_average_items(spark, t, scratch_path(spark, "jbitems"), "jbitems_q14")
    assert items.count() == 14
    assert {name: (df.where("violations > 0") if name == "check" else df).count()
            for name, df in CQ.items_audits(items, t).items()} == {"pk": 0, "check": 0, "fk_dept": 0, "fk_supplier": 0}
    long = {**t, "jbitem": t["jbitem"].withColumn("name", F.lit("x" * 21))}
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH|exceeds"):
        CQ.below_average_items(spark, long, scratch_path(spark, "jbitems"), "jbitems_long")
    result = CQ.audits(CQ.with_defaults(t))
    assert all(df.count() == 0 for name, df in result.items() if not name.startswith("check"))
    checks = {(name, r.rule): r.violations for name, df in result.items()
              if name.startswith("check") for r in df.collect()}
    assert len(checks) == sum(len(CQ.column_rules(n)) for n in t) == 22
    assert set(checks.values()) == {0}
    # a bad row is reported by its rule only
    bad = {**t, "jbparts": t["jbparts"].unionByName(spark.createDataFrame(
        [(99, "x" * 21, "ultraviolet", 1, -1)], t["jbparts"].schema))}
    got = {r.rule: r.violations for r in CQ.audits(bad)["check_jbparts"].collect()}
    assert got == {"name_max_length_20": 1, "color_max_length_8": 1}
    assert CQ.with_defaults(t)["jbdebit"].where(F.col("sdate").isNull()).count() == 0


def test_managers_become_null_when_they_leave(spark):
    t = company_tables(spark)
    gone = min({r.manager for r in t["jbdept"].collect()} & {r.manager for r in t["jbemployee"].collect()} - {None})
    left = {**t, "jbemployee": t["jbemployee"].where(F.col("id") != gone)}
    fixed = CQ.after_deletes(left)
    for name in ("jbdept", "jbemployee"):
        before = {r.id: r.manager for r in left[name].collect()}
        after = {r.id: r.manager for r in fixed[name].collect()}
        assert gone in before.values()
        assert after == {i: None if m == gone else m for i, m in before.items()}
        assert fixed[name].columns == t[name].columns


def test_company_tables_load_from_files(spark, tmp_path):
    t = company_tables(spark)
    for name, df in t.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    loaded = CQ.load_tables(spark, str(tmp_path))
    assert {k: v.count() for k, v in loaded.items()} == {k: v.count() for k, v in t.items()}
