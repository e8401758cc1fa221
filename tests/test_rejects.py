"""Good rows and rejected lines of delimited text."""

import random

import pytest
from pyspark.sql import types as T

from boreal.plans.inspect import plan_text
from boreal.session import scratch_path
from boreal.sources import TEMPERATURE_READINGS, read_delimited, split_delimited

GOOD = ["102170;2013-11-01;06:00:00;6.8;G", "102170;2013-11-01;18:00:00;-3.8;Y", "\"1;2\";2013-11-02;06:00:00;5.8;G", ";;;;"]
BAD = ["102170;2013-13-41;06:00:00;6.8;G", "102170;2013-11-01;06:00:00;warm;G", "102170;2013-11-01", "one field",
       "1;2013-11-01;06:00:00;6.8;G;extra", "1;2013-11-01;06:00:00;;G;", "1;yesterday;x;1;G"]


def split(spark, tmp_path, files):
    src = tmp_path / "lines"
    src.mkdir()
    for name, lines in files.items():
        (src / name).write_text("".join(x + "\n" for x in lines))
    return split_delimited(spark, str(src), TEMPERATURE_READINGS, scratch_path(spark, "split"))


def test_good_rows_and_rejects_are_all_lines(spark, tmp_path):
    rnd = random.Random(1)
    files = {f"f{k}.csv": [rnd.choice(GOOD + BAD) for _ in range(50)] + [""] for k in range(4)}
    lines = [x for f in files.values() for x in f if x]
    good, rejects = split(spark, tmp_path, files)
    assert good.schema == TEMPERATURE_READINGS and rejects.columns == ["line", "file"]
    assert sorted(r["line"] for r in rejects.collect()) == sorted(x for x in lines if x in BAD)
    assert good.count() == sum(x in GOOD for x in lines)
    for r in rejects.collect():
        assert r["line"] in files[r["file"]]
    assert {r["station"] for r in good.collect()} <= {"102170", "1;2", None}


def test_good_rows_are_those_of_the_strict_scan(spark, tmp_path):
    good, rejects = split(spark, tmp_path, {"a.csv": GOOD})
    strict = read_delimited(spark, str(tmp_path / "lines"), TEMPERATURE_READINGS)
    assert sorted(map(str, good.collect())) == sorted(map(str, strict.collect())) and rejects.count() == 0


def test_only_bad_lines_and_no_lines(spark, tmp_path):
    good, rejects = split(spark, tmp_path, {"a.csv": BAD})
    assert good.count() == 0 and rejects.count() == len(BAD)
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "none.csv").write_text("")
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    good, rejects = split_delimited(spark, str(tmp_path / "empty"), schema, scratch_path(spark, "split"))
    assert good.count() == 0 and rejects.count() == 0


def test_each_side_reads_its_own_folder(spark, tmp_path):
    good, rejects = split(spark, tmp_path, {"a.csv": GOOD + BAD})
    assert "__rejected" in plan_text(good) and "PartitionFilters: [isnotnull" in plan_text(good)
    with pytest.raises(Exception):
        split_delimited(spark, str(tmp_path / "missing"), TEMPERATURE_READINGS, scratch_path(spark, "split"))[0].count()
