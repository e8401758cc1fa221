"""Sinks: ordered single-file output, the many-file fallback, delimited round trips with NULLs."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from boreal import sinks
from boreal.session import scratch_path
from boreal.plans.inspect import plan_text
from boreal.sinks import _ordered, to_lines, write_csv, write_delimited, write_text
from boreal.sinks.tables import replace_table, table_version
from boreal.sources import read_delimited
from boreal.sources.schemas import TEMPERATURE_READINGS
from conftest import SF_SMALL


def _parts(path, ext):
    return sorted(glob.glob(os.path.join(path.replace("file:", ""), f"part-*{ext}")))


def test_single_csv_file_sorted(spark):
    df = spark.range(0, 500, 1, 8).select((F.col("id") * 7 % 500).alias("k"))
    path = scratch_path(spark, "single")
    write_csv(df, path, sort_columns=["k"], single_file=True)
    files = _parts(path, ".csv")
    assert len(files) == 1
    lines = open(files[0]).read().split()
    assert lines[0] == "k" and [int(x) for x in lines[1:]] == list(range(500))


def test_many_files_by_default(spark):
    df = spark.range(0, 500, 1, 8).select((F.col("id") * 7 % 500).alias("k"))
    path = scratch_path(spark, "many")
    write_text(df, path, sort_columns=["k"])
    files = _parts(path, ".txt")
    values = [int(x) for f in files for x in open(f).read().split()]
    assert values == list(range(500))  # file order follows the global order
    # the rows are range-partitioned, never funnelled into one partition, also where one file is asked for
    plan = plan_text(_ordered(df, ["k"]))
    assert "rangepartitioning" in plan and "SinglePartition" not in plan


@pytest.mark.parametrize("single_file", [True, False])
def test_descending_keys_and_ties(spark, single_file):
    df = spark.range(0, 300, 1, 6).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    path = scratch_path(spark, "down")
    write_csv(df, path, sort_columns=[F.col("k").desc(), "v"], header=False, single_file=single_file)
    values = [tuple(map(int, x.split(","))) for f in _parts(path, ".csv") for x in open(f).read().split()]
    assert values == sorted(((i % 7, i) for i in range(300)), key=lambda r: (-r[0], r[1]))


def test_text_fields_are_quoted(spark):
    rows = [("a;b", "c"), ('say "x"', None), ("line\nbreak", ""), ("plain", "d")]
    df = spark.createDataFrame(rows, "p string, q string")
    lines = [r.value for r in to_lines(df).collect()]
    assert lines == ['"a;b";c', '"say ""x""";', '"line\nbreak";', "plain;d"]
    path = scratch_path(spark, "quoted")
    write_text(df.where("p != 'line\nbreak'"), path, sort_columns=["p"])
    back = spark.read.schema("p string, q string").option("sep", ";").option("escape", '"').csv(path)
    assert sorted(r.p for r in back.collect()) == ["a;b", "plain", 'say "x"']


def test_submitted_settings_survive(tmp_path):
    """A program started by spark-submit keeps the master and partitions it was given."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ("from boreal.session import submitted_session as s; x = s('t'); "
            "print('GOT', x.sparkContext.master, x.conf.get('spark.sql.shuffle.partitions'), x.conf.get('spark.sql.session.timeZone'))")
    env = {**os.environ, "PYTHONPATH": root, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false "
           "--conf spark.sql.shuffle.partitions=777 pyspark-shell"}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=200)
    assert "GOT local[2] 777 UTC" in done.stdout, done.stderr[-2000:]


def test_no_machine_folder_on_a_cluster(monkeypatch):
    from boreal import session

    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Conf:
        get = staticmethod(lambda key, default=None: default)

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(ValueError):
        session.checkpoint_root(Session)


def test_delimited_roundtrip_keeps_positions_with_nulls(spark):
    rows = [("1", "2000-01-01", "12:00:00", None, "G"), ("2", "2000-01-02", None, 3.5, "Y")]
    df = spark.createDataFrame(rows, "station string, date string, time string, value double, "
                                     "quality string").withColumn("date", F.to_date("date"))
    path = scratch_path(spark, "delim")
    write_delimited(df, path)
    back = read_delimited(spark, path, TEMPERATURE_READINGS).orderBy("station").collect()
    assert [tuple(r) for r in back] == [tuple(r) for r in df.orderBy("station").collect()]
    path2 = scratch_path(spark, "lines")
    write_text(df, path2, sort_columns=["station"])
    back2 = read_delimited(spark, path2, TEMPERATURE_READINGS).orderBy("station").collect()
    assert [tuple(r) for r in back2] == [tuple(r) for r in df.orderBy("station").collect()]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["hour", "forecast_sum", "forecast_prod"]
    assert len(rows) == 11 and all(r.forecast_sum is not None for r in rows)


def test_registered_roundtrips(spark):
    q = entry.queries()
    assert q["delimited_roundtrip"](spark, SF_SMALL).count() == \
        spark.read.parquet(f"{SF_SMALL}/supplier.parquet").count()
    assert q["csv_sink_roundtrip"](spark, SF_SMALL).count() == \
        spark.read.parquet(f"{SF_SMALL}/customer.parquet").count()
    assert q["text_sink_roundtrip"](spark, SF_SMALL).count() == \
        spark.read.parquet(f"{SF_SMALL}/part.parquet").count()


def test_cluster_conf_sizes_partitions():
    from boreal.session import cluster_conf
    assert cluster_conf(8000, 100 * 2 ** 40)["spark.sql.shuffle.partitions"] == "50000"
    assert cluster_conf(1000, 20 * 2 ** 40)["spark.sql.shuffle.partitions"] == "20480"
    assert cluster_conf(64)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(1000)["spark.sql.shuffle.partitions"] == "3000"


def test_cluster_conf_broadcasts_by_bytes():
    from boreal.session import cluster_conf
    conf = cluster_conf(1000)
    assert 0 < int(conf["spark.sql.autoBroadcastJoinThreshold"]) <= 64 << 20
    assert 0 < int(conf["spark.sql.adaptive.autoBroadcastJoinThreshold"]) <= 64 << 20


# ---- tables replaced as a whole
DDL = "id INT, name VARCHAR(5)"


@pytest.fixture()
def place(spark):
    name = f"replaced_{uuid.uuid4().hex}"
    yield name, scratch_path(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_a_table_is_replaced_by_a_query_over_itself(spark, place):
    name, root = place
    replace_table(spark.createDataFrame([(k, f"n{k}") for k in range(10)], "id int, name string"), name, DDL, root)
    for left in (8, 6, 4):
        table = spark.table(name)
        out = replace_table(table.where(F.col("id") < left), name, DDL, root)
        assert ids(out) == ids(spark.table(name)) == list(range(left))
        assert ids(table) == list(range(left + 2))  # a reader that has begun keeps its rows


def test_a_failing_query_leaves_the_table(spark, place):
    name, root = place
    replace_table(spark.createDataFrame([(1, "a")], "id int, name string"), name, DDL, root)
    before, tables = table_version(spark, name), len(spark.catalog.listTables())
    for bad in (spark.createDataFrame([(2, "too long")], "id int, name string"),
                spark.range(3).select(F.col("id").cast("int").alias("id"), F.raise_error(F.lit("stop")).cast("string").alias("name"))):
        with pytest.raises(Exception):
            replace_table(bad, name, DDL, root)
        assert ids(spark.table(name)) == [1] and table_version(spark, name) == before
        assert len(spark.catalog.listTables()) == tables


def test_a_table_with_other_columns_is_declared_anew(spark, place):
    name, root = place
    replace_table(spark.createDataFrame([(1, "a")], "id int, name string"), name, DDL, root)
    wide = replace_table(spark.table(name).select("id", "name", F.lit(2.5).alias("price")), name, DDL + ", price DOUBLE", root)
    assert [tuple(r) for r in wide.collect()] == [(1, "a", 2.5)] and spark.table(name).columns == ["id", "name", "price"]
    longer = replace_table(spark.createDataFrame([(1, "longer name")], "id int, name string"), name, "id INT, name VARCHAR(20)", root)
    assert longer.first()["name"] == "longer name"


def test_an_empty_replacement(spark, place):
    name, root = place
    replace_table(spark.createDataFrame([(1, "a")], "id int, name string"), name, DDL, root)
    assert replace_table(spark.table(name).where("false"), name, DDL, root).count() == 0


# ---- one file, written in parallel
def test_one_file_is_written_by_many_tasks(spark):
    n = 20000
    df = spark.range(0, n, 1, 16).select((F.col("id") * 7919 % n).alias("k"), F.repeat(F.lit("x"), 20).alias("t"))
    path = scratch_path(spark, "joined")
    seen = {}
    real = sinks.join_parts

    def join(spark, parts, *rest):
        seen["parts"] = len(glob.glob(f"{parts.replace('file:', '')}/part-*"))
        return real(spark, parts, *rest)

    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    sinks.join_parts = join
    try:
        write_csv(df, path, sort_columns=[F.col("k").desc()], single_file=True)
    finally:
        sinks.join_parts = real
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    files = _parts(path, ".csv")
    lines = open(files[0]).read().splitlines()
    assert len(files) == 1 and seen["parts"] > 4 and lines[0] == "k,t"
    assert [int(x.split(",")[0]) for x in lines[1:]] == list(range(n))[::-1]
    again = spark.read.option("header", "true").csv(path)  # the reader checks the file's checksum, if any
    assert again.count() == n and not glob.glob(path.replace("file:", "") + "-parts-*")


def test_one_file_modes_and_nothing_to_write(spark):
    path = scratch_path(spark, "modes")
    one = spark.createDataFrame([(1, "a")], "k int, t string")
    write_text(one, path, single_file=True)
    with pytest.raises(ValueError, match="exists"):
        write_text(one, path, single_file=True)
    write_text(one.where("false"), path, single_file=True, mode="ignore")
    assert [r.value for r in spark.read.text(path).collect()] == ["1;a"]
    write_csv(one.where("false"), path, single_file=True, mode="overwrite")
    assert open(_parts(path, ".csv")[0]).read() == "k,t\n"
    write_csv(one.where("false"), path, single_file=True, mode="overwrite", header=False)
    assert open(_parts(path, ".csv")[0]).read() == ""
