"""Tables that are replaced as a whole.

A replacement writes all rows to a new folder first and then points the table there, which is one change in the
catalog: readers see the old rows or the new ones, a failing query leaves the table as it was, and a table can be
replaced by a query over itself. Superseded folders stay for readers that have begun; ``table_version`` names the one in use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _columns(spark: SparkSession, name: str) -> list[tuple[str, str]]:
    """Declared names and types, VARCHAR lengths included."""
    rows = spark.sql(f"DESCRIBE TABLE {name}").select("col_name", "data_type").collect()
    return [(r[0], r[1]) for r in rows]


def replace_table(df: DataFrame, name: str, columns_ddl: str, root: str) -> DataFrame:
    """Make ``name`` a parquet table of the declared columns that holds the rows of ``df``; return it read back.

    The rows go into a table of their own under ``root`` (a folder in shared storage), so that Spark checks them
    against the declared types; only when all are there, ``name`` is switched to that folder. A table that had other
    columns is dropped and declared anew at that moment (its files stay). Concurrent replacements: the last switch wins.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    location = f"{root.rstrip('/')}/version-{version}"
    incoming = f"{name}_incoming_{version}"
    spark.sql(f"CREATE TABLE {incoming} ({columns_ddl}) USING parquet LOCATION '{location}'")
    try:
        df.write.insertInto(incoming)
        same = spark.catalog.tableExists(name) and _columns(spark, name) == _columns(spark, incoming)
    finally:
        spark.sql(f"DROP TABLE {incoming}")  # declared with a location: its files stay
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns_ddl}) USING parquet LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def table_version(spark: SparkSession, name: str) -> str:
    """The folder that ``name`` points to at present."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0]
