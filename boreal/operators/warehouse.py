"""Warehouse questions as parameterised DataFrame jobs.

Each function takes the tables and the names of the columns playing each role, so the same job
answers the question on any schema. ``IN (subquery)`` becomes a left semi join, scalar subqueries
stay scalar subqueries (run once, then a pushed-down filter); Catalyst and AQE broadcast small sides
by their size in bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from boreal.functions.text import text_before
from boreal.operators.joins import fits_broadcast, semi_join, staged
from boreal.sinks.tables import replace_table


def list_all(table: DataFrame) -> DataFrame:
    return table


def manager_employee(people: DataFrame, *, key: str = "id", manager: str = "manager",
                     name: str = "name", columns=()) -> DataFrame:
    """Each person with the name of their manager (an equi self-join; no manager, no row)."""
    m = people.select(F.col(key).alias("__mid"), F.col(name).alias("__mname"))
    e = people.alias("e")
    return (e.join(m, F.col(f"e.{manager}") == F.col("__mid"))
            .select(F.col("__mname").alias("manager"), F.col(f"e.{name}").alias("employee"),
                    *[F.col(f"e.{c}") for c in columns]))


def with_tie_breakers(table: DataFrame, columns) -> list:
    """The sort keys followed by every other column: ties keep any order the keys allow, and the
    range partitioner can split a sort value held by a large share of rows across partitions."""
    keys = [c if not isinstance(c, str) else F.col(c) for c in columns]
    named = {c for c in columns if isinstance(c, str)}
    return keys + [F.col(c) for c in table.columns if c not in named]


def sorted_by(table: DataFrame, *columns: str) -> DataFrame:
    return table.orderBy(*with_tie_breakers(table, columns))


def equality_filter(table: DataFrame, column: str, value, *,
                    not_null: str | None = None) -> DataFrame:
    cond = F.col(column) == F.lit(value)
    if not_null:
        cond = F.col(not_null).isNotNull() & cond
    return table.where(cond)


def between_sorted(table: DataFrame, column: str, low, high) -> DataFrame:
    inside = table.where(F.col(column).between(low, high))
    return inside.orderBy(*with_tie_breakers(inside, [column]))


def with_derived(table: DataFrame, name: str, expr: Column) -> DataFrame:
    """All columns plus one computed column."""
    return table.select("*", expr.alias(name))


def prefix_suffix_like(table: DataFrame, column: str, sep: str, suffix: str) -> DataFrame:
    """Rows whose text before ``sep`` ends with ``suffix`` (every character taken literally)."""
    return table.where(text_before(column, sep).endswith(suffix))


def in_subquery(facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str,
                dim_filter: Column | None = None) -> DataFrame:
    """``facts WHERE fact_key IN (SELECT dim_key FROM dim WHERE dim_filter)``."""
    keys = dim if dim_filter is None else dim.where(dim_filter)
    return semi_join(facts, keys, fact_key, dim_key)


def join_filter(facts: DataFrame, fact_key: str, dim: DataFrame, dim_key: str,
                dim_filter: Column, dim_columns=()) -> DataFrame:
    """``facts.*, dim columns``: the facts joined to the filtered dimension (a row per match)."""
    d = dim.where(dim_filter).select(F.col(dim_key).alias("__dk"),
                                     *[F.col(c).alias(c) for c in dim_columns])
    return (facts.alias("f").join(d.alias("d"), F.col(f"f.{fact_key}") == F.col("d.__dk"))
            .select("f.*", *[F.col(f"d.{c}") for c in dim_columns]))


def count_rows(table: DataFrame, alias: str = "n") -> DataFrame:
    return table.agg(F.count(F.lit(1)).alias(alias))


def scalar_subquery_compare(table: DataFrame, column: str, reference_filter: Column,
                            columns=(), op: str = ">") -> DataFrame:
    """Rows whose ``column`` compares ``op`` with the value of the one row matching
    ``reference_filter`` (an uncorrelated scalar subquery: more than one row is an error)."""
    ref = table.where(reference_filter).select(column).scalar()
    cond = {">": F.col(column) > ref, "<": F.col(column) < ref, ">=": F.col(column) >= ref,
            "<=": F.col(column) <= ref}[op]
    out = table.where(cond)
    return out.select(*columns) if columns else out


def theta_self_join(table: DataFrame, column: str, reference_filter: Column, columns=(),
                    alias: str = "matches") -> DataFrame:
    """``t1.columns, count(*) FROM t t1, t t2 WHERE t1.column > t2.column AND reference_filter(t2)``
    per row of ``t1``: each row with a smaller reference value once, with the number of them.

    The rows below each *distinct* value are counted along the sorted values: distinct values are
    range-partitioned (any orderable type, compared natively), reference rows are counted cumulatively
    within each range, and each range starts from the total of the ranges before it (one row per
    range). The counts are joined back to the rows on the value. No pair is ever formed, whatever the
    number of reference rows; a value that many rows share is one row per task until the last join,
    where AQE splits it. NULL compares with nothing. Distinct values and their ranges are each written once to the
    shared folder: the range shuffle samples the former, not the table.
    """
    values = (table.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("__v"))
              .agg(F.count_if(reference_filter).alias("__r")))
    values = staged(values, "theta-values")
    ranged = staged(values.repartitionByRange("__v").withColumn("__range", F.spark_partition_id()), "theta-ranges")
    totals = ranged.groupBy("__range").agg(F.sum("__r").alias("__t"))
    before = F.sum("__t").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    starts = totals.select("__range", F.coalesce(before, F.lit(0)).alias("__start"))
    lower = F.sum("__r").over(Window.partitionBy("__range").orderBy("__v")
                              .rowsBetween(Window.unboundedPreceding, -1))
    counts = (ranged.join(starts, "__range")
              .select("__v", (F.col("__start") + F.coalesce(lower, F.lit(0))).alias(alias))
              .where(F.col(alias) > 0))
    return (table.alias("t1").join(counts, F.col(f"t1.{column}") == F.col("__v"))
            .select(*[F.col(f"t1.{c}") for c in columns or table.columns], alias))


def constant_filtered_avg(table: DataFrame, key: str, key_value, value: str,
                          alias: str = "avg_value") -> DataFrame:
    """Mean of ``value`` over the rows where ``key = key_value``, shown with the key."""
    return (table.where(F.col(key) == F.lit(key_value)).groupBy(key)
            .agg(F.avg(value).alias(alias)))


def star_join_weighted_sum(suppliers: DataFrame, cities: DataFrame, supply: DataFrame,
                           parts: DataFrame, city_filter: Column, *,
                           supplier_id: str = "id", supplier_name: str = "name",
                           supplier_city: str = "city", city_id: str = "id",
                           supply_supplier: str = "supplier", supply_part: str = "part",
                           supply_quantity: str = "quan", part_id: str = "id",
                           part_weight: str = "weight", alias: str = "total_weight") -> DataFrame:
    """Per supplier name: ``sum(part weight * supplied quantity)`` over suppliers in the cities
    matching ``city_filter`` (supplier - city - supply - part).

    When the supplier and the part table are small enough to broadcast (Catalyst's estimate in
    bytes), the facts meet them map-side and are aggregated once. Otherwise the facts are summed per
    (supplier, part) before they meet a shuffled side, so those joins see one row per supplied part,
    not one per shipment. Duplicated dimension keys multiply the answer exactly as the four-way join
    would (their multiplicity is carried as a count).
    """
    chosen_cities = (cities.where(city_filter).groupBy(F.col(city_id).alias("__cid"))
                     .agg(F.count(F.lit(1)).alias("__cmult")))
    part_weights = parts.select(F.col(part_id).alias("__p"), F.col(part_weight).alias("__w"))
    named = suppliers.select(F.col(supplier_id).alias("__sid"), F.col(supplier_name).alias("name"),
                             F.col(supplier_city).alias("__cid"))
    chosen = named.join(chosen_cities, "__cid").select("__sid", "name", "__cmult")
    if fits_broadcast(named) and fits_broadcast(part_weights):
        rows = (supply.join(F.broadcast(chosen), F.col(supply_supplier) == F.col("__sid"))
                .join(part_weights, F.col(supply_part) == F.col("__p")))
        return rows.groupBy("name").agg(
            F.sum(F.col("__w") * F.col(supply_quantity) * F.col("__cmult")).alias(alias))
    per_part = (supply.groupBy(F.col(supply_supplier).alias("__s"), F.col(supply_part).alias("__p"))
                .agg(F.sum(supply_quantity).alias("__q")))
    weighted = (semi_join(per_part, chosen, "__s", "__sid").join(part_weights, "__p")
                .groupBy("__s").agg(F.sum(F.col("__w") * F.col("__q")).alias("__t")))
    return (weighted.join(chosen, F.col("__s") == F.col("__sid"))
            .groupBy("name").agg(F.sum(F.col("__t") * F.col("__cmult")).alias(alias)))


def below_average_table(spark: SparkSession, table: DataFrame, column: str, table_name: str,
                        columns_ddl: str, location: str) -> DataFrame:
    """Create a table with explicitly declared columns and fill it with the rows whose ``column``
    is below the table's mean (a global aggregate used as a scalar subquery); return it read back.

    Any earlier table of that name is replaced as a whole when the new rows are written, not before
    (``sinks.replace_table``): ``table`` may be that very table. Files go under ``location``, a folder in shared
    storage. Spark enforces the declared VARCHAR lengths on write.
    """
    below = table.where(F.col(column) < table.select(F.avg(column)).scalar())
    return replace_table(below, table_name, columns_ddl, location)
