"""The company questions over the ten company tables (``jbemployee``, ``jbdept``, ``jbitem``,
``jbparts``, ``jbsupply``, ``jbsale``, ``jbdebit``, ``jbcity``, ``jbstore``, ``jbsupplier``), plus
the key audits their declared constraints imply.

``load_tables`` reads them from ``<dir>/<name>.parquet`` (or CSV with a header) with the declared
schemas; ``answers`` returns one DataFrame per question; ``audits`` one per key constraint.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boreal.functions.text import normalized_equals
from boreal.operators import integrity as I
from boreal.operators import warehouse as W
from boreal.sources.schemas import COMPANY

# The names the questions look for.
SUPPLIER_NAME = "fisher-price"
REFERENCE_PART = "card reader"
PART_COLOR = "black"
STATE = "mass"

PRIMARY_KEYS = {"jbemployee": ["id"], "jbdept": ["id"], "jbitem": ["id"], "jbparts": ["id"],
                "jbsupply": ["supplier", "part", "shipdate"], "jbsale": ["debit", "item"],
                "jbdebit": ["id"], "jbcity": ["id"], "jbstore": ["id"], "jbsupplier": ["id"]}
FOREIGN_KEYS = [("jbdept", "store", "jbstore"), ("jbdept", "manager", "jbemployee"),
                ("jbitem", "dept", "jbdept"), ("jbitem", "supplier", "jbsupplier"),
                ("jbsupply", "supplier", "jbsupplier"), ("jbsupply", "part", "jbparts"),
                ("jbsale", "item", "jbitem"), ("jbsale", "debit", "jbdebit"),
                ("jbdebit", "employee", "jbemployee"), ("jbstore", "city", "jbcity"),
                ("jbsupplier", "city", "jbcity"), ("jbemployee", "manager", "jbemployee")]
#: Keys that become NULL when the row they name is deleted: (table, column, table named).
SET_NULL = [("jbdept", "manager", "jbemployee"), ("jbemployee", "manager", "jbemployee")]
# The columns and keys declared for the table of question 14.
ITEMS_DDL = "id INT NOT NULL, name VARCHAR(20), dept INT NOT NULL, price INT, qoh INT, supplier INT NOT NULL"
ITEMS_PRIMARY_KEY = ["id"]
ITEMS_FOREIGN_KEYS = [("dept", "jbdept"), ("supplier", "jbsupplier")]

# The column rules the schema declares (NOT NULL, VARCHAR lengths, qoh >= 0).
NOT_NULL = {"jbdept": ["store"], "jbitem": ["dept", "supplier"],
            "jbsupply": ["supplier", "part", "shipdate"], "jbsale": ["debit", "item"],
            "jbdebit": ["sdate", "employee", "account"], "jbstore": ["city"],
            "jbsupplier": ["city"]}
MAX_LENGTH = {"jbemployee": {"name": 20}, "jbdept": {"name": 20}, "jbitem": {"name": 20},
              "jbparts": {"name": 20, "color": 8}, "jbcity": {"name": 15, "state": 6},
              "jbsupplier": {"name": 20}}
NON_NEGATIVE = {"jbitem": ["qoh"]}


def column_rules(table: str) -> dict:
    rules = {f"{c}_not_null": I.not_null(c) for c in NOT_NULL.get(table, [])}
    rules.update({f"{c}_max_length_{n}": I.max_length(c, n)
                  for c, n in MAX_LENGTH.get(table, {}).items()})
    rules.update({f"{c}_non_negative": I.non_negative(c) for c in NON_NEGATIVE.get(table, [])})
    return rules


def load_tables(spark: SparkSession, data_dir: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    out = {}
    for name, schema in COMPANY.items():
        path = os.path.join(data_dir, f"{name}.{fmt}")
        reader = spark.read.schema(schema)
        out[name] = reader.parquet(path) if fmt == "parquet" else \
            reader.option("header", "true").csv(path)
    return out


def answers(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    emp, parts = t["jbemployee"], t["jbparts"]
    card_reader = normalized_equals("name", REFERENCE_PART)
    fisher_price = normalized_equals("name", SUPPLIER_NAME)
    return {
        "q01_list_all": W.list_all(emp),
        "q01_manager_employee": W.manager_employee(
            emp, columns=("salary", "birthyear", "startyear")),
        "q02_departments_by_name": W.sorted_by(t["jbdept"].where(F.col("id").isNotNull()), "name"),
        "q03_parts_out_of_stock": W.equality_filter(parts, "qoh", 0, not_null="id"),
        "q04_salary_9000_10000": W.between_sorted(emp, "salary", 9000, 10000),
        "q05_age_at_start": W.with_derived(emp, "age", F.col("startyear") - F.col("birthyear")),
        "q06_last_name_son": W.prefix_suffix_like(emp, "name", ",", "son"),
        "q07_items_by_subquery": W.in_subquery(t["jbitem"], "supplier", t["jbsupplier"], "id",
                                               fisher_price),
        "q08_items_by_join": W.join_filter(
            t["jbitem"], "supplier", t["jbsupplier"].withColumnRenamed("name", "supplier_name"),
            "id", normalized_equals("supplier_name", SUPPLIER_NAME),
            dim_columns=("supplier_name",)),
        "q09_cities_with_suppliers": W.in_subquery(t["jbcity"], "id", t["jbsupplier"], "city"),
        "q09_count_cities_with_suppliers": W.count_rows(
            W.in_subquery(t["jbcity"], "id", t["jbsupplier"], "city")),
        "q10_heavier_than_card_reader": W.scalar_subquery_compare(
            parts, "weight", card_reader, columns=("name", "color")),
        "q11_heavier_by_self_join": W.theta_self_join(parts, "weight", card_reader,
                                                      columns=("name", "color")).drop("matches"),
        "q12_black_parts_avg_weight": W.constant_filtered_avg(parts, "color", PART_COLOR,
                                                              "weight", "avg_weight"),
        "q13_weight_per_supplier_in_state": W.star_join_weighted_sum(
            t["jbsupplier"], t["jbcity"], t["jbsupply"], parts, normalized_equals("state", STATE)),
    }


def below_average_items(spark: SparkSession, t: dict[str, DataFrame], location: str,
                        table_name: str = "jbitems") -> DataFrame:
    """Question 14: a new table of the items cheaper than the mean price."""
    return W.below_average_table(spark, t["jbitem"], "price", table_name, ITEMS_DDL, location)


def items_audits(items: DataFrame, t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The key and column audits of the table of question 14 (empty, or counts of 0, when clean)."""
    out = {"pk": I.pk_violations(items, ITEMS_PRIMARY_KEY),
           "check": I.column_checks(items, column_rules("jbitem"))}
    out.update({f"fk_{column}": I.fk_orphans(items, column, t[parent], "id") for column, parent in ITEMS_FOREIGN_KEYS})
    return out


def after_deletes(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``ON DELETE SET NULL``: managers that are no longer employees become NULL."""
    out = dict(t)
    for child, column, parent in SET_NULL:
        out[child] = I.fk_set_null(t[child], column, t[parent], "id")
    return out


def with_defaults(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Rows written without a debit time get the current timestamp (the column's default)."""
    return {**t, "jbdebit": I.with_default(t["jbdebit"], "sdate", F.current_timestamp())}


def audits(t: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """``pk_<table>`` / ``fk_<table>_<column>``: violating keys or rows (empty when clean);
    ``check_<table>``: violations per declared column rule (one pass per table)."""
    out = {f"pk_{name}": I.pk_violations(t[name], keys) for name, keys in PRIMARY_KEYS.items()}
    for child, column, parent in FOREIGN_KEYS:
        out[f"fk_{child}_{column}"] = I.fk_orphans(t[child], column, t[parent], "id")
    for name in t:
        rules = column_rules(name)
        if rules:
            out[f"check_{name}"] = I.column_checks(t[name], rules)
    return out
