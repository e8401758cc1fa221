"""Table audits: primary keys, foreign keys and column rules, each over a whole table in one job.

A relational engine checks these per row on write; on Spark the useful form is a job that reports
(or repairs) all violations of a table at once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boreal.operators.joins import fits_broadcast, key_side, staged


def pk_violations(table: DataFrame, keys) -> DataFrame:
    """Key values that are NULL or appear more than once: ``keys..., n_rows, violation``.

    A grouped count with map-side combine: a key repeated on a third of all rows is one partial
    row per task before the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where((F.col("n_rows") > 1) | any_null)
            .withColumn("violation", F.when(any_null, F.lit("null_key"))
                        .otherwise(F.lit("duplicate_key"))))


def orphan_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """The distinct non-NULL child keys without a parent, as ``__k``: only distinct keys are shuffled, each
    side's combined map-side."""
    parents = key_side(parent, parent_key).withColumnRenamed("__k", "__p")
    return key_side(child, child_key).join(parents, F.col("__k") == F.col("__p"), "left_anti")


def fk_orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent (NULL child keys are allowed).

    With parent keys small enough to broadcast: one scan of the child against them. With more, in two phases:
    distinct child keys meet the parent's and the orphans among them are staged; then the child rows meet those.
    Orphans are few as a rule: their staged size lets Catalyst broadcast them, and no child row moves; if they are many,
    child rows are shuffled once.
    """
    keys = key_side(parent, parent_key)
    if fits_broadcast(keys):
        present = child.where(F.col(child_key).isNotNull())
        return present.join(keys, present[child_key] == keys["__k"], "left_anti")
    missing = staged(orphan_keys(child, child_key, parent, parent_key), "orphan-keys")
    return child.join(missing, child[child_key] == missing["__k"], "left_semi")


# NULL keys spread over so many hash values in a shuffled outer join.
NULL_SPREAD = 4096


def fk_set_null(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """``ON DELETE SET NULL`` after parents are gone: every child row, dangling keys set to NULL.

    In one pass against the parent's keys where those are small enough to broadcast, else in the two phases of
    ``fk_orphans``. NULL keys match nothing; in a shuffled join a second key, 0 for all other rows, spreads them over
    many partitions instead of one.
    """
    keys = key_side(parent, parent_key)
    known = fits_broadcast(keys)
    if not known:
        keys = staged(orphan_keys(child, child_key, parent, parent_key), "orphan-keys")
    keys = keys.select("__k", F.lit(0).alias("__kz"), F.lit(True).alias("__met"))
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in child.columns]), F.lit(NULL_SPREAD)) + 1
    rows = child.withColumn("__z", F.when(F.col(child_key).isNull(), spread).otherwise(0).cast("int"))
    joined = rows.join(keys, (rows[child_key] == keys["__k"]) & (rows["__z"] == keys["__kz"]), "left")
    kept = F.col("__met") if known else F.col("__met").isNull()
    fixed = F.when(kept, rows[child_key])
    return joined.select(*[fixed.alias(c) if c == child_key else rows[c] for c in child.columns])


# Column rules: each returns a Column that is true on a *violating* row.
def not_null(column: str) -> Column:
    return F.col(column).isNull()


def non_negative(column: str) -> Column:
    return F.col(column) < 0


def max_length(column: str, n: int) -> Column:
    return F.length(F.col(column)) > n


def in_range(column: str, low, high) -> Column:
    return ~F.col(column).between(low, high)


def column_checks(table: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Violations per rule (``rule, violations``), all rules in one pass over the table."""
    names = list(rules)
    counts = table.agg(*[F.sum(F.when(rules[n], 1).otherwise(0)).cast("long").alias(f"r{i}")
                         for i, n in enumerate(names)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("rule"), F.coalesce(F.col(f"r{i}"), F.lit(0)).alias("violations"))
        for i, n in enumerate(names)])))


def with_default(table: DataFrame, column: str, default: Column) -> DataFrame:
    """Fill a missing value with a default (``DEFAULT ...`` for rows written without it)."""
    return table.withColumn(column, F.coalesce(F.col(column), default))
