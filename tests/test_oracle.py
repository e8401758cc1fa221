"""Every registered job against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_ORACLE
from oracle_util import compare, duck

SQL = entry.oracle_sql()
QUERIES = {k: f for k, f in entry.queries().items() if f.__module__ == "boreal.plans.bindings"}


@pytest.fixture(scope="module")
def con():
    return duck(SF_ORACLE)


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_ORACLE), SQL[name], con)
    assert ok, f"{name}: {msg}"


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"pk_violations"}))
def test_no_result_is_empty(con, name):
    """An operator that returned nothing would fail its comparison (the keys of the shipments have no violation)."""
    assert con.execute(f"SELECT count(*) FROM ({SQL[name]})").fetchone()[0] > 0
    for column, kind, *_ in con.execute(f"DESCRIBE {SQL[name]}").fetchall():
        if name in ("count_in_subquery", "column_checks") and kind == "BIGINT":
            assert con.execute(f"SELECT max({column}) FROM ({SQL[name]})").fetchone()[0] > 0


FILTERS = {"equality_filter": "orders", "between_sorted": "customer", "prefix_suffix_like": "part", "in_subquery": "lineitem",
           "join_filter": "lineitem", "in_subquery_distinct": "part", "scalar_subquery_compare": "part", "theta_self_join": "part",
           "below_average_table": "part", "fk_orphans": "lineitem", "lookback_filter": "lineitem", "key_list_readings": "supplier",
           "manager_employee": "supplier"}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
@pytest.mark.parametrize("name", sorted(FILTERS))
def test_filters_keep_some_rows_and_drop_some(name, sf):
    from oracle_util import duck
    data = duck(SF_ORACLE.replace("sf0.01", sf))
    kept, all_rows = (data.execute(f"SELECT count(*) FROM {x}").fetchone()[0] for x in (f"({SQL[name]})", FILTERS[name]))
    if name == "manager_employee":  # few managers exist in the smallest table
        assert 0 < kept <= all_rows
    else:
        assert 0 < kept < all_rows, (kept, all_rows)


def test_every_column_rule_but_the_primary_ones_finds_something(con):
    found = dict(con.execute(SQL["column_checks"]).fetchall())
    assert {r for r, n in found.items() if n} >= {"l_partkey_not_null", "balance_non_negative", "l_discount_in_0_0.05",
                                                   "l_shipmark_max_length_3", "l_shipdate_is_default"}
