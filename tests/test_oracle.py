"""Every registered query against its DuckDB oracle (row count, columns, values)."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_compare import compare, duck

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_an_oracle():
    from tripmart.plans.catalog import REGISTRY

    assert set(REGISTRY) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, QUERIES[name], ORACLE[name], SF001)
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["year_month", "month_name", "trip_count"]
    assert df.count() >= 0


def test_column_metadata(spark):
    from tripmart.plans.catalog import _keyed_tables
    from tripmart.plans.queries import q21_column_metadata

    rows = q21_column_metadata(_keyed_tables(spark, SF001)).collect()
    tables = {r.table_name for r in rows}
    assert tables == {"fct_trips", "dim_date", "dim_zones", "dim_service_type", "dim_payment_type",
                      "dim_vendors"}
    fact = [r.column_name for r in sorted(rows, key=lambda r: r.ordinal_position)
            if r.table_name == "fct_trips"]
    assert fact[0] == "trip_key" and len(fact) == 25


def test_literal_dimensions_and_calendar(spark, con):
    """Dimensions that read no table: compared with the oracle's VALUES/calendar."""
    from tripmart.oracle import with_base
    from tripmart.plans.pipeline import testdata_tables

    gold = testdata_tables(spark, SF001).gold
    for name, cte in (("dim_service_type", "t_dim_service_type"), ("dim_payment_type", "t_dim_payment_type"),
                      ("dim_vendors", "t_dim_vendors"), ("dim_date", "t_dim_date")):
        text = ["date"] if name == "dim_date" else []
        ok, msg = compare(spark, con, name, lambda s, sf, n=name: E._canon(gold.dims()[n].df),
                          with_base(f"SELECT * FROM {cte}", text_cols=text), SF001)
        assert ok, (name, msg)
