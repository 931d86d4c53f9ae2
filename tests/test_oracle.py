"""Every registered query against its DuckDB oracle at sf0.01 (and the
smoke entry at sf0.001)."""

import pytest

import __spark_entry__ as E
from slicewright.plans import catalog
from tools.check_oracle import compare

from .conftest import SF01


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["date", "ad_unit_name", "unfilled_impressions", "code_served_count",
                          "responses_served", "ad_server_impressions", "fill_rate", "ad_requests"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF01, sorted(E.oracle_sql()), verbose=False)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(results, name):
    status, detail = results[name]
    assert status in ("MATCH", "MATCH~"), detail
