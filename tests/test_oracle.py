"""Every catalogue query against its DuckDB oracle (row count, schema, values)."""

import pytest

from cartwise.plans import catalog, oracle
from cartwise.plans.check import compare

from paths import SF_CHECK, SF_SMALL

NAMES = sorted(catalog.QUERIES)


def test_every_query_has_an_oracle():
    assert set(NAMES) == set(oracle.ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck_small, name):
    r = compare(spark, name, SF_SMALL, duck_small)
    assert r["columns_match"], r
    assert not r["type_diffs"], r
    assert r["match"], r


@pytest.mark.parametrize("name", ["frequency_profile", "companion_top1", "similar_products",
                                  "resolve_names", "blended"])
def test_headline_queries_match_at_sf001(spark, name):
    r = compare(spark, name, SF_CHECK)
    assert r["match"] and not r["type_diffs"], r
    assert r["spark_rows"] > 0
