"""Every SQL-expressible registered query equals its DuckDB statement."""

import pytest

import parity
from conftest import SF_MID, SF_SMALL
from forumlens.plans import registry

ORACLE = registry.oracle_sql()
QUERIES = registry.queries()
ANALYSES = [k for k in ORACLE if k.startswith("q")]


def _check(spark, sf, key, con):
    r = parity.compare(spark, sf, key, QUERIES[key], ORACLE[key], con)
    assert r["cols_match"], (r["spark_cols"], r["duck_cols"])
    assert r["spark_rows"] == r["duck_rows"]
    assert r["values_match"], r["diff"]
    return r


@pytest.fixture(scope="module")
def duck_small():
    return parity.duck(SF_SMALL)


@pytest.fixture(scope="module")
def duck_mid():
    return parity.duck(SF_MID)


@pytest.mark.parametrize("key", sorted(ORACLE))
def test_parity_small(spark, key, duck_small):
    _check(spark, SF_SMALL, key, duck_small)


@pytest.mark.parametrize("key", sorted(ANALYSES))
def test_parity_mid(spark, key, duck_mid):
    r = _check(spark, SF_MID, key, duck_mid)
    assert r["spark_rows"] > 0


def test_every_key_registered():
    # each oracle key has a query; keys without oracle are the model ones
    assert set(ORACLE) <= set(QUERIES)
    assert {k for k in QUERIES if k not in ORACLE} == {
        "q6_tag_vectors", "q6_synonyms", "q6_post_vectors", "q7_one_tag",
        "q7_tag_probabilities", "op_hashing_tf"}
