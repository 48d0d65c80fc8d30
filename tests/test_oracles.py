"""Every registered query against its SQL on the smallest tables; the others must give rows."""

import pytest

import compare
from tidemark.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    got = compare.spark_result(QUERIES[name](spark, sf_dir))
    if name in ORACLES:
        assert got == compare.duck_result(duck, ORACLES[name])
    else:
        assert got[1]
