"""Every query with stated SQL gives the same rows as that SQL on DuckDB."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import duck, same

from cellrisk.catalog import oracles, queries


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(oracles()))
def test_same_rows(spark, sf_dir, con, name):
    got = queries()[name](spark, sf_dir).toPandas()
    assert same(got, con.execute(oracles()[name]).df()).startswith("ok")
