"""Queries against their SQL twins on the smallest data set."""

import os

import pytest

from check import connect, same
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(ORACLES)


# The whole table holds every single feature.
@pytest.mark.parametrize(
    "name", [n for n in QUERIES if n[0] in "rp"]
)
def test_query(spark, con, name):
    assert same(QUERIES[name](spark, SF_DIR).toPandas(), con.execute(ORACLES[name]).df()) == ""


def test_ids_are_dense_and_rows_are_points(spark):
    table = QUERIES["p5_all_features"](spark, SF_DIR)
    ids = sorted(r[0] for r in table.select("point_id").collect())
    assert ids == list(range(QUERIES["r4_road_points"](spark, SF_DIR).count()))
