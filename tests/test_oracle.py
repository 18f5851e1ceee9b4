"""Every registered query against independent SQL on the demo tables."""

from pathlib import Path

import pytest

from __spark_entry__ import entry
from checks import oracle
from checks.compare import compare, connect
from checks.queries import REGISTRY

DATA = Path("/root/testdata")
# The fixed columns of their SQL need a vocabulary that the smallest scale does not reach.
LARGER = {"financials_gold", "combined_features", "backfill_features", "backfill_two_runs", "backfill_bucketed"}

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="demo tables not present")


@pytest.fixture(scope="module")
def databases():
    return {sf: connect(str(DATA / sf)) for sf in ("sf0.001", "sf0.01")}


def test_every_query_has_sql():
    assert set(REGISTRY) == set(oracle.statements())


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, databases, name):
    sf = "sf0.01" if name in LARGER else "sf0.001"
    assert compare(spark, databases[sf], name, str(DATA / sf)) == []


def test_entry(spark):
    assert entry(spark).columns == ["snapshot_date", "label_def", "loans", "defaults"]
