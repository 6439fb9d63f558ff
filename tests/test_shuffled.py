"""Lookups too large to broadcast: the same results by shuffled joins."""

from pathlib import Path

import pytest

from snapweave import workload
from snapweave.operators import fuzzy, skew, waterfall
from snapweave.plans import geocode

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture()
def nothing_is_small(spark, monkeypatch):
    for module in (fuzzy, geocode):
        monkeypatch.setattr(module, "SMALL_ROWS", -1)
    monkeypatch.setattr(waterfall, "SMALL_KEYS", -1)
    monkeypatch.setattr(skew.broadcast_if_small, "__defaults__", (-1,))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def contents(df):
    columns = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


QUERIES = [
    "geocode_chain", "normalize_regions", "waterfall_match", "fuzzy_match", "expand_abbr",
    "code_lookup", "code_filter", "tagged_union", "collapse_hot_keys", "backfill_hot_keys", "yearly_facts",
]


@pytest.fixture(scope="module")
def expected(spark):
    return {name: contents(workload.QUERIES[name](spark, FOLDER)) for name in QUERIES}


@pytest.mark.parametrize("name", QUERIES)
def test_without_broadcast(spark, expected, nothing_is_small, name):
    got = workload.QUERIES[name](spark, FOLDER)
    # keys of hot pieces are a list made on the driver and always travel whole, as do bitmaps of
    # keys, whose size has a limit
    if "hot" not in name and name != "yearly_facts":
        assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    assert contents(got) == expected[name]
