"""Every query against its SQL oracle; the rest against invariants elsewhere."""

import pytest
from compare import differences, duck

import __spark_entry__ as contract
from workload.oracles import oracles
from workload.queries import QUERIES

ROWS_ONLY = {"anomalies", "anomaly_alerts", "aircraft_clusters", "cluster_sizes"}


@pytest.fixture(scope="module")
def connection(small_sf):
    return duck(small_sf)


def test_every_query_has_an_oracle_or_is_known_not_to():
    assert set(QUERIES) - set(oracles()) == ROWS_ONLY
    assert {"anomaly_checks", "cluster_checks"} <= set(oracles())  # what their rows must satisfy
    assert set(oracles()) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(oracles()))
def test_query_matches_oracle(spark, small_sf, connection, name):
    found = differences(QUERIES[name](spark, small_sf), connection, oracles()[name])
    assert found == []


@pytest.mark.parametrize(
    "name", ["proximity_join", "region_metrics", "forecast_daily", "surge_history", "reroute"]
)
def test_query_matches_oracle_where_flights_fan_out(spark, name):
    sf = "/root/testdata/sf0.01"
    assert differences(QUERIES[name](spark, sf), duck(sf), oracles()[name]) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_rows_only_query_has_rows(spark, small_sf, name):
    assert QUERIES[name](spark, small_sf).count() > 0


def test_entry(spark):
    flagship = contract.entry(spark)
    assert flagship.columns == ["region", "aircraft_count", "capacity", "aci"]
    assert flagship.count() == 67
