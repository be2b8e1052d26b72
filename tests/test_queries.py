"""Every registered query against its DuckDB twin."""

import pytest

import __spark_entry__ as driver
from checks.compare import connect, differences
from checks.fixtures import view
from checks.registry import QUERIES


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf, con, name):
    assert differences(spark, con, sf, name) == []


def test_every_query_has_a_twin():
    assert set(QUERIES) <= set(driver.oracle_sql())


def test_entry(spark):
    assert not driver.entry(spark).isEmpty()


def test_known_counts(spark):
    sf = "/root/testdata/sf0.01"
    found = {name: driver.queries()[name](spark, sf) for name in ("map_upload", "allocate_approved", "ingest_acct_fixed_b")}
    codes = dict(found["map_upload"].groupBy("BillCode").count().collect())
    assert (codes["B"], codes["A"], codes["Q"]) == (6000, 1000, 835)
    assert found["allocate_approved"].count() == 4760
    assert found["allocate_approved"].where("bill_id is not null").count() == 4456
    assert found["ingest_acct_fixed_b"].count() == 8908
    assert view(spark, sf, "fx_control").count() == 13
