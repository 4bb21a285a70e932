"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import pytest

from settings import SF_SMALL

import __spark_entry__ as entry
from podlake.catalog import QUERIES
from podlake.oracle.compare import compare, duck
from podlake.oracle.sql import oracle_sql

ORACLE = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["carrier_name", "total_pods", "exceptions", "exception_pct"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, f"{name}: {msg}"


ORDERED = {
    "recent_exceptions": lambda r: (r["delivery_date"] is not None, r["delivery_date"] and -r["delivery_date"].toordinal(), r["pod_id"]),
    "vq_claims_by_type": lambda r: (-r["total_claims"], r["claim_type"]),
    "vq_top_carriers_freight": lambda r: (-r["total_freight_cost"], r["carrier_name"]),
    "vq_monthly_shipments": lambda r: (r["month"] is None, r["month"]),
    "pod_status_dist": lambda r: -r["cnt"],
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_declared_order(spark, name):
    keys = [ORDERED[name](r) for r in QUERIES[name](spark, SF_SMALL).collect()]
    assert keys == sorted(keys)
