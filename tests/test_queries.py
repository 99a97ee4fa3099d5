"""Every registered query against its DuckDB oracle (sf0.001, whole tables)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from oracle_compare import compare, duck

from conftest import SF_SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    from alertscope.plans.queries import QUERIES

    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    result = compare(spark, name, SF_SMALL, con)
    assert result["status"] == "match", result


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == [
        "sourceIp", "alert_count", "distinct_targets", "distinct_ports", "max_severity_rank",
    ]
    assert df.count() > 0


def test_queries_pin_utc(spark, con):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    result = compare(spark, "source_anomalies", SF_SMALL, con)
    assert result["status"] == "match", result
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
