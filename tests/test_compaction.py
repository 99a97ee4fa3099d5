"""Compaction of closed days: rows, files, late alerts and readers in between."""

from __future__ import annotations

import datetime as dt
import glob

import pytest

from alertscope.plans.compaction import compact_closed, compact_day, compacted_lake, day_files
from alertscope.plans.lake_job import read_lake
from alertscope.sources.events import load_alerts

from conftest import SF_SMALL

FIRST, SECOND = dt.date(2024, 1, 1), dt.date(2024, 1, 2)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture()
def lake(spark, tmp_dir):
    alerts = load_alerts(spark, SF_SMALL)
    path = f"{tmp_dir}/lake"
    for k in range(3):
        alerts.filter(f"alertId % 3 = {k}").repartition(4).write.mode("append").partitionBy("dt").parquet(path)
    alerts.limit(2).drop("dt").selectExpr("*", "cast(null as date) dt").write.mode("append").partitionBy("dt").parquet(path)
    return path


def test_rows_stay_and_files_go(spark, lake, tmp_dir):
    store, before = f"{tmp_dir}/compact", rows(read_lake(spark, lake))
    assert rows(compacted_lake(spark, lake, store)) == before
    many = len(glob.glob(f"{lake}/dt={FIRST}/*.parquet"))
    assert many > 4
    assert compact_day(spark, lake, store, FIRST) and not compact_day(spark, lake, store, FIRST)
    assert len(glob.glob(f"{store}/days/data/{FIRST.toordinal()}-*/*.parquet")) == 1
    got = compacted_lake(spark, lake, store)
    assert rows(got) == before and got.columns == read_lake(spark, lake).columns and got.dtypes == read_lake(spark, lake).dtypes
    assert compact_day(spark, lake, store, None) and rows(compacted_lake(spark, lake, store)) == before
    assert not compact_day(spark, lake, store, dt.date(1999, 1, 1))  # no such day


def test_late_alerts_and_a_reader_in_between(spark, lake, tmp_dir):
    store = f"{tmp_dir}/compact"
    earlier = compacted_lake(spark, lake, store)
    before = rows(earlier)
    compact_day(spark, lake, store, FIRST)
    assert rows(earlier) == before  # a reader that began keeps its files
    late = load_alerts(spark, SF_SMALL).filter(f"dt = date'{FIRST}'").limit(3)
    late.write.mode("append").partitionBy("dt").parquet(lake)
    want = sorted(before + rows(late))
    assert rows(read_lake(spark, lake)) == want and rows(compacted_lake(spark, lake, store)) == want


def test_only_closed_days_of_many_files(spark, lake, tmp_dir):
    store = f"{tmp_dir}/compact"
    counts = {r.dt: r["count"] for r in day_files(spark, lake).groupBy("dt").count().collect()}
    done = compact_closed(spark, lake, store, before=SECOND, most_files=4, file_bytes=20_000)
    assert done == [FIRST] and counts[FIRST] > 4 >= counts[None]
    assert rows(compacted_lake(spark, lake, store)) == rows(read_lake(spark, lake))
    assert compact_closed(spark, lake, store, before=SECOND, most_files=4) == []
    assert compacted_lake(spark, f"{tmp_dir}/nothing", store) is None
