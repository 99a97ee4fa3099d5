"""Reports from parts against the reports over all alerts at once."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from alertscope.operators.numbering import numbered, with_places
from alertscope.operators.reports import REPORTS
from alertscope.operators.rollups import ReportRollups

SCHEMA = (
    "alertId string, sourceIp string, destinationIp string, destinationPort int, severity string, deviceId string, "
    "type string, dt date"
)


def alerts(n, seed, days=4):
    rnd = random.Random(seed)
    pick = lambda *xs: rnd.choice(xs)
    out = []
    for i in range(n):
        source = "hot" if rnd.random() < 0.35 else pick(None, "", " a", "a", *(f"s{k}" for k in range(130)))
        day = pick(None, *(dt.date(2026, 1, 1) + dt.timedelta(days=k) for k in range(days)))
        out.append((str(i), source, pick(None, "x", *(f"t{k}" for k in range(300))), pick(None, 0, -1, *range(80)),
                    pick("CRITICAL", "HIGH", "LOW", "odd", None, "critical"), pick(None, "", "d1", "d2"), pick(None, "SCAN"), day))
    return out


def same(spark, store, rows):
    whole = spark.createDataFrame(rows, SCHEMA)
    for name, report in REPORTS.items():
        got, want = store.report(name), report(whole)
        assert got.columns == want.columns and got.dtypes == want.dtypes, name
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in want.collect()], name


@pytest.mark.parametrize("listed", [2048, 3, 0])
def test_parts_equal_the_whole(spark, tmp_dir, listed):
    store = ReportRollups(spark, f"{tmp_dir}/reports", listed)
    rows = alerts(1500, 1)
    for part in range(3):
        mine = rows[part * 500 : (part + 1) * 500]
        assert store.add(part, spark.createDataFrame(mine, SCHEMA))
    assert not store.add(2, spark.createDataFrame(rows, SCHEMA))  # a replay
    same(spark, store, rows)


def test_days_come_one_by_one(spark, tmp_dir):
    store, rows = ReportRollups(spark, f"{tmp_dir}/reports", 5), alerts(400, 2, days=2)
    frame = spark.createDataFrame(rows, SCHEMA)
    days = [None, dt.date(2026, 1, 1)]
    assert store.add_days(frame, days) == [-1, dt.date(2026, 1, 1).toordinal()]
    same(spark, store, [r for r in rows if r[-1] in days])
    assert store.add_days(frame, [*days, dt.date(2026, 1, 2)]) == [dt.date(2026, 1, 2).toordinal()]
    same(spark, ReportRollups(spark, f"{tmp_dir}/reports", 5), rows)


def test_no_parts_and_empty_parts(spark, tmp_dir):
    store = ReportRollups(spark, f"{tmp_dir}/reports")
    same(spark, store, [])
    store.add(0, spark.createDataFrame([], SCHEMA))
    same(spark, store, [])
    store.add(1, spark.createDataFrame([("1", None, None, None, None, None, None, None)], SCHEMA))
    same(spark, store, [("1", None, None, None, None, None, None, None)])


def test_an_attempt_that_died_is_taken_up(spark, tmp_dir, monkeypatch):
    from alertscope.operators import rollups as R

    store, rows = ReportRollups(spark, f"{tmp_dir}/reports", 3), alerts(200, 3)
    store.add(0, spark.createDataFrame(rows[:100], SCHEMA))
    second = spark.createDataFrame(rows[100:], SCHEMA)
    with monkeypatch.context() as broken:
        broken.setattr(R, "listed_and_mapped", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            store.add(1, second)
    same(spark, store, rows[:100])  # not there yet
    assert store.add(1, second)
    same(spark, store, rows)


def test_numbers_have_no_gaps(spark, tmp_dir):
    frame = spark.range(0, 1000, 1, 7).filter("id % 3 = 0")
    with_places(frame).write.parquet(f"{tmp_dir}/placed")
    got = [tuple(r) for r in numbered(spark.read.parquet(f"{tmp_dir}/placed"), "n", 5).collect()]
    assert sorted(n for _, n in got) == list(range(5, 5 + len(got))) and len({i for i, _ in got}) == 334
    assert numbered(spark.read.parquet(f"{tmp_dir}/placed").limit(0), "n").count() == 0
