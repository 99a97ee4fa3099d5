"""Set-at-a-time mark rules equal the row-at-a-time rules, in any batch order."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from alertscope.operators.incremental import new_since_mark, next_mark

BASE = dt.datetime(2026, 6, 11, 10, 0, 0)
instants = st.one_of(st.none(), st.integers(0, 3).map(lambda s: BASE + dt.timedelta(seconds=s)))
ids = st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d"]))
rows = st.lists(st.tuples(instants, ids), max_size=8)
marks = st.one_of(
    st.none(),
    st.tuples(
        st.integers(0, 3).map(lambda s: BASE + dt.timedelta(seconds=s)),
        st.frozensets(st.sampled_from(["a", "b", "c"]), max_size=3),
    ),
)


def is_new(mark, ts, rid):
    if ts is None or mark is None:
        return True
    if ts > mark[0]:
        return True
    return ts == mark[0] and rid is not None and rid not in mark[1]


def observe(mark, ts, rid):
    if ts is None:
        return mark
    if mark is None or ts > mark[0]:
        return (ts, frozenset() if rid is None else frozenset([rid]))
    if ts == mark[0] and rid is not None:
        return (mark[0], mark[1] | {rid})
    return mark


def _mark_df(spark, mark):
    if mark is None:
        data = []
    else:
        data = [(mark[0], i) for i in sorted(mark[1])] or [(mark[0], None)]
    return spark.createDataFrame(data, "mark_ts timestamp, mark_id string")


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batch=rows, mark=marks)
def test_matches_sequential_rules(spark, batch, mark):
    snapshot = mark
    expected_new = [r for r in batch if is_new(snapshot, *r)]
    expected_mark = snapshot
    for ts, rid in reversed(expected_new):  # any order gives the same mark
        expected_mark = observe(expected_mark, ts, rid)

    df = spark.createDataFrame(batch, "cursor_ts timestamp, cursor_id string")
    m = _mark_df(spark, mark)
    new = new_since_mark(df, m)
    got_new = sorted(((r.cursor_ts, r.cursor_id) for r in new.collect()), key=repr)
    assert got_new == sorted(expected_new, key=repr)

    got = next_mark(new, m).collect()
    if expected_mark is None:
        assert got == []
    else:
        assert {r.mark_ts for r in got} == {expected_mark[0]}
        assert {r.mark_id for r in got if r.mark_id is not None} == set(expected_mark[1])
        assert len(got) == max(len(expected_mark[1]), 1)
