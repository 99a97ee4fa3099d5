"""The batch ledger, per-record delivery and polls that are run again."""

from __future__ import annotations

import json
import os
import sys

import pytest
from pyspark import cloudpickle

from alertscope.plans.ingest_job import poll_batch, poll_once, read_mark
from alertscope.sources.delivery import attempt, deliver
from alertscope.streaming.ledger import Ledger

# the senders below go to the workers by value: they cannot import this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def rows(df):
    return [] if df is None else sorted(tuple(r) for r in df.collect())


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v int")


def test_a_batch_is_kept_once(spark, tmp_dir):
    ledger = Ledger(spark, f"{tmp_dir}/ledger")
    assert ledger.read("a") is None and ledger.last("a") is None and ledger.committed("a") == []
    assert rows(ledger.keep("a", 3, lambda: frame(spark, 1, 2))) == [(1,), (2,)]
    # a replay computes something else by now: what was kept stays
    assert rows(ledger.keep("a", 3, lambda: frame(spark, 9))) == [(1,), (2,)]
    assert rows(ledger.keep("a", 10, lambda: frame(spark))) == []
    assert rows(Ledger(spark, f"{tmp_dir}/ledger/").read("a")) == [(1,), (2,)]
    assert ledger.committed("a") == [3, 10] and rows(ledger.last("a")) == []
    ledger.forget("a", 10)
    assert ledger.committed("a") == [10] and len(os.listdir(f"{tmp_dir}/ledger/a/data")) == 1


def test_torn_and_racing_attempts(spark, tmp_dir):
    ledger = Ledger(spark, f"{tmp_dir}/ledger")

    def dies():
        frame(spark, 7).write.parquet(f"{tmp_dir}/ledger/a/data/0-torn")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ledger.keep("a", 0, dies)
    assert ledger.read("a") is None

    def other_first():
        Ledger(spark, f"{tmp_dir}/ledger").keep("a", 0, lambda: frame(spark, 1))
        return frame(spark, 2)

    # another attempt commits while this one is writing: both read the winner's rows
    assert rows(ledger.keep("a", 0, other_first)) == [(1,)]
    assert rows(ledger.read("a")) == [(1,)]
    assert [f for f in os.listdir(f"{tmp_dir}/ledger/a") if f.endswith(".commit")] == []


def test_once(spark, tmp_dir):
    ledger, done = Ledger(spark, f"{tmp_dir}/ledger"), []
    assert ledger.once("sent", 0, lambda: done.append(0)) and not ledger.once("sent", 0, lambda: done.append(1))

    def dies():
        done.append(2)
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ledger.once("sent", 1, dies)
    assert ledger.once("sent", 1, lambda: done.append(3)) and done == [0, 2, 3]
    ledger.forget("sent", 2)
    assert ledger.committed("sent") == []


class Sender:
    def __init__(self):
        self.turn = 0

    def send(self, records):
        self.turn += 1
        if any(v == "boom" for _, v in records) and self.turn == 1:
            raise ConnectionError("gone")
        return ["no" if v == "never" or (v == "late" and self.turn < 3) else None for _, v in records]

    def close(self):
        self.turn = -1


def test_attempts():
    records = [("k", "fine"), ("k", "late"), ("k", "never")]
    assert attempt(Sender(), records, 3) == [(True, 1, None), (True, 3, None), (False, 4, "no")]
    assert attempt(Sender(), records, 0) == [(True, 1, None), (False, 1, "no"), (False, 1, "no")]
    assert attempt(Sender(), [("k", "boom"), ("k", "never")], 1) == [(True, 2, None), (False, 2, "no")]
    assert attempt(Sender(), [("k", "boom")], 0) == [(False, 1, "ConnectionError: gone")]
    assert attempt(Sender(), [], 3) == []


def test_deliver_keeps_columns_and_odd_rows(spark):
    raw = spark.createDataFrame(
        [("k", "fine", 1, "x"), (None, None, 2, "y"), ("k", "never", None, "z"), ("k", "fine", 1, "x")],
        "publish_key string, json string, n int, error string",
    )
    got = deliver(raw, Sender, retries=1)
    assert got.columns == ["publish_key", "json", "n", "delivered", "attempts", "error"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("k", "fine", 1, True, 1, None), (None, None, 2, True, 1, None), ("k", "never", None, False, 2, "no"),
         ("k", "fine", 1, True, 1, None)], key=str)
    assert deliver(raw.limit(0), Sender).count() == 0


def alert(i, ts, device="d"):
    return {"alertId": i, "timestamp": ts, "deviceId": device}


def pages(spark, *alerts):
    return spark.createDataFrame([(json.dumps({"data": {"content": list(alerts)}}),)], "body string")


class Picky:
    """Refuses alerts whose device is ``bad``."""

    def send(self, records):
        return ["refused" if k == "bad" else None for k, _ in records]

    def close(self):
        pass


T = "2026-06-11T10:00:0{}Z".format


def test_the_mark_covers_delivered_alerts_only(spark, tmp_dir):
    mark = f"{tmp_dir}/mark"
    page = pages(spark, alert("a", T(1)), alert("b", T(2)), alert("c", T(3), "bad"), alert("d", T(1), "bad"))
    assert poll_once(spark, page, mark, lambda new: deliver(new, Picky)) == 2
    assert [r.mark_id for r in read_mark(spark, mark).collect()] == ["b"]
    sent = []
    # c is newer than the mark and comes again; d is older and does not
    assert poll_once(spark, page, mark, lambda new: sent.extend(r.cursor_id for r in new.collect())) == 1
    assert sent == ["c"] and [r.mark_id for r in read_mark(spark, mark).collect()] == ["c"]
    # nothing is delivered: the mark stays
    assert poll_once(spark, pages(spark, alert("e", T(5), "bad")), mark, lambda new: deliver(new, Picky)) == 0
    assert [r.mark_id for r in read_mark(spark, mark).collect()] == ["c"]


def test_resend_takes_up_what_was_left(spark, tmp_dir):
    mark, ledger = f"{tmp_dir}/mark", Ledger(spark, f"{tmp_dir}/ledger")
    one = pages(spark, alert("a", T(1), "bad"), alert("b", T(2)))
    assert poll_batch(spark, one, mark, lambda new: deliver(new, Picky), ledger, 0, resend=True) == 1
    sent = []
    two = pages(spark, alert("b", T(2)), alert("c", T(3)))
    publish = lambda new: sent.extend(r.cursor_id for r in new.collect())
    assert poll_batch(spark, two, mark, publish, ledger, 1, resend=True) == 2
    assert sorted(sent) == ["a", "c"]
    assert poll_batch(spark, two, mark, publish, ledger, 2, resend=True) == 0
    assert sorted(sent) == ["a", "c"]


def test_a_replayed_poll_sends_nothing_again(spark, tmp_dir):
    mark, ledger, sent = f"{tmp_dir}/mark", Ledger(spark, f"{tmp_dir}/ledger"), []
    page = pages(spark, alert("a", T(1)), alert("n", None), alert("n2", "yesterday"))
    publish = lambda new: sent.extend(r.cursor_id for r in new.collect())
    for _ in range(3):
        assert poll_batch(spark, page, mark, publish, ledger, 0) == 3
    assert sorted(sent) == ["a", "n", "n2"]
    # the next poll is another batch: alerts without an instant are new to it
    assert poll_batch(spark, page, mark, publish, ledger, 1) == 2
    assert sorted(sent) == ["a", "n", "n", "n2", "n2"]


def test_a_poll_that_died_while_publishing_sends_the_same_rows(spark, tmp_dir):
    mark, ledger, tries = f"{tmp_dir}/mark", Ledger(spark, f"{tmp_dir}/ledger"), []

    def publish(new):
        tries.append(sorted(r.cursor_id for r in new.collect()))
        if len(tries) == 1:
            raise RuntimeError("broker down")

    with pytest.raises(RuntimeError):
        poll_batch(spark, pages(spark, alert("a", T(1)), alert("b", T(2))), mark, publish, ledger, 0)
    assert read_mark(spark, mark).count() == 0
    # the pages have changed since: the batch's own rows are sent
    poll_batch(spark, pages(spark, alert("z", T(9))), mark, publish, ledger, 0)
    assert tries == [["a", "b"], ["a", "b"]]
    assert [r.mark_id for r in read_mark(spark, mark).collect()] == ["b"]
