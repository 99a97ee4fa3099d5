"""Observed totals and lag from the streams' own progress."""

from __future__ import annotations

import json
from types import SimpleNamespace

from pyspark.sql import Row

from alertscope.streaming.progress import ProgressTotals, observed_totals, topic_lag


def progress(metrics, sources=()):
    return SimpleNamespace(observedMetrics={k: Row(**v) for k, v in metrics.items()}, sources=list(sources))


def source(name, **metrics):
    return SimpleNamespace(description=name, metrics={k: str(v) for k, v in metrics.items()})


def test_totals_add_up():
    batches = [progress({"p": {"messages": 3, "dropped": None}}), progress({}), progress({"p": {"messages": 4, "dropped": 1}, "q": {"n": 2}})]
    assert observed_totals(batches) == {"p": {"messages": 7, "dropped": 1}, "q": {"n": 2}}
    assert observed_totals([]) == {}
    listener = ProgressTotals()
    for batch in batches:
        listener.onQueryProgress(SimpleNamespace(progress=batch))
    assert listener.observed() == observed_totals(batches) and listener.lag() == {}


def test_topic_lag():
    at = progress({}, [source("topic a", maxOffsetsBehindLatest=12, avgOffsetsBehindLatest=3.5, other=1), source("files"),
                       SimpleNamespace(description="none", metrics=None)])
    assert topic_lag(at) == {"topic a": {"maxOffsetsBehindLatest": 12.0, "avgOffsetsBehindLatest": 3.5}}
    listener = ProgressTotals()
    listener.onQueryProgress(SimpleNamespace(progress=at))
    assert listener.lag() == topic_lag(at)


def test_the_lake_stream_reports_its_parse(spark, tmp_dir):
    from alertscope.plans.lake_job import PARSE, start_lake
    from alertscope.schema import KAFKA_ROW_SCHEMA
    from alertscope.streaming.event_time import finish

    values = ['{"alertId":"1"}', '{"alertId":"2"', "[]", None, '{"deviceId":"d"}', '{"alertId":"3","sourceIp":5}']
    rows = [(None, v and v.encode(), "t", 0, i, None, 0) for i, v in enumerate(values)]
    spark.createDataFrame(rows, KAFKA_ROW_SCHEMA).write.parquet(f"{tmp_dir}/in")
    stream = spark.readStream.schema(KAFKA_ROW_SCHEMA).parquet(f"{tmp_dir}/in")
    query = start_lake(stream, f"{tmp_dir}/lake", f"{tmp_dir}/ckpt", trigger={"availableNow": True})
    finish(query)
    assert observed_totals(query.recentProgress) == {PARSE: {"messages": 6, "dropped": 4}}
    assert json.loads(query.lastProgress.json)["batchId"] == 0
