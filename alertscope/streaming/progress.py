"""What the streams report in passing: observed counts and the topic's lag.

Nothing is run for these figures: the counts come from ``observe`` nodes of the
plans that do the work, the lag from the sources' own progress.
"""

from __future__ import annotations

import threading
from collections import defaultdict

from pyspark.sql.streaming.listener import StreamingQueryListener, StreamingQueryProgress

#: Metrics of a topic source: messages behind the newest, on the worst partition and on average.
LAG_METRICS = ("maxOffsetsBehindLatest", "avgOffsetsBehindLatest")


def observed_totals(progress: list[StreamingQueryProgress]) -> dict[str, dict[str, int]]:
    """Sums of the observed metrics over batches, by the observation's name."""
    out: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
    for batch in progress:
        for name, row in batch.observedMetrics.items():
            for metric, value in row.asDict().items():
                out[name][metric] += value or 0
    return {name: dict(metrics) for name, metrics in out.items()}


def topic_lag(progress: StreamingQueryProgress) -> dict[str, dict[str, float]]:
    """Lag metrics of each source that reports them, by the source's description."""
    out = {}
    for source in progress.sources:
        told = {m: float(source.metrics[m]) for m in LAG_METRICS if m in (source.metrics or {})}
        if told:
            out[source.description] = told
    return out


class ProgressTotals(StreamingQueryListener):
    """Running totals of all queries of a session, and the newest lag of each source.

    Register with ``spark.streams.addListener``. A batch that is run again after a
    failure reports again and counts again: these are figures to watch, not results.
    """

    def __init__(self) -> None:
        self._lock = threading.Lock()
        self._observed: dict[str, dict[str, int]] = {}
        self._lag: dict[str, dict[str, float]] = {}

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        with self._lock:
            for name, metrics in observed_totals([event.progress]).items():
                own = self._observed.setdefault(name, {})
                for metric, value in metrics.items():
                    own[metric] = own.get(metric, 0) + value
            self._lag.update(topic_lag(event.progress))

    def observed(self) -> dict[str, dict[str, int]]:
        with self._lock:
            return {name: dict(metrics) for name, metrics in self._observed.items()}

    def lag(self) -> dict[str, dict[str, float]]:
        with self._lock:
            return {name: dict(metrics) for name, metrics in self._lag.items()}
