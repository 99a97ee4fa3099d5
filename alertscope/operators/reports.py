"""The six lake reports, each ``alerts -> DataFrame``.

Every report is filter → group → aggregate → order (→ top-k). Catalyst
turns each into a column-pruned scan with the filter pushed into the
Parquet reader, a partial aggregate before the shuffle (two-distinct
reports go through the ``Expand`` rewrite, whose first shuffle key includes
the distinct value, so one hot group spreads over many tasks), and a
``TakeOrderedAndProject`` for the top-k cuts. The group key is the
tie-break, so the row kept at a tie on the cut is deterministic.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from alertscope.functions.severity import SEVERITY_RANKS

# Top-k sizes of the two bounded reports and the label of a
# missing severity or type.
TOP_SOURCES = 100
TOP_PORTS = 50
UNKNOWN = "UNKNOWN"


class Measure(NamedTuple):
    """A report's column as a SQL expression, and how parts of it come together:
    ``sum``, ``max`` or the distinct values of ``column``."""

    name: str
    sql: str
    merge: str
    column: str | None = None


@dataclass(frozen=True)
class Report:
    """One report: group key, measures as SQL expressions, order, optional cut.

    Both forms, DataFrame and SQL text, are built from this.
    """

    key: str
    measures: tuple[Measure, ...]
    missing: str | None = None  # label of a null key; without one null keys stay or go
    known_only: bool = False  # drop null keys
    by_count: bool = True  # most alerts first, then key; else by key alone
    limit: int | None = None

    def _key(self) -> str:
        return f"coalesce({self.key}, '{self.missing}')" if self.missing else self.key

    def frame(self, alerts: DataFrame, limit: int | None = None) -> DataFrame:
        if self.known_only:
            alerts = alerts.filter(F.col(self.key).isNotNull())
        grouped = alerts.groupBy(F.expr(self._key()).alias(self.key)).agg(
            *[F.expr(m.sql).alias(m.name) for m in self.measures]
        )
        return self.cut(grouped, limit)

    def cut(self, grouped: DataFrame, limit: int | None = None) -> DataFrame:
        """Finished groups in the report's order, up to its limit."""
        order = [F.desc("alert_count")] if self.by_count else []
        out = grouped.orderBy(*order, F.asc_nulls_first(self.key))
        cut = limit or self.limit
        return out if cut is None else out.limit(cut)

    def sql(self, view: str) -> str:
        parts = [f"SELECT {self._key()} AS {self.key}"]
        parts += [f", {m.sql} AS {m.name}" for m in self.measures]
        parts.append(f" FROM {view}")
        if self.known_only:
            parts.append(f" WHERE {self.key} IS NOT NULL")
        parts.append(f" GROUP BY {self._key()} ORDER BY ")
        parts.append(f"alert_count DESC, {self.key}" if self.by_count else self.key)
        if self.limit is not None:
            parts.append(f" LIMIT {self.limit}")
        return "".join(parts)


def _distinct(name: str, column: str) -> Measure:
    return Measure(name, f"count(DISTINCT {column})", "distinct", column)


_RANK = Measure(
    "max_severity_rank",
    "max(CASE {} ELSE 0 END)".format(
        " ".join(f"WHEN severity = '{name}' THEN {rank}" for name, rank in SEVERITY_RANKS.items())
    ),
    "max",
)
_COUNT = Measure("alert_count", "count(1)", "sum")

# The six reports' names, keys and output columns, in the order
# the report job writes them.
DEFINITIONS: dict[str, Report] = {
    "top_source_ips": Report(
        "sourceIp",
        (
            _COUNT,
            _distinct("distinct_targets", "destinationIp"),
            _distinct("distinct_ports", "destinationPort"),
            _RANK,
        ),
        known_only=True,
        limit=TOP_SOURCES,
    ),
    "alerts_per_device": Report("deviceId", (_COUNT, _distinct("distinct_sources", "sourceIp"))),
    "severity_distribution": Report("severity", (_COUNT,), missing=UNKNOWN),
    "type_distribution": Report("type", (_COUNT,), missing=UNKNOWN),
    "daily_trend": Report(
        "dt",
        (_COUNT, _distinct("distinct_sources", "sourceIp"), _distinct("active_devices", "deviceId")),
        by_count=False,
    ),
    "top_destination_ports": Report("destinationPort", (_COUNT,), known_only=True, limit=TOP_PORTS),
}

REPORTS: dict[str, Callable[..., DataFrame]] = {name: r.frame for name, r in DEFINITIONS.items()}

top_source_ips = REPORTS["top_source_ips"]
alerts_per_device = REPORTS["alerts_per_device"]
severity_distribution = REPORTS["severity_distribution"]
type_distribution = REPORTS["type_distribution"]
daily_trend = REPORTS["daily_trend"]
top_destination_ports = REPORTS["top_destination_ports"]


def total_alerts(alerts: DataFrame) -> DataFrame:
    """Global row count as a one-row frame (the report job's size log)."""
    return alerts.agg(F.count(F.lit(1)).alias("total_alerts"))


def in_date_range(alerts: DataFrame, since=None, until=None) -> DataFrame:
    """Restrict to partitions ``since <= dt <= until`` (either end optional).

    On a ``dt``-partitioned lake this becomes a partition filter, so the
    scan lists and reads only the chosen day folders.
    """
    if since is not None:
        alerts = alerts.filter(F.col("dt") >= F.lit(since).cast("date"))
    if until is not None:
        alerts = alerts.filter(F.col("dt") <= F.lit(until).cast("date"))
    return alerts


def sql_report(
    spark: SparkSession, alerts: DataFrame, name: str, view: str = "alerts"
) -> DataFrame:
    """Register ``alerts`` as a temp view and run the named report as SQL over it."""
    alerts.createOrReplaceTempView(view)
    return spark.sql(DEFINITIONS[name].sql(view))
