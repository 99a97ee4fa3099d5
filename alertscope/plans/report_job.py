"""Lake → the six reports, each written to ``<out>/<name>``.

Reports run in registry order, each as its own query: every one reads
only the columns it needs (Parquet column pruning), so six pruned scans
cost far less than one full-width cached copy of a large lake. A failure
in one report is recorded and the rest still run. An empty lake (or
date range) skips all reports, and so does a lake none of whose files opens;
of a lake with some damaged files the others are reported on, and the lost ones
are named. Any other failure is raised: a lost executor is not an empty lake.

The number of alerts is observed while a report that reads all of them is written,
not counted by a job of its own.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from alertscope.operators.reports import REPORTS, in_date_range
from alertscope.operators.rollups import ReportRollups
from alertscope.plans.lake_job import damaged_files, read_lake
from alertscope.session import delete_path, scratch_path
from alertscope.streaming.ledger import Ledger


# Reports whose size grows with the data (devices, and the free text of severity
# and type) are written by many tasks as key-ordered part files; the bounded
# ones as one file.
GROWING_REPORTS = frozenset({"alerts_per_device", "severity_distribution", "type_distribution"})
# The columns that the reports read.
REPORT_COLUMNS = ("sourceIp", "destinationIp", "destinationPort", "severity", "deviceId", "type", "dt")


def one_per_alert(alerts: DataFrame) -> DataFrame:
    """The earliest copy of each ``alertId`` by broker time, then by its fields."""
    rest = [c for c in REPORT_COLUMNS if c in alerts.columns]
    order = [c for c in ("kafka_ts", "event_ts") if c in alerts.columns] + rest
    first = Window.partitionBy("alertId").orderBy(*[F.asc_nulls_first(c) for c in order])
    return alerts.select("alertId", *dict.fromkeys(order)).withColumn("_n", F.row_number().over(first)).filter(
        "_n = 1"
    ).select(*rest)


def write_report(report: DataFrame, path: str, single_file: bool = True) -> None:
    """Overwrite ``path`` with the report.

    ``single_file`` keeps one sorted file (the global sort survives
    ``coalesce(1)``), right for top-k and low-cardinality reports. For a
    report whose size grows with the data (alerts per device on a large
    fleet) pass ``False``: the range-partitioned sort is written by many
    tasks, part files in key order.
    """
    out = report.coalesce(1) if single_file else report
    out.write.mode("overwrite").parquet(path)


def publish_report(spark: SparkSession, report: DataFrame, out: str, name: str, single_file: bool = True) -> int:
    """Write the report as the next version below ``out`` and commit it; the version.

    A write that dies leaves the version before it the newest, and a reader that has
    begun keeps its files: the previous version is deleted one version later."""
    ledger = Ledger(spark, out)
    version = max(ledger.committed(name), default=-1) + 1
    ledger.keep(name, version, lambda: report.coalesce(1) if single_file else report)
    ledger.forget(name, version - 1)
    return version


def read_report(spark: SparkSession, out: str, name: str) -> DataFrame | None:
    """The newest committed version of a report; None if there is none."""
    return Ledger(spark, out).last(name)


#: The report that reads every alert, whatever its columns hold.
COUNTED_BY = "severity_distribution"


def run_reports(
    spark: SparkSession,
    lake: str | DataFrame,
    out: str,
    since=None,
    until=None,
    single_file: dict[str, bool] | None = None,
    dedupe: bool = False,
    parallel: int = len(REPORTS),
    versioned: bool = False,
) -> dict[str, str]:
    """Write every report; returns ``{name: "ok" | "failed: …" | "skipped: …"}``.

    ``dedupe=True`` counts each ``alertId`` once (re-sent alerts otherwise
    count again, as at-least-once delivery implies): the copies are sorted out
    once, the report columns of the earliest copies are written to a scratch
    folder that all reports read, and the folder is deleted at the end.
    Reports are submitted ``parallel`` at a time (default: all six) as
    independent jobs sharing the executors, so their small final stages
    overlap; ``parallel=1`` runs them one after another. ``versioned=True`` publishes
    each as a new version for ``read_report`` instead of overwriting its folder.
    """
    skipped = lambda why: {name: f"skipped: {why}" for name in REPORTS}
    if isinstance(lake, str):
        lost = damaged_files(spark, lake)
        for file in lost:
            print(f"[alertscope] damaged lake file left out: {file}")
        lake = read_lake(spark, lake, without=lost)
    if lake is None:
        return skipped("no readable input")
    alerts = in_date_range(lake, since, until)
    if alerts.isEmpty():
        return skipped("no alerts")
    scratch = None
    if dedupe:
        scratch = scratch_path(spark, "report-dedupe")
        once = one_per_alert(alerts)
        once.write.parquet(scratch)
        alerts = spark.read.schema(once.schema).parquet(scratch)
    single_file = single_file or {}
    seen = Observation()

    def one(name: str) -> str:
        try:
            one_file = single_file.get(name, name not in GROWING_REPORTS)
            rows = alerts.observe(seen, F.count(F.lit(1)).alias("alerts")) if name == COUNTED_BY else alerts
            if versioned:
                publish_report(spark, REPORTS[name](rows), out, name, one_file)
            else:
                write_report(REPORTS[name](rows), f"{out.rstrip('/')}/{name}", one_file)
            return "ok"
        except Exception as exc:  # one failed report must not stop the others
            return f"failed: {type(exc).__name__}: {exc}"

    try:
        if parallel > 1:
            with ThreadPoolExecutor(max_workers=parallel) as pool:
                status = dict(zip(REPORTS, pool.map(one, REPORTS)))
        else:
            status = {name: one(name) for name in REPORTS}
    finally:
        if scratch:
            delete_path(spark, scratch)
    if status[COUNTED_BY] == "ok":
        print(f"[alertscope] {seen.get['alerts']} alerts reported on")
    return status


def start_rolling_reports(
    alerts: DataFrame, folder: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Keep the reports up to date from a stream of alerts: each micro-batch is a part
    of the rollups in ``folder``, numbered by its batch id, so a replay counts once.
    ``ReportRollups(spark, folder).report(name)`` reads any report at any time."""

    def each(batch: DataFrame, batch_id: int) -> None:
        ReportRollups(batch.sparkSession, folder).add(batch_id, batch)

    writer = alerts.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()
