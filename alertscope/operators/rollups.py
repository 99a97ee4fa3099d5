"""The six reports kept up to date part by part, distinct counts included, exactly.

Counts of a day add up; distinct counts do not. Here the distinct values of a part
(a day of the lake, or a micro-batch) are kept as sets that can be united: every
value gets a number in a dictionary that only grows, and the numbers a group has
seen are cut into buckets of 32,768. A bucket with few of them lists its positions,
a fuller one is a bitmap of 4 KB. A report unites the buckets of all parts and adds
up their sizes, so a new day costs a scan of that day, and no alert is read again.

Parts and dictionary live in a ledger: a part that is added twice, by a replay or by
two attempts, counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from alertscope.operators.numbering import numbered, with_places
from alertscope.operators.reports import DEFINITIONS
from alertscope.streaming.ledger import Ledger

#: Positions up to which a bucket is a list; a bitmap takes as much room as 2,048 of them.
LISTED = 2048
_COUNTS = "report string, key string, alert_count long, max_severity_rank int"
_SET_KEY = ["report", "measure", "key", "bucket"]

#: (report, measure, key, counted column) of every distinct count.
DISTINCTS = [
    (name, m.name, report.key, m.column)
    for name, report in DEFINITIONS.items()
    for m in report.measures
    if m.merge == "distinct"
]


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def part_counts(alerts: DataFrame) -> DataFrame:
    """Counts and highest ranks of every report's groups, in one scan."""
    groups, ranks = [], {}
    for name, report in DEFINITIONS.items():
        key = F.expr(report._key()).cast("string")
        rank = next((m.sql for m in report.measures if m.merge == "max"), None)
        if rank:
            ranks[name] = F.expr(rank[len("max(") : -1])
        group = F.struct(
            F.lit(name).alias("report"), key.alias("key"), ranks.get(name, F.lit(None).cast("int")).alias("rank")
        )
        groups.append(F.when(F.col(report.key).isNotNull(), group) if report.known_only else group)
    rows = alerts.select(F.explode(F.array_compact(F.array(*groups))).alias("g"))
    return rows.groupBy("g.report", "g.key").agg(
        F.count(F.lit(1)).alias("alert_count"), F.max("g.rank").alias("max_severity_rank")
    )


def part_values(alerts: DataFrame) -> DataFrame:
    """Distinct ``(report, measure, key, field, value)`` of a part, in one scan."""
    seen = []
    for report, measure, key, column in DISTINCTS:
        row = F.struct(
            F.lit(report).alias("report"), F.lit(measure).alias("measure"), _text(key).alias("key"),
            F.lit(column).alias("field"), _text(column).alias("value"),
        )
        known = F.col(column).isNotNull()
        seen.append(F.when(known & F.col(key).isNotNull() if DEFINITIONS[report].known_only else known, row))
    return alerts.select(F.explode(F.array_compact(F.array(*seen))).alias("v")).select("v.*").distinct()


def listed_and_mapped(members: DataFrame, listed: int = LISTED) -> tuple[DataFrame, DataFrame]:
    """Distinct ``members(report, measure, key, id)`` → buckets as lists of positions and
    as bitmaps, each number in one of them."""
    placed = members.select(
        "report", "measure", "key", F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("position")
    )
    sizes = placed.groupBy(*[F.col(c).alias(f"_{c}") for c in _SET_KEY]).agg(F.count(F.lit(1)).alias("n"))
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _SET_KEY]
    full = placed.join(sizes.filter(F.col("n") > listed), same, "left_semi")
    few = placed.join(sizes.filter(F.col("n") <= listed), same, "left_semi")
    lists = few.groupBy(*_SET_KEY).agg(F.collect_list("position").alias("positions"))
    maps = full.groupBy(*_SET_KEY).agg(F.bitmap_construct_agg("position").alias("bits"))
    return lists, maps


def united_sizes(lists: DataFrame, maps: DataFrame) -> DataFrame:
    """``(report, measure, key, n)``: sizes of the united sets of all parts."""
    flat = lists.select(*_SET_KEY, F.explode("positions").alias("position"))
    full = maps.select(*[F.col(c).alias(f"_{c}") for c in _SET_KEY]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in _SET_KEY]
    # a bucket that no part has as a bitmap is counted by its positions
    alone = flat.join(full, same, "left_anti").distinct().groupBy("report", "measure", "key").agg(F.count(F.lit(1)).alias("n"))
    mixed = flat.join(full, same, "left_semi").groupBy(*_SET_KEY).agg(F.bitmap_construct_agg("position").alias("bits"))
    merged = maps.select(*_SET_KEY, "bits").unionByName(mixed).groupBy(*_SET_KEY).agg(F.bitmap_or_agg("bits").alias("bits"))
    counted = merged.groupBy("report", "measure", "key").agg(F.sum(F.bitmap_count("bits")).alias("n"))
    return alone.unionByName(counted).groupBy("report", "measure", "key").agg(F.sum("n").alias("n"))


class ReportRollups:
    """The parts of the reports below a folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str, listed: int = LISTED) -> None:
        self.spark, self.ledger, self.listed = spark, Ledger(spark, folder), listed

    def _number_values(self, values: DataFrame, part: int) -> DataFrame:
        """Add the part's unknown values to the dictionary; the whole dictionary."""
        known = self.ledger.read("dictionary")
        new = values.select("field", "value").distinct()
        first = 1
        if known is not None and not self.ledger.has("dictionary", part):
            new = new.join(known, ["field", "value"], "left_anti")
            first = (known.agg(F.max("id")).first()[0] or 0) + 1
        # a field's values next to each other, so that its buckets are full ones
        placed = self.ledger.keep("new-values", part, lambda: with_places(new.repartitionByRange("field", "value")))
        self.ledger.keep("dictionary", part, lambda: numbered(placed, "id", first))
        return self.ledger.read("dictionary")

    def add(self, part: int, alerts: DataFrame) -> bool:
        """Add the alerts of a part; False if it is there, which changes nothing.

        Parts are added one after another. The part counts once its last table is
        committed; what an attempt before that left behind is used, not repeated.
        """
        if self.ledger.has("maps", part):
            return False
        self.ledger.keep("counts", part, lambda: part_counts(alerts))
        values = self.ledger.keep("values", part, lambda: part_values(alerts))
        dictionary = self._number_values(values, part)
        members = self.ledger.keep(
            "members", part, lambda: values.join(dictionary, ["field", "value"]).select("report", "measure", "key", "id")
        )
        lists, maps = listed_and_mapped(members, self.listed)
        self.ledger.keep("lists", part, lambda: lists)
        self.ledger.keep("maps", part, lambda: maps)
        for kind in ("new-values", "values", "members"):
            self.ledger.forget(kind, part + 1)
        return True

    def add_days(self, alerts: DataFrame, days: list) -> list[int]:
        """Add ``alerts`` of each of ``days`` (dates; None for alerts without one) as a
        part of its own, numbered by the day. Returns the parts that were new."""
        out = []
        for day in days:
            part = -1 if day is None else day.toordinal()
            mine = alerts.filter(F.col("dt").isNull() if day is None else F.col("dt") == F.lit(day))
            if self.add(part, mine):
                out.append(part)
        return out

    def report(self, name: str) -> DataFrame:
        """The named report over all parts, as ``REPORTS[name]`` gives it over the alerts.

        The groups are cut to the report's limit before any set is united, so of a
        top-k report only k groups' sets are read into the aggregate.
        """
        report = DEFINITIONS[name]
        kind = {"dt": "date", "destinationPort": "int"}.get(report.key, "string")
        done = self.ledger.committed("maps")
        if not done:
            counts = self.spark.createDataFrame([], _COUNTS)
        else:
            counts = self.ledger.read_some("counts", done)
        sums = {"sum": F.sum, "max": F.max}
        plain = [m for m in report.measures if m.merge != "distinct"]
        groups = (
            counts.filter(F.col("report") == name)
            .groupBy("key")
            .agg(*[sums[m.merge](m.name).alias(m.name) for m in plain])
            .withColumn(report.key, F.col("key").cast(kind))
        )
        distinct = [m for m in report.measures if m.merge == "distinct"]
        if not done or not distinct:
            missing = [F.lit(0).cast("long").alias(m.name) for m in distinct]
            return report.cut(groups.select("*", *missing).select(report.key, *[m.name for m in report.measures]))
        if report.limit is not None:
            groups = report.cut(groups)
        wanted = groups.select(F.col("key").alias("_key"))
        sets = [self.ledger.read_some(k, done).filter(F.col("report") == name) for k in ("lists", "maps")]
        if report.limit is not None:
            sets = [s.join(wanted, F.col("key").eqNullSafe(F.col("_key")), "left_semi") for s in sets]
        sizes = united_sizes(*sets)
        for m in distinct:
            own = sizes.filter(F.col("measure") == m.name).select(F.col("key").alias("_key"), F.col("n").alias(m.name))
            groups = groups.join(own, F.col("key").eqNullSafe(F.col("_key")), "left").drop("_key")
        filled = groups.na.fill(0, [m.name for m in distinct])
        return report.cut(filled.select(report.key, *[m.name for m in report.measures]))
