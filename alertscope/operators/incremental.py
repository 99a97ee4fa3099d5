"""Incremental load against a high-water mark.

The mark is ``(mark_ts, mark_id)`` in long form: one row per alert id seen
at the mark instant, or one row with a null id when that set is empty; an
empty frame means "no mark". Keeping it as a table (not an array on the
driver) means the id set can be any size and the "seen" test is a join.

Rules (``is new`` against the mark taken at batch start):

* no mark, or the row has no timestamp → new;
* timestamp after the mark → new;
* timestamp equal to the mark → new only if the id is non-null and not in
  the mark's ids;
* timestamp before the mark → not new.

Because every row is tested against the same snapshot, order inside a
batch does not matter and in-batch duplicates both pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from alertscope.functions.text import node_text, non_blank
from alertscope.functions.time import strict_instant
from alertscope.schema import MARK_SCHEMA

UNKNOWN_KEY = "unknown"


def empty_mark(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], MARK_SCHEMA)


def mark_instant(mark: DataFrame) -> F.Column:
    """The mark's instant as a scalar subquery (null when there is no mark)."""
    return mark.select(F.max("mark_ts")).scalar()


def is_new(ts: F.Column, rid: F.Column, mark_ts: F.Column, mark_ids: F.Column) -> F.Column:
    """The "is new" rule as a Column, for a mark given as values (a literal
    instant and an array of ids, or columns of a joined one-row mark).
    For a mark kept as a table use ``new_since_mark``."""
    seen = F.coalesce(F.array_contains(mark_ids, rid), F.lit(False))
    return (
        ts.isNull()
        | mark_ts.isNull()
        | (ts > mark_ts)
        | ((ts == mark_ts) & rid.isNotNull() & ~seen)
    )


def new_since_mark(
    batch: DataFrame, mark: DataFrame, ts_col: str = "cursor_ts", id_col: str = "cursor_id"
) -> DataFrame:
    """Rows of ``batch`` that are new against ``mark``.

    The instant comparison uses a one-value scalar subquery; the seen-id
    test is a left anti join on (instant, id), which Catalyst broadcasts
    only when the mark's measured size is under the broadcast threshold
    and otherwise shuffles on both keys.
    """
    ts, rid = F.col(ts_col), F.col(id_col)
    m_ts = mark_instant(mark)
    candidates = batch.filter(
        ts.isNull() | m_ts.isNull() | (ts > m_ts) | ((ts == m_ts) & rid.isNotNull())
    )
    seen = mark.filter(F.col("mark_id").isNotNull()).select(
        F.col("mark_ts").alias("_seen_ts"), F.col("mark_id").alias("_seen_id")
    )
    return candidates.join(
        seen, (ts == F.col("_seen_ts")) & (rid == F.col("_seen_id")), "left_anti"
    )


def new_over_pages(
    batch: DataFrame,
    mark: DataFrame,
    page_col: str = "page_seq",
    ts_col: str = "cursor_ts",
    id_col: str = "cursor_id",
) -> DataFrame:
    """Rows of ``batch`` that are new when its pages are polled one after another.

    Each page is tested against the mark as the pages before it, in the order of
    ``page_col``, have left it; rows of one page are tested against one snapshot,
    so its own duplicates both pass. The mark's instant before a page is the
    latest of the stored mark and of all earlier pages (one row per page), and
    an id was seen at it if it is in the stored mark or on an earlier page.
    """
    ts, rid = F.col(ts_col), F.col(id_col)
    earlier = Window.orderBy(page_col).rowsBetween(Window.unboundedPreceding, -1)
    before = (
        batch.groupBy(page_col)
        .agg(F.max(ts_col).alias("_top"))
        .select(page_col, F.max("_top").over(earlier).alias("_before"))
    )
    stored = mark_instant(mark)
    rows = batch.join(before, page_col).withColumn("_at", F.greatest("_before", stored))
    at = F.col("_at")
    rows = rows.filter(ts.isNull() | at.isNull() | (ts > at) | ((ts == at) & rid.isNotNull()))
    seen = mark.filter(F.col("mark_id").isNotNull()).select(
        F.col("mark_ts").alias("_seen_ts"), F.col("mark_id").alias("_seen_id")
    )
    rows = rows.join(seen, (ts == F.col("_seen_ts")) & (rid == F.col("_seen_id")), "left_anti")
    first = (
        batch.filter(ts.isNotNull() & rid.isNotNull())
        .groupBy(ts.alias("_first_ts"), rid.alias("_first_id"))
        .agg(F.min(page_col).alias("_first_page"))
    )
    rows = rows.join(first, (ts == F.col("_first_ts")) & (rid == F.col("_first_id")), "left")
    again = (ts == at) & (F.col("_first_page") < F.col(page_col))
    return rows.filter(~F.coalesce(again, F.lit(False))).select(*batch.columns)


def next_mark(
    observed: DataFrame, mark: DataFrame, ts_col: str = "cursor_ts", id_col: str = "cursor_id"
) -> DataFrame:
    """The mark after observing (publishing) ``observed``.

    A null timestamp never advances it; a later instant replaces it (with
    the ids seen at that instant, null ids contributing nothing); an equal
    instant adds ids; an earlier one leaves it unchanged. Applied to a whole
    batch this is: latest instant over old mark ∪ rows, with every non-null
    id seen at it.
    """
    rows = observed.filter(F.col(ts_col).isNotNull()).select(
        F.col(ts_col).cast("timestamp").alias("mark_ts"), F.col(id_col).alias("mark_id")
    )
    both = rows.unionByName(mark.select("mark_ts", "mark_id").filter(F.col("mark_ts").isNotNull()))
    # one row per task to the maximum, then the rows at it
    at_latest = both.filter(F.col("mark_ts") == both.select(F.max("mark_ts")).scalar())
    known = at_latest.filter(F.col("mark_id").isNotNull()).distinct()
    none = at_latest.groupBy("mark_ts").agg(F.count("mark_id").alias("n"))
    bare = none.filter("n = 0").select("mark_ts", F.lit(None).cast("string").alias("mark_id"))
    return known.unionByName(bare)


def timestamp_only(mark: DataFrame) -> DataFrame:
    """The mark as a timestamp-only store keeps it: ``(ts, ∅)``.

    After a restart from such a mark, rows at exactly that instant are
    new again (at-least-once).
    """
    return mark.select(F.max("mark_ts").alias("mark_ts")).filter(
        F.col("mark_ts").isNotNull()
    ).select("mark_ts", F.lit(None).cast("string").alias("mark_id"))


def publish_key(device: F.Column | str) -> F.Column:
    """Message key: the device id text if it is not blank (kept untrimmed), else 'unknown'."""
    col = F.col(device) if isinstance(device, str) else device
    return F.when(non_blank(col), col).otherwise(F.lit(UNKNOWN_KEY))


def cursor_fields(raw: DataFrame, alert_col: str = "alert", json_col: str = "json") -> DataFrame:
    """Add ``cursor_ts`` / ``cursor_id`` / ``publish_key`` to raw alerts (variant).

    ``cursor_ts`` is set only when ``timestamp`` holds a full ISO-8601
    instant with zone (a JSON number or container never renders as one, so
    the pattern also enforces "is a string"); ``cursor_id`` is the text of
    ``alertId`` whatever its JSON type (``100.0`` stays ``100.0``, ``1e3`` reads
    ``1000.0``); a JSON null reads as null.
    """
    v = F.col(alert_col)
    names = ("timestamp", "deviceId", "alertId")
    nodes = raw.select("*", *[F.try_variant_get(v, f"$.{n}", "variant").alias(f"_n_{n}") for n in names])
    text = {
        n: node_text(F.col(f"_n_{n}"), None, F.get_json_object(json_col, f"$.{n}") if json_col in raw.columns else None)
        for n in names
    }
    staged = nodes.select(*raw.columns, *[text[n].alias(f"_t_{n}") for n in names])
    return staged.select(
        *raw.columns,
        strict_instant("_t_timestamp").alias("cursor_ts"),
        F.col("_t_alertId").alias("cursor_id"),
        publish_key("_t_deviceId").alias("publish_key"),
    )
