"""Whole numbers for rows, without gaps and without a single task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The column that ``with_places`` adds.
PLACE = "_place"


def with_places(rows: DataFrame) -> DataFrame:
    """``rows`` with a place that is unique but has gaps. Write the result before
    ``numbered`` reads it, as a place depends on how the rows are partitioned."""
    return rows.withColumn(PLACE, F.monotonically_increasing_id())


def numbered(placed: DataFrame, column: str, first: int = 1) -> DataFrame:
    """``placed`` with ``column``: numbers from ``first`` on, in the order of the places,
    which are dropped. The driver sees one count per partition that wrote them."""
    part = F.shiftright(PLACE, 33)
    starts, at = [], first
    for p, n in sorted(placed.groupBy(part.alias("p")).count().collect()):
        starts.append((p, at))
        at += n
    starts = placed.sparkSession.createDataFrame(starts, "_part long, _start long")
    row = F.col(PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.join(starts, part == F.col("_part"))
        .withColumn(column, F.col("_start") + row)
        .drop(PLACE, "_part", "_start")
    )
