"""Positions of rows in an order, for tables of any size.

``row_number()`` over a window without partition key sends all rows to one
task.  Here rows are dealt into ranges of the order, counted per range, and
numbered within their range from the sum of the counts before it; the only
window without a key runs over one row per range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def ordered_positions(table: DataFrame, order: list[str], stage: Callable[[str, DataFrame], DataFrame],
                      ranges: int | None = None, pos: str = "pos") -> DataFrame:
    """``table`` with column ``pos``: 0 for the first row by ``order``, 1 for the next, and so on.

    ``order`` must be unique (end it with a key): rows that share a leading
    value, however many, are then split over ranges like any others.  Ranges
    come from a sample of the rows, so the dealt rows are written by ``stage``
    (a store's write and read back) before they are counted and numbered.
    Nulls come first, as in an ascending sort.
    """
    n = ranges or int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stage("ranges", table.repartitionByRange(n, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("_range").count().select(
        "_range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return (dealt.join(F.broadcast(offsets), "_range")      # one row per range
            .withColumn(pos, (F.col("_offset") + within - 1).cast("long")).drop("_range", "_offset"))
