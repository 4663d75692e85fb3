"""Pivot with zero fill and stacked-bar bases.

The columns of a wide result are a label list that the caller gives (branch
names, say): no job runs to find them, and the schema does not depend on the
rows.  ``dense_cells`` is the long form, with one row per cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pivot_sum(df: DataFrame, index: list[str], column: str, value: str, labels: list[str], fill: int = 0) -> DataFrame:
    """index x label matrix of sum(value); missing cells -> ``fill``."""
    zero = F.lit(fill).cast(df.schema[value].dataType)
    if not labels:
        return df.select(*index).limit(0)
    wide = df.groupBy(*index).pivot(column, labels).agg(F.sum(value))
    return wide.select(*index, *(F.coalesce(F.col(f"`{v}`"), zero).alias(str(v)) for v in labels))


def dense_cells(df: DataFrame, index: list[str], column: str, value: str, labels: list[str], fill: int = 0) -> DataFrame:
    """Long form of ``pivot_sum``: one row per (index, label), zero filled."""
    if not labels:
        return df.select(*index, column, value).limit(0)
    wide = pivot_sum(df, index, column, value, labels, fill)
    return wide.unpivot(index, [F.col(f"`{v}`") for v in labels], column, value)


def stack_bases(cells: DataFrame, group: list[str], order: str, value: str, base: str = "base") -> Column:
    """Cumulative sum of ``value`` over earlier ``order`` values within ``group``.

    base(first) = 0, base(n) = sum of the values before it: the bottom of each
    segment in a stacked bar.  Partitioned by the bar (``group``), so the
    window never sees more than one bar's cells.
    """
    w = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(w), F.lit(0).cast(cells.schema[value].dataType)).alias(base)
