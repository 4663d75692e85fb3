"""KPI views over the star schema and the documented operational queries.

* ``kpi_daily_branch``            - date x branch: money totals, discount %,
                                    distinct sales, units, average ticket, units per sale
* ``kpi_monthly_branch_category`` - year x month x branch x category: net, sales, units
* ``kpi_daily_range`` / ``kpi_monthly_range`` - the report loads (range + order)
* ``item_count``, ``sales_by_branch``, ``status_histogram`` - queries on the OLTP side

Both views group by branch *name* (not key), as the model defines them.  The
count of distinct sales is not additive across categories, so the monthly
view is never rolled up; totals are recomputed from the fact.

Range loads push a ``sale_month`` predicate to the fact so a partitioned fact
store prunes whole month partitions before the join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions.dates import month_in_range, year_month
from tillhouse.functions.money import guarded_ratio, sum_money
from tillhouse.model import DwTables, OpTables
from tillhouse.operators.joins import calendar

DAILY_COLUMNS = ["date", "branch", "city", "uf", "net", "gross", "discount", "discount_pct",
                 "n_sales", "units_sold", "avg_ticket", "units_per_sale"]
MONTHLY_COLUMNS = ["year", "month", "branch", "category", "net", "n_sales", "units_sold"]


def _ym(d: dt.date) -> int:
    return d.year * 100 + d.month


def kpi_daily_branch(dw: DwTables, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    fact = dw.fact_sale_item
    dates = dw.dim_date.select("date_sk", "date")
    if first is not None and last is not None:
        fact = fact.filter(F.col("sale_month").between(_ym(first), _ym(last)))
        dates = dates.filter(F.col("date").between(F.lit(first), F.lit(last)))
    x = (fact.select("date_sk", "branch_sk", "sale_id", "qty", "gross", "discount", "net")
         .join(calendar(dates), "date_sk")
         .join(dw.dim_branch.select("branch_sk", F.col("name").alias("branch"), "city", "uf"),
               "branch_sk"))
    g = x.groupBy("date", "branch", "city", "uf").agg(
        sum_money(F.col("net")).alias("net"),
        sum_money(F.col("gross")).alias("gross"),
        sum_money(F.col("discount")).alias("discount"),
        F.countDistinct("sale_id").alias("n_sales"),
        F.sum("qty").cast("long").alias("units_sold"),
    )
    return g.select(
        "date", "branch", "city", "uf", "net", "gross", "discount",
        guarded_ratio(F.col("discount"), F.col("gross"), 2, 100).alias("discount_pct"),
        "n_sales", "units_sold",
        guarded_ratio(F.col("net"), F.col("n_sales")).alias("avg_ticket"),
        guarded_ratio(F.col("units_sold"), F.col("n_sales")).alias("units_per_sale"),
    )


def kpi_monthly_branch_category(dw: DwTables, first: tuple[int, int] | None = None,
                                last: tuple[int, int] | None = None) -> DataFrame:
    fact = dw.fact_sale_item
    dates = dw.dim_date.select("date_sk", "year", "month")
    if first is not None and last is not None:
        fact = fact.filter(F.col("sale_month").between(first[0] * 100 + first[1], last[0] * 100 + last[1]))
        dates = dates.filter(month_in_range(F.col("year"), F.col("month"), *first, *last))
    x = (fact.select("date_sk", "branch_sk", "product_sk", "sale_id", "qty", "net")
         .join(calendar(dates), "date_sk")
         .join(dw.dim_branch.select("branch_sk", F.col("name").alias("branch")), "branch_sk")
         .join(dw.dim_product.select("product_sk", "category"), "product_sk"))
    return x.groupBy("year", "month", "branch", "category").agg(
        sum_money(F.col("net")).alias("net"),
        F.countDistinct("sale_id").alias("n_sales"),
        F.sum("qty").cast("long").alias("units_sold"),
    )


def kpi_daily_range(dw: DwTables, first: dt.date, last: dt.date) -> DataFrame:
    """Daily KPI rows with date BETWEEN first AND last, ordered by date, branch."""
    k = kpi_daily_branch(dw, first, last)
    return k.filter(F.col("date").between(F.lit(first), F.lit(last))).orderBy("date", "branch")


def kpi_monthly_range(dw: DwTables, y0: int, m0: int, y1: int, m1: int) -> DataFrame:
    """Monthly KPI rows with (year, month) in [(y0, m0), (y1, m1)], ordered."""
    k = kpi_monthly_branch_category(dw, (y0, m0), (y1, m1))
    return (k.filter(month_in_range(F.col("year"), F.col("month"), y0, m0, y1, m1))
            .orderBy("year", "month", "branch", "category"))


def report_window(as_of: dt.date, days: int) -> tuple[dt.date, dt.date]:
    """Daily report window: as_of - days .. as_of (inclusive)."""
    return as_of - dt.timedelta(days=days), as_of


# --- operational-side queries ----------------------------------------------

def item_count(op: OpTables) -> DataFrame:
    return op.sale_item.agg(F.count(F.lit(1)).alias("items"))


def sales_by_branch(op: OpTables) -> DataFrame:
    """Sales and revenue per branch name over all statuses, revenue descending.

    Revenue of a sale = sum(qty * unit_price - discount) of its items; items
    are pre-aggregated per sale before the join, sales without items still count.
    """
    per_sale = op.sale_item.groupBy("sale_id").agg(
        F.sum(F.col("qty").cast("decimal(10,0)") * F.col("unit_price") - F.col("discount")).alias("amount"))
    branches = op.branch.select("branch_id", F.col("name").alias("branch"))
    s = op.sale.select("sale_id", "branch_id").join(per_sale, "sale_id", "left").join(branches, "branch_id")
    return (s.groupBy("branch")
            .agg(F.count(F.lit(1)).alias("total_sales"), sum_money(F.col("amount")).alias("revenue"))
            .orderBy(F.desc_nulls_last("revenue"), "branch"))


def status_histogram(op: OpTables) -> DataFrame:
    return op.sale.groupBy("status").agg(F.count(F.lit(1)).alias("n")).orderBy("status")


def branch_listing(op: OpTables) -> DataFrame:
    """All branches ordered by id (the seed's quick check)."""
    return op.branch.orderBy("branch_id")


def sale_month_of(d: dt.date) -> int:
    return _ym(d)


__all__ = [
    "kpi_daily_branch", "kpi_monthly_branch_category", "kpi_daily_range", "kpi_monthly_range",
    "report_window", "item_count", "sales_by_branch", "status_histogram", "year_month",
]
