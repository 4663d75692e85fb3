"""Report datasets built on the KPI range loads.

R1 ``daily_net_pivot``      - date x branch matrix of net (dates without rows are absent)
R2 ``branch_totals``        - net per branch over the window, descending
R3 ``weekday_matrix``       - ISO weekday x branch matrix of net
R4 ``top_category_matrix``  - (period, category) x branch matrix of net for the
                              top categories; ``stack_cells`` adds the stacked-bar bases

Only the final matrix (bounded by dates/branches/categories) is meant to be
collected; everything before it is a distributed plan.  The reference draws
these as images; here they are DataFrames a caller writes or plots.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.functions.dates import axis_label, period_label
from tillhouse.operators.joins import calendar
from tillhouse.operators.pivot import dense_cells, pivot_sum, stack_bases


def branch_labels(dw) -> list[str]:
    """The branch names, in order: the columns of the wide reports."""
    return [r["name"] for r in dw.dim_branch.select("name").distinct().orderBy("name").collect()]


def daily_net_pivot(daily: DataFrame, branches: list[str]) -> DataFrame:
    return pivot_sum(daily, ["date"], "branch", "net", branches).orderBy("date")


def branch_totals(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("branch").agg(F.sum("net").cast(S.SUM_MONEY).alias("net"))
            .orderBy(F.desc("net"), "branch"))


def weekday_cells(daily: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Daily rows with the weekday of their date (left join on date)."""
    days = calendar(dim_date.select("date", "weekday"))
    return daily.join(days, "date", "left").filter(F.col("weekday").isNotNull())


def weekday_matrix(daily: DataFrame, dim_date: DataFrame, branches: list[str]) -> DataFrame:
    return pivot_sum(weekday_cells(daily, dim_date), ["weekday"], "branch", "net", branches).orderBy("weekday")


def with_period(monthly: DataFrame) -> DataFrame:
    return monthly.withColumn("period", period_label(F.col("year"), F.col("month")))


def top_categories(monthly: DataFrame, k: int = S.TOP_CATEGORIES) -> DataFrame:
    """The k categories with the largest net in the window (ties by name)."""
    return (monthly.groupBy("category").agg(F.sum("net").cast(S.SUM_MONEY).alias("net"))
            .orderBy(F.desc("net"), "category").limit(k))


def top_category_rows(monthly: DataFrame, k: int = S.TOP_CATEGORIES) -> DataFrame:
    top = F.broadcast(top_categories(monthly, k).select("category"))  # at most k rows
    return with_period(monthly).join(top, "category", "left_semi")


def top_category_matrix(monthly: DataFrame, branches: list[str], k: int = S.TOP_CATEGORIES) -> DataFrame:
    rows = top_category_rows(monthly, k)
    wide = pivot_sum(rows, ["period", "category"], "branch", "net", branches)
    return wide.withColumn("label", axis_label(F.col("period"), F.col("category"))).orderBy("period", "category")


def stack_cells(monthly: DataFrame, branches: list[str], k: int = S.TOP_CATEGORIES) -> DataFrame:
    """Long form of the top-category matrix with each segment's base."""
    rows = top_category_rows(monthly, k)
    cells = dense_cells(rows, ["period", "category"], "branch", "net", branches)
    return cells.select("period", "category", axis_label(F.col("period"), F.col("category")).alias("label"), "branch", "net",
                        stack_bases(cells, ["period", "category"], "branch", "net"))


def report_datasets(dw, as_of, days: int = S.DEFAULT_REPORT_DAYS) -> dict:
    """All report datasets for the window ``as_of - days .. as_of``.

    The monthly window covers whole months from the first to the last day.
    """
    from tillhouse.plans import kpi

    first, last = kpi.report_window(as_of, days)
    branches = branch_labels(dw)
    daily = kpi.kpi_daily_range(dw, first, last)
    monthly = kpi.kpi_monthly_range(dw, first.year, first.month, last.year, last.month)
    return {
        "kpi_daily": daily,
        "kpi_monthly": monthly,
        "01_daily_net_by_branch": daily_net_pivot(daily, branches),
        "02_net_total_by_branch": branch_totals(daily),
        "03_weekday_x_branch": weekday_matrix(daily, dw.dim_date, branches),
        "04_monthly_top_categories": top_category_matrix(monthly, branches),
        "04_monthly_top_categories_stack": stack_cells(monthly, branches),
    }


def write_reports(datasets: dict, out: str) -> list[str]:
    """Write each dataset that has rows as one CSV folder ``<out>/<name>``, in as many files as it has partitions.

    The two range loads feed every report, so they are persisted while the
    reports are written (each is computed once; a lost block is recomputed).
    """
    loads = [datasets[k] for k in ("kpi_daily", "kpi_monthly") if k in datasets]
    for df in loads:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    written = []
    try:
        for name, df in datasets.items():
            if df.isEmpty():
                continue
            path = f"{out.rstrip('/')}/{name}"
            df.write.mode("overwrite").option("header", True).csv(path)
            written.append(path)
    finally:
        for df in loads:
            df.unpersist()
    return written


def read_report(spark, out: str, name: str, schema) -> DataFrame:
    """A written report; the header is checked against ``schema``.  Labels hold line breaks, hence multiLine."""
    return spark.read.schema(schema).csv(f"{out.rstrip('/')}/{name}", header=True, multiLine=True, enforceSchema=False)
