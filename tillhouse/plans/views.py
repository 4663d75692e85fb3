"""SQL surface: warehouse tables and KPI views as temp views, parameterised loads.

``register`` makes the tables and the two KPI views queryable from SQL
(``CREATE OR REPLACE VIEW`` semantics); ``load_daily`` / ``load_monthly`` are
the report loads written as parameterised SQL over the views.  Catalyst
pushes the date predicates below the view's aggregate and into the scans,
the same plan the DataFrame API gives.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tillhouse.model import DwTables, OpTables
from tillhouse.plans import kpi

DAILY_VIEW = "kpi_daily_branch"
MONTHLY_VIEW = "kpi_monthly_branch_category"


def register(spark: SparkSession, dw: DwTables, op: OpTables | None = None) -> None:
    for name, df in dw.items():
        df.createOrReplaceTempView(name)
    if op is not None:
        for name in ("branch", "customer", "product", "sale", "sale_item"):
            getattr(op, name).createOrReplaceTempView(f"op_{name}")
    kpi.kpi_daily_branch(dw).createOrReplaceTempView(DAILY_VIEW)
    kpi.kpi_monthly_branch_category(dw).createOrReplaceTempView(MONTHLY_VIEW)


def load_daily(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """The daily KPI rows of a window of days."""
    return spark.sql(f"SELECT v.* FROM {DAILY_VIEW} v WHERE v.date >= :start AND v.date < :stop ORDER BY v.date, v.branch",
                     args={"start": first, "stop": last + dt.timedelta(days=1)})


def load_monthly(spark: SparkSession, y0: int, m0: int, y1: int, m1: int) -> DataFrame:
    """The monthly KPI rows of a span of months, both ends included."""
    return spark.sql(f"SELECT v.* FROM {MONTHLY_VIEW} v WHERE v.year * 100 + v.month BETWEEN :start AND :stop "
                     "ORDER BY v.year, v.month, v.branch, v.category",
                     args={"start": y0 * 100 + m0, "stop": y1 * 100 + m1})


def item_count_sql(spark: SparkSession) -> DataFrame:
    """The documented count of sale items (needs ``register(..., op)``)."""
    return spark.sql("SELECT COUNT(*) AS items FROM op_sale_item")
