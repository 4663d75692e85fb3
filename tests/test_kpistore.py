"""Stored KPI tables: equal to the views, refreshed by manifest difference."""

import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tillhouse.functions.dates import ntz
from tillhouse.operators.rank import ordered_positions
from tillhouse.plans import kpi
from tillhouse.sources.kpistore import KpiStore, distinct_sales, quarter_of, sale_bitmaps
from tillhouse.sources.store import WarehouseStore, parquet_stage

FIRST = dt.datetime(1990, 1, 1)
AS_OF = dt.datetime(2002, 1, 1)


@pytest.fixture(scope="module")
def kpis(spark, scratch, sf001_op):
    st = WarehouseStore(os.path.join(scratch, "kpis"), dim_bucket_rows=50)
    st.run(sf001_op, AS_OF, initial_mark=FIRST)
    k = KpiStore(st)
    done = k.refresh(spark, 1)
    assert {name: len(m) for name, m in done.items()} == dict.fromkeys(done, len(k.manifest(spark, 1)["kpi_daily"]))
    return st, k


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def files(root, name):
    return {p for p in glob.glob(os.path.join(root, name, "sale_month=*", "kv=*", "*.parquet"))}


def test_stored_equals_view(spark, kpis):
    st, k = kpis
    dw = st.read(spark, 1)
    assert same(k.daily(spark, 1), kpi.kpi_daily_branch(dw).select(*kpi.DAILY_COLUMNS))
    assert same(k.monthly(spark, 1), kpi.kpi_monthly_branch_category(dw))
    d0, d1 = dt.date(1999, 3, 10), dt.date(1999, 5, 2)
    part = k.daily(spark, 1, d0, d1)
    assert same(part, kpi.kpi_daily_range(dw, d0, d1).select(*kpi.DAILY_COLUMNS)) and "sale_month" in part._jdf.queryExecution().toString()


def test_rollup_counts_distinct_sales_without_the_fact(spark, kpis):
    st, k = kpis
    dw = st.read(spark, 1)
    x = dw.fact_sale_item.join(dw.dim_branch.select("branch_sk", F.col("name").alias("branch"), "city", "uf"), "branch_sk")
    for period, by in ((quarter_of(), ["city"]), (F.floor(F.col("sale_month") / 100).cast("int"), ["city", "uf"]), (F.lit(0), [])):
        got = k.rollup(spark, 1, period, *by)
        want = x.groupBy(period.alias("period"), *by).agg(F.sum("net").cast("decimal(18,2)").alias("net"),
                                                         F.countDistinct("sale_id").alias("n_sales"), F.sum("qty").cast("long").alias("units_sold"))
        assert same(got, want)
        assert not [f for f in got.inputFiles() if "fact_sale_item" in f]


def test_only_changed_months_are_recomputed(spark, kpis, sf001_op):
    st, k = kpis
    before = {name: files(st.root, name) for name in ("kpi_daily", "kpi_monthly", "kpi_sales")}
    stamp = AS_OF + dt.timedelta(days=1)
    month = (F.year("sold_at") == 1999) & (F.month("sold_at") == 4)
    sale = sf001_op.sale.withColumn("updated_at", F.when(month, ntz(stamp)).otherwise(F.col("updated_at")))
    st.run(sf001_op.with_(sale=sale), AS_OF + dt.timedelta(days=2))
    assert k.refresh(spark, 2, 1) == {"kpi_daily": [199904], "kpi_monthly": [199904], "kpi_sales": [199904]}
    for name, old in before.items():
        assert old <= files(st.root, name) and {re.search(r"sale_month=(\d+)", f).group(1) for f in files(st.root, name) - old} == {"199904"}
    # a changed category: the monthly rows of the months that sold the product, no daily row
    sold = st.read(spark, 2).fact_sale_item.groupBy("product_sk").agg(F.countDistinct("sale_month").alias("n")).orderBy("n", "product_sk").first()
    product_id = st.read(spark, 2).dim_product.where(F.col("product_sk") == sold["product_sk"]).first()["product_id"]
    months = {r[0] for r in st.read(spark, 2).fact_sale_item.where(F.col("product_sk") == sold["product_sk"]).select("sale_month").distinct().collect()}
    product = sf001_op.product.withColumn("category", F.when(F.col("product_id") == product_id, "OTHER").otherwise(F.col("category")))
    one = sale.withColumn("updated_at", F.when(month, ntz(stamp + dt.timedelta(days=5))).otherwise(F.col("updated_at")))
    st.run(sf001_op.with_(sale=one, product=product), AS_OF + dt.timedelta(days=9))
    assert k.refresh(spark, 3, 2) == {"kpi_daily": [199904], "kpi_monthly": sorted(months | {199904}), "kpi_sales": [199904]}
    dw = st.read(spark, 3)
    assert same(k.monthly(spark, 3), kpi.kpi_monthly_branch_category(dw)) and same(k.daily(spark, 3), kpi.kpi_daily_branch(dw).select(*kpi.DAILY_COLUMNS))
    # another branch name: every month of both views, no bitmap
    branch = sf001_op.branch.withColumn("name", F.when(F.col("branch_id") == 3, "RENAMED").otherwise(F.col("name")))
    two = sale.withColumn("updated_at", F.when(month, ntz(stamp + dt.timedelta(days=15))).otherwise(F.col("updated_at")))
    st.run(sf001_op.with_(sale=two, product=product, branch=branch), AS_OF + dt.timedelta(days=19))
    done = k.refresh(spark, 4, 3)
    assert len(done["kpi_daily"]) == len(done["kpi_monthly"]) == len(k.manifest(spark, 4)["kpi_daily"]) and done["kpi_sales"] == [199904]
    assert same(k.daily(spark, 4), kpi.kpi_daily_branch(st.read(spark, 4)).select(*kpi.DAILY_COLUMNS))
    assert same(k.daily(spark, 1), kpi.kpi_daily_branch(st.read(spark, 1)).select(*kpi.DAILY_COLUMNS)), "older versions stay readable"


def test_bitmaps_of_sparse_and_dense_ids(spark):
    rows = [(200001 + i % 3, i % 2, s) for i, s in enumerate([*range(1, 400), 32768, 32769, 10**12, 10**12 + 1, 5, 5, 5])]
    fact = spark.createDataFrame(rows, "sale_month int, branch_sk int, sale_id long")
    got = distinct_sales(sale_bitmaps(fact), ["branch_sk"])
    want = fact.groupBy("branch_sk").agg(F.countDistinct("sale_id").alias("n_sales"))
    assert same(got, want) and distinct_sales(sale_bitmaps(fact.limit(0)), ["branch_sk"]).count() == 0


def test_positions_of_any_table(spark):
    rows = [(i, "same" if i % 3 else f"name{i % 7}", None if i % 11 == 0 else i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, name string, k long")
    for order in (["name", "id"], ["k", "name", "id"]):
        got = ordered_positions(df, order, parquet_stage, ranges=6)
        want = df.withColumn("pos", (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))
        assert same(got, want)
        assert got.select("pos").distinct().count() == 3000
        sizes = [r["count"] for r in parquet_stage("p", df.repartitionByRange(6, *order).withColumn("r", F.spark_partition_id())).groupBy("r").count().collect()]
        assert len(sizes) == 6 and max(sizes) < 2 * 3000 / 6, "a value that most rows share is split"
    assert ordered_positions(df.limit(0), ["id"], parquet_stage).count() == 0
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window " in line and "row_number" in line]
    assert windows and all("_range" in w for w in windows)
