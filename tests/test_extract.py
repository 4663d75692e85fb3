"""The laid-out extract: partition filters on the mark, no exchange of items, counted lookups."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillhouse.plans import etl, validate
from tillhouse.sources.extract import Extract, changed_since, write_extract
from tillhouse.sources.store import WarehouseStore, parquet_stage

FIRST = dt.datetime(1990, 1, 1)
MARK = dt.datetime(1998, 1, 1)
AS_OF = dt.datetime(2002, 1, 1)


@pytest.fixture(scope="module")
def root(scratch, sf001_op):
    path = os.path.join(scratch, "extract")
    write_extract(sf001_op, path, item_buckets=8)
    return path


@pytest.fixture()
def extract(spark, root):
    with Extract(spark, root) as e:
        yield e


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def shuffled(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_same_rows(spark, extract, sf001_op):
    op = extract.read()
    for name in ("branch", "customer", "product", "sale", "sale_item"):
        a, b = getattr(op, name), getattr(sf001_op, name)
        assert a.columns == b.columns and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_mark_is_a_partition_filter(spark, extract, sf001_op):
    changed = extract.sale().where(changed_since(MARK))
    text = plan(changed)
    assert "PartitionFilters: [isnotnull(changed" in text and "(changed#" in text and ">= 199801" in text
    want = sf001_op.sale.where(F.col("updated_at") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    got = etl.changed_range_frame(extract.read(MARK).sale, MARK)
    assert changed.count() == want.count() and got.collect() == etl.changed_range_frame(sf001_op.sale, MARK).collect()
    scan = plan(got)
    assert "ReadSchema: struct<sold_at:timestamp_ntz,updated_at:timestamp_ntz>" in scan and ">= 199801" in scan
    middle = dt.datetime(1998, 1, 15, 12)
    assert extract.sale().where(changed_since(middle)).count() == sf001_op.sale.where(
        F.col("updated_at") >= F.lit(middle.isoformat(sep=" ")).cast("timestamp_ntz")).count()


def test_items_are_joined_where_they_lie(spark, extract, sf001_op, sf001_dw, shuffled):
    source = etl.fact_source(extract.read(), sf001_dw, FIRST, AS_OF)
    text = plan(source)
    plain = etl.fact_source(sf001_op, sf001_dw, FIRST, AS_OF)
    assert "Bucketed: true" in text and text.count("Exchange hashpartitioning(sale_id") == 1, "only the sales are dealt out"
    assert plan(plain).count("Exchange hashpartitioning(sale_id") == 2
    assert source.exceptAll(plain).count() == 0 == plain.exceptAll(source).count()


def test_sales_without_customer_are_spread(sf001_op, sf001_dw, shuffled):
    nobody = sf001_op.with_(sale=sf001_op.sale.withColumn("customer_id", F.when(F.col("note").isNotNull(), F.col("customer_id"))))
    source = etl.fact_source(nobody, sf001_dw, FIRST, AS_OF)
    keys = [line for line in plan(source).splitlines() if "Exchange hashpartitioning(_ck" in line]
    assert keys, plan(source)
    spread = nobody.sale.select(etl.customer_key().alias("k")).distinct().count()
    assert spread > 500 and source.where("customer_sk is not null").count() == 0


def test_load_from_the_extract(spark, scratch, root, sf001_op):
    st = WarehouseStore(os.path.join(scratch, "from_extract"))
    with Extract(spark, root) as e:
        st.run(e.read(), AS_OF, initial_mark=FIRST)
        ok, rows = validate.run_checks(e.read(), st.read(spark))
        assert ok, rows
        tables = list(e.tables)
    assert tables and not [t.name for t in spark.catalog.listTables() if t.name in tables], "no catalog entry is left behind"


def test_lookup_counts(spark, sf001_op, sf001_dw):
    lost_branch = sf001_dw.with_(dim_branch=sf001_dw.dim_branch.where("branch_id <> 3"),
                                 dim_product=sf001_dw.dim_product.where("product_id % 10 <> 0"))
    counted = etl.LookupCounts(spark)
    rows = parquet_stage("counted", etl.fact_source(sf001_op, lost_branch, FIRST, AS_OF, counts=counted))
    got = counted.get()
    done = sf001_op.sale.where("status = 'COMPLETED'")
    items = sf001_op.sale_item.join(done.where("branch_id <> 3").select("sale_id"), "sale_id")
    assert got == {
        "sales_read": done.count(), "sales_without_date": 0, "sales_without_branch": done.where("branch_id = 3").count(),
        "sales_without_customer": done.where("branch_id <> 3 and customer_id is null").count(),
        "items_read": items.count(), "items_without_product": items.where("product_id % 10 = 0").count(), "rows_loaded": rows.count()}
    plain = etl.fact_source(sf001_op, lost_branch, FIRST, AS_OF)
    assert rows.exceptAll(plain).count() == 0 == plain.exceptAll(rows).count()


def test_run_reports_counts(spark, scratch, sf001_op):
    st = WarehouseStore(os.path.join(scratch, "counted"))
    one = st.run(sf001_op, AS_OF, initial_mark=FIRST)
    assert one.lookups["rows_loaded"] == 1995 and one.lookups["items_without_product"] == 0
    stored = st.lookup_counts(spark)
    assert {r["counter"]: r["n"] for r in stored.collect()} == one.lookups
