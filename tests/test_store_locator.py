"""Item locator and bucketed dimensions: which files a load reads and writes."""

import datetime as dt
import glob
import os
import re

import pytest
from pyspark.sql import functions as F

from tillhouse.functions.dates import ntz
from tillhouse.plans import validate
from tillhouse.sources import dimstore
from tillhouse.sources import locator as L
from tillhouse.sources.store import WarehouseStore, parquet_stage

FIRST = dt.datetime(1990, 1, 1)
AS_OF = dt.datetime(2002, 1, 1)
LATER = dt.datetime(2002, 2, 1)


@pytest.fixture(scope="module")
def loaded(spark, scratch, sf001_op):
    st = WarehouseStore(os.path.join(scratch, "located"), dim_bucket_rows=10)
    st.run(sf001_op, AS_OF, initial_mark=FIRST)
    entries = [(r["sale_month"], r["fv"]) for r in st.manifest(spark, 1).collect()]
    return st, entries


def months_of(df):
    return {int(m.group(1)) for m in (re.search(r"sale_month=(\d+)", f) for f in df.inputFiles()) if m}


def test_summaries_and_filters(spark, loaded):
    st, entries = loaded
    fact = st.read(spark).fact_sale_item
    want = {r["sale_month"]: (r["n"], r["lo"], r["hi"]) for r in fact.groupBy("sale_month").agg(
        F.count("*").alias("n"), F.min("item_id").alias("lo"), F.max("item_id").alias("hi")).collect()}
    got = st.locator.summary(spark, entries).collect()
    assert {r["sale_month"]: (r["n_items"], r["ranges"][0]["lo"], r["ranges"][-1]["hi"]) for r in got} == want
    assert all(len(r["ranges"]) <= L.RANGES and r["ranges"] == sorted(r["ranges"]) for r in got) and any(len(r["ranges"]) > 1 for r in got)
    inside = F.exists("ranges", lambda r: F.col("item_id").between(r["lo"], r["hi"]))
    held = fact.select("item_id", "sale_month").join(st.locator.summary(spark, entries), "sale_month").where(inside)
    assert held.count() == fact.count(), "every stored id lies in a range of its folder"
    blocks = st.locator._read(spark, "fact_filter", L.FILTER, entries)
    asked = fact.select("item_id", F.lit(0).alias("sale_month"))
    found = L.candidates(asked, st.locator.summary(spark, entries), blocks)
    true = fact.select("item_id", "sale_month")
    assert found.join(true, ["item_id", "sale_month"], "left_semi").count() == true.count(), "no false negatives"
    strangers = spark.range(1, 20000).select((F.col("id") * 7 + 50).alias("item_id"), F.lit(0).alias("sale_month")).join(true.select("item_id"), "item_id", "left_anti")
    met = strangers.count() * len(entries)
    assert L.candidates(strangers, st.locator.summary(spark, entries), blocks).count() < 0.05 * met


def test_old_and_new_sale_read_few_months(spark, loaded, sf001_op):
    st, entries = loaded
    fact = st.read(spark).fact_sale_item
    old_sale = fact.orderBy("sale_month", "sale_id").first()["sale_id"]
    rows = fact.where(F.col("sale_id") == old_sale)
    here = rows.first()["sale_month"]
    # the old sale's items under a new month, and items never seen, under ids on both ends of the span
    moved = rows.select("item_id", F.lit(200201).alias("sale_month")).union(
        spark.range(3).select((F.col("id") + 10**9).alias("item_id"), F.lit(200201).alias("sale_month")))
    found = st.stored_elsewhere(parquet_stage("moved", moved), entries)
    assert here in months_of(found) and len(months_of(found)) <= 3 < len(entries)
    assert {r["sale_month"] for r in found.collect()} == {here} and found.count() == rows.count()
    assert st.stored_elsewhere(rows.select("item_id", "sale_month"), entries).count() == 0


def test_moved_sales_are_replaced(spark, loaded, sf001_op):
    st, _ = loaded
    moved = F.col("sale_id") % 53 == 0
    stamp = LATER - dt.timedelta(days=1)
    sale = (sf001_op.sale.withColumn("sold_at", F.when(moved, F.col("sold_at") + F.expr("INTERVAL 40 DAYS")).otherwise(F.col("sold_at")))
            .withColumn("updated_at", F.when(moved, ntz(stamp)).otherwise(F.col("updated_at"))))
    op = sf001_op.with_(sale=sale)
    before = {(r["sale_month"], r["fv"]) for r in st.manifest(spark, 1).collect()}
    st.run(op, LATER)
    after = {(r["sale_month"], r["fv"]) for r in st.manifest(spark, 2).collect()}
    assert before & after, "months without a moved sale keep their folder"
    dw = st.read(spark)
    assert dw.fact_sale_item.count() == dw.fact_sale_item.select("item_id").distinct().count() == 1995
    ok, rows = validate.run_checks(op, dw)
    assert ok, rows


def dim_files(root, name):
    return {p: os.path.getmtime(p) for p in glob.glob(os.path.join(root, name, "bucket=*", "dv=*", "*.parquet"))}


def test_unchanged_buckets_keep_their_files(spark, scratch, sf001_op):
    root = os.path.join(scratch, "bucketed")
    st = WarehouseStore(root, dim_bucket_rows=10)
    st.run(sf001_op, AS_OF, initial_mark=FIRST)
    n = {name: st.dims[name].manifest(spark, 1).buckets for name in st.dims}
    first = {name: dim_files(root, name) for name in st.dims}
    assert n["dim_customer"] == 15 and n["dim_product"] == 20 and n["dim_branch"] == 3
    old = {r["customer_id"]: r.asDict() for r in st.read(spark).dim_customer.collect()}

    stamp = LATER - dt.timedelta(days=1)
    one_sale = sf001_op.sale.orderBy("sale_id").limit(1).select("sale_id")
    touch = sf001_op.sale.join(one_sale.withColumn("t", F.lit(True)), "sale_id", "left")
    sale = touch.withColumn("updated_at", F.when(F.col("t"), ntz(stamp)).otherwise(F.col("updated_at"))).drop("t")
    gone, changed = 5, 7
    customer = sf001_op.customer.where(F.col("customer_id") != gone).withColumn(
        "city", F.when(F.col("customer_id") == changed, "MOVED").otherwise(F.col("city")))
    new = sf001_op.customer.where(F.col("customer_id") == 1).withColumn("customer_id", F.lit(9001).cast("long"))
    op = sf001_op.with_(sale=sale, customer=customer.unionByName(new))
    st.run(op, LATER)
    m = st.dims["dim_customer"].manifest(spark, 2)
    rewritten = {b for b, e in m.entries.items() if e.dv == 2}
    assert 1 <= len(rewritten) <= 3 and all(e.dv == 1 for name in ("dim_product", "dim_branch")
                                            for e in st.dims[name].manifest(spark, 2).entries.values())
    for name, files in first.items():
        now = dim_files(root, name)
        assert all(now[p] == t for p, t in files.items())
        assert {int(re.search(r"bucket=(\d+)", p).group(1)) for p in now.keys() - files.keys()} == (rewritten if name == "dim_customer" else set())
    rows = {r["customer_id"]: r.asDict() for r in st.read(spark).dim_customer.collect()}
    assert rows.keys() == old.keys() | {9001} and rows[changed]["city"] == "MOVED"
    assert rows[9001]["customer_sk"] == max(r["customer_sk"] for r in old.values()) + 1
    assert all(rows[c]["customer_sk"] == old[c]["customer_sk"] for c in old)
    assert {c for c, r in rows.items() if r["updated_at"] != LATER} == {gone} and rows[gone]["updated_at"] == AS_OF
    assert {r["updated_at"] for r in st.read(spark, 1).dim_customer.collect()} == {AS_OF}
    # a row that left the source stays, and rewrites nothing in a further run
    st.run(op.with_(sale=sale.withColumn("updated_at", ntz(LATER + dt.timedelta(days=1)))), LATER + dt.timedelta(days=2))
    third = st.dims["dim_customer"].manifest(spark, 3)
    assert {b: e.dv for b, e in third.entries.items()} == {b: e.dv for b, e in m.entries.items()}
    again = {r["customer_id"]: r["updated_at"] for r in st.read(spark).dim_customer.collect()}
    assert again[gone] == AS_OF and set(again.values()) == {AS_OF, LATER + dt.timedelta(days=2)}


def test_buckets_are_bounded_whatever_the_rows(spark, scratch, sf001_op):
    """Beyond MAX_BUCKETS buckets hold more rows: folders and manifest rows do not grow with the table."""
    store = dimstore.DimensionStore(os.path.join(scratch, "bounded"), "dim_customer", bucket_rows=1)
    rows = spark.range(1000).select(F.col("id").alias("customer_id"), F.lit("C").alias("city"), F.lit("XX").alias("uf"), ntz(AS_OF).alias("updated_at"))
    assert len(store.upsert(rows, None, 1, AS_OF)) == dimstore.MAX_BUCKETS < 1000
    assert len(dim_files(store.root, "dim_customer")) == dimstore.MAX_BUCKETS
    first = {r["customer_id"]: r["customer_sk"] for r in store.read(spark, 1).collect()}
    assert sorted(first) == list(range(1000)) and sorted(first.values()) == list(range(1, 1001))
    moved = rows.withColumn("city", F.when(F.col("customer_id") == 7, "MOVED").otherwise(F.col("city")))
    assert len(store.upsert(moved, 1, 2, LATER)) == 1, "one row changes one bucket"
    assert {r["customer_id"]: r["customer_sk"] for r in store.read(spark, 2).collect()} == first
    assert [r["customer_id"] for r in store.read(spark, 2).where("city = 'MOVED'").collect()] == [7]
