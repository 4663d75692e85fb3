"""Warehouse load on the driver tables (expected totals: FIXTURES.md §3)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillhouse.functions.dates import ntz  # noqa: E402
from tillhouse import schemas as S
from tillhouse.model import DwTables
from tillhouse.operators.keys import assign_surrogate_keys
from tillhouse.plans import etl
from tillhouse.sources import store

MARK = dt.datetime(1998, 1, 1)
AS_OF = dt.datetime(2002, 1, 1)


def test_source_mapping(sf001_op):
    assert dict(sf001_op.sale.groupBy("status").count().collect()) == {
        "COMPLETED": 493, "PENDING": 514, "CANCELLED": 493}
    assert dict(sf001_op.sale.groupBy("channel").count().collect()) == {"STORE": 591, "ONLINE": 589, "PHONE": 320}


def test_first_load_totals(sf001_dw):
    f = sf001_dw.fact_sale_item.agg(
        F.count(F.lit(1)), F.countDistinct("sale_id"), F.sum("gross"), F.sum("discount"), F.sum("net"),
        F.sum("qty"), F.count_if(F.col("customer_sk").isNull())).first()
    assert tuple(f) == (1995, 484, Decimal("45422119.66"), Decimal("10030.00"), Decimal("45412089.66"), 50945, 37)
    assert sf001_dw.dim_date.count() == 2405
    assert sf001_dw.fact_sale_item.select("date_sk").distinct().count() == 440
    ctl = sf001_dw.etl_control.collect()
    assert [(r["process"], r["last_run"]) for r in ctl] == [(S.PROCESS_NAME, AS_OF)]


def test_surrogate_keys_dense_unique(sf001_dw):
    for table, (nk, sk) in S.DIM_KEYS.items():
        df = getattr(sf001_dw, table)
        r = df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(sk).alias("k"), F.min(sk).alias("lo"),
                   F.max(sk).alias("hi"), F.countDistinct(nk).alias("nk")).first()
        assert r["n"] == r["k"] == r["hi"] == r["nk"] and r["lo"] == 1, table


def test_assign_keys_deterministic_and_offset(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 100003).alias("k"))
    a = assign_surrogate_keys(df, ["k"], "sk", 100, buckets=7)
    b = assign_surrogate_keys(df.repartition(13), ["k"], "sk", 100, buckets=7)
    ra = {r["k"]: r["sk"] for r in a.collect()}
    rb = {r["k"]: r["sk"] for r in b.collect()}
    assert ra == rb
    assert sorted(ra.values()) == list(range(101, 5101))


def test_rerun_is_idempotent(sf001_op, sf001_dw):
    """Same mark again: the upsert replaces the same rows, keys stay."""
    again = etl.run_etl(sf001_op, sf001_dw.with_(etl_control=sf001_dw.etl_control.limit(0)), AS_OF,
                        initial_mark=dt.datetime(1990, 1, 1), stage=store.parquet_stage).dw
    cols = ["item_id", "date_sk", "branch_sk", "product_sk", "customer_sk", "qty", "gross", "discount", "net"]
    assert again.fact_sale_item.select(cols).exceptAll(sf001_dw.fact_sale_item.select(cols)).count() == 0
    assert again.fact_sale_item.count() == sf001_dw.fact_sale_item.count()
    assert again.dim_product.exceptAll(sf001_dw.dim_product).count() == 0


def test_nothing_changed_keeps_warehouse(sf001_op, sf001_dw):
    run = etl.run_etl(sf001_op, sf001_dw, AS_OF + dt.timedelta(days=1))
    assert not run.loaded and run.last_run == AS_OF
    assert run.dw.fact_sale_item is sf001_dw.fact_sale_item


def test_incremental_two_runs(spark, sf001_op):
    op = sf001_op
    sale1 = op.sale.filter(F.col("updated_at") < ntz(MARK))
    op1 = op.with_(sale=sale1, sale_item=op.sale_item.join(sale1.select("sale_id"), "sale_id", "left_semi"))
    dw1 = etl.first_load(op1, MARK, initial_mark=dt.datetime(1990, 1, 1), stage=store.parquet_stage).dw
    assert dw1.fact_sale_item.count() == 891
    flip = (F.col("sale_id") % 17 == 0) & (F.col("status") == S.STATUS_COMPLETED)
    sale2 = (op.sale.withColumn("updated_at", F.when(flip, F.greatest("updated_at", ntz(MARK)))
                                .otherwise(F.col("updated_at")))
             .withColumn("status", F.when(flip, F.lit(S.STATUS_CANCELLED)).otherwise(F.col("status"))))
    op2 = op.with_(sale=sale2)
    run2 = etl.run_etl(op2, dw1, AS_OF, stage=store.parquet_stage)
    assert run2.last_run == MARK and run2.loaded
    f2 = run2.dw.fact_sale_item
    assert f2.count() == 1910
    stale = f2.join(sale2.filter(F.col("status") != S.STATUS_COMPLETED), "sale_id", "left_semi").count()
    assert stale == 43
    # keys of dimension rows loaded by run 1 do not move
    p1 = dw1.dim_product.select("product_id", F.col("product_sk").alias("a"))
    assert run2.dw.dim_product.join(p1, "product_id").filter(F.col("a") != F.col("product_sk")).count() == 0


def test_empty_source(spark):
    from tillhouse.model import OpTables, empty

    op = OpTables(**{n: empty(spark, s) for n, s in S.OP_SCHEMAS.items()})
    run = etl.first_load(op, AS_OF)
    assert not run.loaded
    assert run.dw.fact_sale_item.count() == 0
    assert [r["last_run"] for r in run.dw.etl_control.collect()] == [S.DEFAULT_LAST_RUN]
    assert isinstance(run.dw, DwTables)
