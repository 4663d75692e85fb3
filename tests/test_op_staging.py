"""Staging of the operational tables: prices without a division, tables side by side, items unsorted in their buckets."""

import threading
from decimal import Decimal

from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.functions.money import scaled_price
from tillhouse.session import HASH_JOIN, OPEN_FILES
from tillhouse.sources import store


def test_prices_are_exact_and_not_divided(spark):
    cents = F.when(F.col("id") % 2 == 0, F.col("id") * 37).otherwise(-F.col("id") * 53).cast("decimal(20,0)")
    rows = (spark.range(20_000).select((cents * F.lit("0.01").cast("decimal(2,2)")).cast(S.MONEY).alias("p"), (F.col("id") % 13).alias("k"))
            .union(spark.range(7).select(F.lit("9000000000.99").cast(S.MONEY), F.col("id"))))
    percent = (F.lit(95) + F.col("k") % 7).cast("decimal(3,0)")
    priced = rows.select("p", "k", scaled_price(F.col("p"), F.col("k")).alias("got"))
    divided = F.round(F.col("p") * percent / F.lit(100).cast("decimal(3,0)"), 2).cast(S.MONEY)
    assert priced.schema["got"].dataType == S.MONEY and priced.where(~F.col("got").eqNullSafe(divided)).isEmpty()
    assert priced.where("p = 9000000000.99 and k = 6").first()["got"] == Decimal("9090000001.00")
    assert " / " not in priced._jdf.queryExecution().optimizedPlan().toString()


def test_tables_are_staged_side_by_side(spark, sf001_op, monkeypatch):
    meet, plain, seen = threading.Barrier(5), store.parquet_stage, []

    def stage(name, df):
        meet.wait(60)       # breaks unless all five are there at once
        return plain(name, df)

    def buckets(name, df, key, n):
        meet.wait(60)
        return bucketed(name, df, key, n)

    bucketed, old = store.bucketed_stage, store.unsorted_buckets
    monkeypatch.setattr(store, "parquet_stage", stage)
    monkeypatch.setattr(store, "bucketed_stage", buckets)
    monkeypatch.setattr(store, "unsorted_buckets", lambda s: (seen.append(1), old(s))[1])
    before = [spark.conf.get(k, None) for k in (HASH_JOIN, OPEN_FILES)]
    op = store.persist_op(sf001_op, 8)
    assert seen and before == [spark.conf.get(k, None) for k in (HASH_JOIN, OPEN_FILES)]
    for name in ("branch", "customer", "product", "sale", "sale_item"):
        got, want = getattr(op, name), getattr(sf001_op, name)
        assert got.schema == want.schema and got.exceptAll(want).count() == 0 == want.exceptAll(got).count()
