"""Streaming-driven incremental load equals the batch load."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.plans import validate
from tillhouse.sources import readers, seed
from tillhouse.sources.store import WarehouseStore
from tillhouse.streaming import changes

AS_OF = dt.datetime(2024, 3, 10, 12, 0)


def test_stream_of_changed_sales(spark, scratch):
    root = os.path.join(scratch, "stream")
    op = seed.seed(spark, AS_OF)
    # two export files of changed sales
    op.sale.filter(F.col("sale_id") <= 30).coalesce(1).write.parquet(f"{root}/changes/part1")
    op.sale.filter(F.col("sale_id") > 30).coalesce(1).write.parquet(f"{root}/changes/part2")
    store = WarehouseStore(f"{root}/dw")
    ticks = iter([dt.datetime(2024, 3, 11, h) for h in range(1, 10)])
    q = changes.start(spark, store, lambda: op, f"{root}/changes/*", f"{root}/ckpt", clock=lambda: next(ticks),
                      max_files_per_trigger=1)
    q.awaitTermination(120)
    dw = store.read(spark)
    assert len(store.versions(spark)) == 2
    assert dw.fact_sale_item.count() == 120
    ok, rows = validate.run_checks(op, dw)
    assert ok, rows
    # a replayed batch changes nothing
    changes.apply_batch(store, op, spark.read.parquet(f"{root}/changes/part1"), dt.datetime(2024, 3, 12))
    assert store.read(spark).fact_sale_item.count() == 120


@pytest.mark.parametrize("older_first", [True, False])
def test_a_sale_twice_in_one_batch(spark, scratch, older_first):
    """The newest version of a sale counts, wherever it stands in the batch."""
    op = seed.seed(spark, AS_OF)
    done = op.sale.filter(F.col("status") == S.STATUS_COMPLETED)
    old = done.withColumn("status", F.lit(S.STATUS_PENDING)).withColumn("updated_at", F.col("updated_at") - F.expr("INTERVAL 1 DAY"))
    pair = (old, done) if older_first else (done, old)
    batch = spark.createDataFrame([r for df in pair for r in df.collect()], op.sale.schema).coalesce(1)
    store = WarehouseStore(os.path.join(scratch, f"twice-{older_first}"))
    changes.apply_batch(store, op, batch, dt.datetime(2024, 3, 11))
    assert store.read(spark).fact_sale_item.count() == 120


def test_items_that_arrive_between_batches_and_the_batch_mark(spark, scratch):
    root = os.path.join(scratch, "late-items")
    op = seed.seed(spark, AS_OF)
    early = F.col("sale_id") <= 30
    readers.write_op(op.with_(sale_item=op.sale_item.filter(early)), f"{root}/op")
    op.sale.filter(early).coalesce(1).write.parquet(f"{root}/changes/part1")
    store = WarehouseStore(f"{root}/dw")
    ticks = iter([dt.datetime(2024, 3, 11, h) for h in range(1, 10)])

    def stream():
        q = changes.start(spark, store, lambda: readers.read_op_parquet(spark, f"{root}/op"), f"{root}/changes/*", f"{root}/ckpt",
                          clock=lambda: next(ticks))
        q.awaitTermination(120)

    stream()
    part = store.read(spark).fact_sale_item.count()
    assert 0 < part < 120
    # the stream leaves the batch job's mark alone: a batch run that follows loads everything
    batch = WarehouseStore(f"{root}/dw2")
    changes.apply_batch(batch, op, spark.read.parquet(f"{root}/changes/part1"), dt.datetime(2024, 3, 11))
    batch.run(op, dt.datetime(2024, 3, 12))
    assert batch.read(spark).fact_sale_item.count() == 120
    op.sale_item.filter(~early).write.mode("append").parquet(f"{root}/op/sale_item")
    op.sale.filter(~early).coalesce(1).write.parquet(f"{root}/changes/part2")
    stream()
    assert store.read(spark).fact_sale_item.count() == 120
