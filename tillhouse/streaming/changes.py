"""The incremental load driven by a stream of changed sales.

Changed sale rows land as parquet files in a folder (a CDC export, say).  A
Structured Streaming query reads the folder; each micro-batch is applied with
the same warehouse load as a batch run (``WarehouseStore.run``) through
``foreachBatch``:

* the batch's sales are the changed set, each in its newest version, so the
  stream's offsets (kept in the query checkpoint) take the place of the
  high-water mark, which stays where the batch job left it;
* the operational tables are read anew for each batch (a file source lists its
  files once), and the sales' items come from the item table (semi join);
* dimensions are upserted from the operational tables as in a batch run.

A retried micro-batch repeats a keyed upsert, so reprocessing after a failure
is harmless.  ``availableNow`` drains the folder and stops (scheduled runs);
a processing-time trigger keeps it running.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillhouse import schemas as S
from tillhouse.model import OpTables
from tillhouse.sources.store import WarehouseStore

EPOCH = dt.datetime(1900, 1, 1)


def changed_sales(spark: SparkSession, folder: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(S.SALE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(folder)


def newest(batch: DataFrame) -> DataFrame:
    """One row per sale: the one updated last (of equal times, the greatest row)."""
    others = [c for c in batch.columns if c not in ("sale_id", "updated_at")]
    row = F.struct("updated_at", *others)
    return batch.groupBy("sale_id").agg(F.max(row).alias("r")).select("sale_id", "r.*").select(batch.columns)


def apply_batch(store: WarehouseStore, op: OpTables, batch: DataFrame, as_of: dt.datetime):
    """Load one micro-batch of changed sales into the store."""
    sales = newest(batch)
    items = op.sale_item.join(sales.select("sale_id"), "sale_id", "left_semi")
    return store.run(op.with_(sale=sales, sale_item=items), as_of, since=EPOCH)


def start(spark: SparkSession, store: WarehouseStore, read_op: Callable[[], OpTables], folder: str, checkpoint: str,
          clock: Callable[[], dt.datetime] | None = None, available_now: bool = True,
          max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the streaming load; returns the running query. ``read_op`` reads the operational tables as they are then."""
    now = clock or (lambda: dt.datetime.now().replace(microsecond=0))

    def each(batch: DataFrame, epoch_id: int) -> None:
        if batch.limit(1).count():
            apply_batch(store, read_op(), batch, now())

    writer = (changed_sales(spark, folder, max_files_per_trigger).writeStream
              .foreachBatch(each).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
