"""Operational extract laid out for the incremental load.

* ``sale`` is partitioned by change month (``changed``, yyyymm of
  ``updated_at``).  A load's mark becomes a partition filter, so sales that
  have not changed since are not read, and the changed range (MIN and MAX of
  the sale time) reads one column of the changed partitions only.
* ``sale_item`` lies in hash buckets of ``sale_id``, sorted.  A load brings
  its few changed sales into the same buckets and joins item rows where they
  lie: the item side of the join needs no exchange.

The bucketed table needs a catalog entry to be read as one.  ``Extract.read``
makes an external one over the written files under a name of its own, which
``close`` (or leaving the ``with`` block) drops; the files stay.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse import schemas as S
from tillhouse.functions.dates import ntz, year_month
from tillhouse.model import OpTables, conform

CHANGED = "changed"
ITEM_BUCKETS = 64


def changed_since(mark: dt.datetime) -> Column:
    """The mark as a partition filter and as the exact row filter."""
    return (F.col(CHANGED) >= mark.year * 100 + mark.month) & (F.col("updated_at") >= ntz(mark))


def write_extract(op: OpTables, root: str, item_buckets: int | None = None) -> None:
    """Write the five tables under ``root``; earlier contents are replaced.

    Fewer buckets than the reading session's shuffle partitions would be
    dealt out anew for a join, so by default there are at least as many.
    """
    spark, root = op.sale.sparkSession, root.rstrip("/")
    item_buckets = item_buckets or max(ITEM_BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    for name in ("branch", "customer", "product"):
        getattr(op, name).write.mode("overwrite").parquet(f"{root}/{name}")
    (op.sale.withColumn(CHANGED, year_month(F.col("updated_at"))).hint("rebalance", CHANGED)
     .write.mode("overwrite").partitionBy(CHANGED).parquet(f"{root}/sale"))
    table = f"extract_{uuid.uuid4().hex}"
    try:
        (op.sale_item.repartition(item_buckets, "sale_id").write.mode("overwrite")
         .bucketBy(item_buckets, "sale_id").sortBy("sale_id").option("path", f"{root}/sale_item")
         .saveAsTable(table, format="parquet"))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")      # an external table: its files stay
    spark.createDataFrame([(json.dumps({"item_buckets": item_buckets}),)], "layout string").coalesce(1).write.mode(
        "overwrite").text(f"{root}/_layout")


class Extract:
    """A written extract, open for reading."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.tables: list[str] = []

    def __enter__(self) -> "Extract":
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        for table in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables = []

    def _items(self) -> DataFrame:
        layout = json.loads(self.spark.read.text(f"{self.root}/_layout").first()[0])
        table = f"extract_{uuid.uuid4().hex}"
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in S.SALE_ITEM.fields)
        self.spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY (sale_id) SORTED BY (sale_id) "
                       f"INTO {layout['item_buckets']} BUCKETS LOCATION '{self.root}/sale_item'")
        self.tables.append(table)
        return self.spark.table(table)

    def sale(self) -> DataFrame:
        """Sales with their change month."""
        schema = T.StructType(S.SALE.fields + [T.StructField(CHANGED, T.IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.root}/sale")

    def read(self, since: dt.datetime | None = None) -> OpTables:
        """The tables; with ``since``, only sales changed at or after it (what a load from that mark reads)."""
        sale = self.sale() if since is None else self.sale().where(changed_since(since))
        plain = {n: self.spark.read.schema(S.OP_SCHEMAS[n]).parquet(f"{self.root}/{n}") for n in ("branch", "customer", "product")}
        return OpTables(**plain, sale=conform(sale, S.SALE), sale_item=self._items())
