"""Operational tables derived from the driver's TPC-H-like parquet tables.

Mapping rules (fixed, shared with the DuckDB oracle in ``__spark_entry__``):

* branch    <- nation x region: id = n_nationkey, name = n_name, city = r_name, uf 'XX'
* customer  <- customer x nation: id = c_custkey, doc_hash = md5(key text), city = n_name
* product   <- part: sku 'SKU-<key>', category = p_type (or p_brand), list price = decimal(12,2)
* sale      <- orders x customer: branch = customer's nation; customer NULL when
  o_orderkey % 50 = 0; sold at orderdate + 10:00 + (o_orderkey % 9) * 45 min;
  status F/P/O -> COMPLETED/CANCELLED/PENDING; priority 1,2 -> ONLINE, 3 -> PHONE,
  else STORE; updated_at = orderdate
* sale_item <- lineitem x part x orders: n = position of the line in its order;
  item id = orderkey * 100 + n, k = orderkey + n; qty = int(l_quantity);
  unit price = round(list * (0.95 + 0.01 * (k % 7)), 2);
  discount 15 / 10 / 5 for k % 6 = 0 / 1 / 2 on COMPLETED sales, else 0.

The item id scheme allows at most 99 lines per order, which also bounds the
only per-key window (line position within an order).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.functions.dates import ntz
from tillhouse.functions.money import scaled_price, seed_discount
from tillhouse.model import OpTables, conform

# Fixed values of the mapping.
BRANCH_UF = "XX"
BRANCH_CREATED = dt.datetime(1990, 1, 1)
NULL_CUSTOMER_EVERY = 50          # o_orderkey % 50 = 0 -> sale without customer
ORDER_STATUS = {"F": S.STATUS_COMPLETED, "P": S.STATUS_CANCELLED, "O": S.STATUS_PENDING}
LINES_PER_ORDER = 100             # item id = orderkey * 100 + line position
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
              "l_extendedprice", "l_quantity", "l_discount", "l_tax"]

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def branches(nation: DataFrame, region: DataFrame) -> DataFrame:
    df = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("branch_id"),
        F.col("n_name").alias("name"),
        F.col("r_name").alias("city"),
        F.lit(BRANCH_UF).alias("uf"),
        F.lit(True).alias("active"),
        ntz(BRANCH_CREATED).alias("created_at"),
        ntz(BRANCH_CREATED).alias("updated_at"),
    )
    return conform(df, S.BRANCH)


def customers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    df = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("name"),
        F.md5(F.col("c_custkey").cast("string")).alias("doc_hash"),
        F.col("n_name").alias("city"),
        F.lit(BRANCH_UF).alias("uf"),
        ntz(BRANCH_CREATED).alias("created_at"),
        ntz(BRANCH_CREATED).alias("updated_at"),
    )
    return conform(df, S.CUSTOMER)


def products(part: DataFrame, category_col: str = "p_type") -> DataFrame:
    df = part.select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("name"),
        F.col(category_col).alias("category"),
        F.col("p_retailprice").cast(S.MONEY).alias("list_price"),
        F.lit(True).alias("active"),
        ntz(BRANCH_CREATED).alias("created_at"),
        ntz(BRANCH_CREATED).alias("updated_at"),
    )
    return conform(df, S.PRODUCT)


def _status(col):
    expr = None
    for code, status in ORDER_STATUS.items():
        expr = (F.when(col == code, status) if expr is None else expr.when(col == code, status))
    return expr


def _channel(priority):
    head = F.substring(priority, 1, 1)
    return (F.when(head.isin("1", "2"), S.CHANNEL_ONLINE)
            .when(head == "3", S.CHANNEL_PHONE)
            .otherwise(S.CHANNEL_STORE))


def sales(orders: DataFrame, customer: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    df = orders.join(customer.select("c_custkey", "c_nationkey"), orders.o_custkey == customer.c_custkey).select(
        key.alias("sale_id"),
        F.col("c_nationkey").alias("branch_id"),
        F.when(key % NULL_CUSTOMER_EVERY == 0, F.lit(None)).otherwise(F.col("o_custkey")).alias("customer_id"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), F.lit(10), (key % 9 * 45).cast("int"), F.lit(0)))
        .alias("sold_at"),
        _status(F.col("o_orderstatus")).alias("status"),
        _channel(F.col("o_orderpriority")).alias("channel"),
        F.lit(None).cast("string").alias("note"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
    )
    return conform(df, S.SALE)


def sale_items(lineitem: DataFrame, part: DataFrame, orders: DataFrame, buckets: int | None = None) -> DataFrame:
    """Items; with ``buckets``, dealt out in so many partitions by order, where they stay."""
    # The price comes before the lines are dealt out by order, so that the rows
    # end where their order is; lines of unknown parts count for the positions.
    prices = part.select("p_partkey", F.col("p_retailprice").cast(S.MONEY).alias("list_price"), F.lit(True).alias("priced"))
    lineitem = lineitem.join(prices, lineitem.l_partkey == prices.p_partkey, "left")
    if buckets is not None:
        lineitem = lineitem.repartition(buckets, "l_orderkey")
    # Line position inside its order: a window per order key, bounded by the
    # id scheme (< 100 lines per order).
    w = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    n = F.row_number().over(w)
    too_many = F.raise_error(F.concat(F.lit("the item id scheme has no room for the lines of order "), F.col("l_orderkey")))
    lines = lineitem.withColumn("n", n).withColumn("n", F.when(F.col("n") < LINES_PER_ORDER, F.col("n")).otherwise(too_many.cast("int")))
    k = F.col("l_orderkey") + F.col("n")
    status = _status(F.col("o_orderstatus"))
    df = (
        lines.join(orders.select("o_orderkey", "o_orderstatus", "o_orderdate"),
                   lines.l_orderkey == orders.o_orderkey)
        .where("priced")
        .select(
            (F.col("l_orderkey") * LINES_PER_ORDER + F.col("n")).alias("item_id"),
            F.col("l_orderkey").alias("sale_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_quantity").cast("int").alias("qty"),
            scaled_price(F.col("list_price"), k).alias("unit_price"),
            seed_discount(status == S.STATUS_COMPLETED, k).alias("discount"),
            F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )
    )
    return conform(df, S.SALE_ITEM)


def op_tables(spark: SparkSession, sf_dir: str, category_col: str = "p_type", item_buckets: int | None = None) -> OpTables:
    """All five operational tables, lazily derived from the driver tables; items in ``item_buckets`` partitions by sale."""
    t = {name: read_table(spark, sf_dir, name) for name in TABLES}
    return OpTables(
        branch=branches(t["nation"], t["region"]),
        customer=customers(t["customer"], t["nation"]),
        product=products(t["part"], category_col),
        sale=sales(t["orders"], t["customer"]),
        sale_item=sale_items(t["lineitem"], t["part"], t["orders"], item_buckets),
    )
