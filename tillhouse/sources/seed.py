"""Deterministic demo dataset for the operational model, as a Spark job.

Generates branches, products, customers, sales and sale items with the
cyclic rules of the model's seed script.  Sizes come from id series, so the
same job makes 60 sales or 600 million:

* branches / products: literal rows (fixed values below), ids 1..5 / 1..12
* customer ``g``: name ``Cliente g``, ``md5('cpf_fake_' || g)``, city ``CITIES[g % 5]``
* sale ``g``: branch at position ``g % 5`` and customer at position
  ``g % 20`` (ordered by id), sold ``as_of - g % 20`` days at
  10:00 + (g % 9) * 45 min, status / channel by ``g % 10``
* items ``i = 1 .. 1 + g % 4`` of sale ``g`` with ``k = g + i``: product at
  position ``k % 12``, qty ``1 + k % 3``, unit price
  ``round(list * (0.95 + 0.01 * (k % 7)), 2)``, discount 15 / 10 / 5 for
  ``k % 6 = 0 / 1 / 2`` on COMPLETED sales

Position lookups ("the row at position p ordered by id") join on ``pos`` to
the first ``cycle`` rows of the lookup table, taken with a distributed
top-k, so they stay bounded by the cycle length whatever the table size.
Item ids follow insertion order (sale by sale, item by item) through a
closed form over consecutive sale ids, without a global window.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.functions.dates import ntz
from tillhouse.functions.money import scaled_price, seed_discount
from tillhouse.model import OpTables, conform, literal_rows

# ---------------------------------------------------------------------------
# Fixed values of the seed dataset (must equal the model's seed for identical results)
# ---------------------------------------------------------------------------
SEED_BRANCHES = [
    ("Filial Centro", "São Paulo", "SP"),
    ("Filial Zona Sul", "São Paulo", "SP"),
    ("Filial Campinas", "Campinas", "SP"),
    ("Filial Santos", "Santos", "SP"),
    ("Filial São José", "São José dos Campos", "SP"),
]
SEED_PRODUCTS = [
    ("SKU-001", "Camiseta Básica", "Vestuário", "59.90"),
    ("SKU-002", "Calça Jeans", "Vestuário", "159.90"),
    ("SKU-003", "Tênis Casual", "Calçados", "229.90"),
    ("SKU-004", "Meia Esportiva", "Acessórios", "19.90"),
    ("SKU-005", "Boné", "Acessórios", "49.90"),
    ("SKU-006", "Jaqueta Corta-Vento", "Vestuário", "299.90"),
    ("SKU-007", "Mochila", "Acessórios", "189.90"),
    ("SKU-008", "Relógio Digital", "Eletrônicos", "199.90"),
    ("SKU-009", "Fone Bluetooth", "Eletrônicos", "149.90"),
    ("SKU-010", "Garrafa Térmica", "Utilidades", "79.90"),
    ("SKU-011", "Óculos de Sol", "Acessórios", "129.90"),
    ("SKU-012", "Tênis Corrida", "Calçados", "349.90"),
]
SEED_CITIES = ["São Paulo", "Campinas", "Santos", "São José dos Campos", "Sorocaba"]
SEED_UF = "SP"
CUSTOMER_NAME_PREFIX = "Cliente "
DOC_HASH_PREFIX = "cpf_fake_"
SEED_N_CUSTOMERS = 20
SEED_N_SALES = 60
BRANCH_CYCLE = 5        # sale g -> branch at position g % 5
CUSTOMER_CYCLE = 20     # sale g -> customer at position g % 20
DAY_CYCLE = 20          # sale g -> sold g % 20 days before as_of
SLOT_CYCLE = 9          # sale g -> 10:00 + (g % 9) * 45 minutes
OPEN_HOUR = 10
SLOT_MINUTES = 45
ITEM_CYCLE = 4          # sale g -> 1 + g % 4 items
PRODUCT_CYCLE = 12      # item k -> product at position k % 12
QTY_CYCLE = 3           # item k -> qty 1 + k % 3
# status and channel by g % 10
STATUS_BY_REMAINDER = {0: S.STATUS_CANCELLED, 1: S.STATUS_PENDING}
CHANNEL_BY_REMAINDER = {0: S.CHANNEL_ONLINE, 1: S.CHANNEL_ONLINE, 2: S.CHANNEL_PHONE}


def series(spark: SparkSession, n: int) -> DataFrame:
    """Column ``gs`` = 1..n."""
    return spark.range(1, n + 1).select(F.col("id").alias("gs"))


def _stamp(as_of: dt.datetime):
    return ntz(as_of)


def branches(spark: SparkSession, as_of: dt.datetime) -> DataFrame:
    rows = [(i + 1, name, city, uf, True, as_of, as_of) for i, (name, city, uf) in enumerate(SEED_BRANCHES)]
    return literal_rows(spark, rows, S.BRANCH)


def products(spark: SparkSession, as_of: dt.datetime) -> DataFrame:
    rows = [(i + 1, sku, name, cat, Decimal(price), True, as_of, as_of)
            for i, (sku, name, cat, price) in enumerate(SEED_PRODUCTS)]
    return literal_rows(spark, rows, S.PRODUCT)


def customers(ids: DataFrame, as_of: dt.datetime) -> DataFrame:
    g = F.col("gs")
    cities = F.array(*[F.lit(c) for c in SEED_CITIES])
    return conform(ids.select(
        g.alias("customer_id"),
        F.concat(F.lit(CUSTOMER_NAME_PREFIX), g.cast("string")).alias("name"),
        F.md5(F.concat(F.lit(DOC_HASH_PREFIX), g.cast("string"))).alias("doc_hash"),
        F.element_at(cities, (g % len(SEED_CITIES) + 1).cast("int")).alias("city"),
        F.lit(SEED_UF).alias("uf"),
        _stamp(as_of).alias("created_at"), _stamp(as_of).alias("updated_at"),
    ), S.CUSTOMER)


def positions(table: DataFrame, order_col: str, cycle: int, *cols: str) -> DataFrame:
    """``(pos, cols...)`` for the first ``cycle`` rows of ``table`` by ``order_col``.

    A distributed top-k (``orderBy().limit()``) keeps at most ``cycle`` rows;
    the window then numbers those few rows only.
    """
    top = table.select(order_col, *cols).orderBy(order_col).limit(cycle)
    return top.select((F.row_number().over(Window.orderBy(order_col)) - 1).alias("pos"), *cols)


def _by_remainder(rem, mapping: dict, default: str):
    expr = None
    for r, value in mapping.items():
        expr = F.when(rem == r, value) if expr is None else expr.when(rem == r, value)
    return expr.otherwise(default)


def sales(ids: DataFrame, branch: DataFrame, customer: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Sale ``gs`` for each id; ``as_of`` plays the seed's NOW()."""
    g = F.col("gs")
    b = F.broadcast(positions(branch, "branch_id", BRANCH_CYCLE, "branch_id").withColumnRenamed("pos", "bpos"))
    c = F.broadcast(positions(customer, "customer_id", CUSTOMER_CYCLE, "customer_id")
                    .withColumnRenamed("pos", "cpos"))
    day = F.date_sub(F.lit(as_of.date()), (g % DAY_CYCLE).cast("int"))
    sold_at = (day.cast(S.NTZ)
               + F.make_dt_interval(F.lit(0), F.lit(OPEN_HOUR), ((g % SLOT_CYCLE) * SLOT_MINUTES).cast("int"),
                                    F.lit(0)))
    rem = g % 10
    df = (ids.withColumn("bpos", g % BRANCH_CYCLE).withColumn("cpos", g % CUSTOMER_CYCLE)
          .join(b, "bpos", "left").join(c, "cpos", "left"))
    return conform(df.select(
        g.alias("sale_id"), "branch_id", "customer_id", sold_at.alias("sold_at"),
        _by_remainder(rem, STATUS_BY_REMAINDER, S.STATUS_COMPLETED).alias("status"),
        _by_remainder(rem, CHANNEL_BY_REMAINDER, S.CHANNEL_STORE).alias("channel"),
        F.lit(None).cast("string").alias("note"),
        _stamp(as_of).alias("created_at"), _stamp(as_of).alias("updated_at"),
    ), S.SALE)


def items_before(sale_col: str = "sale_id"):
    """Items of sales 1 .. g-1 (sale j has 1 + j % 4 items), closed form.

    With m = g - 1 and r = m % 4: m + (m div 4) * (0+1+2+3) + r (r + 1) / 2.
    """
    m = f"({sale_col} - 1)"
    r = f"({m} % {ITEM_CYCLE})"
    cycle_sum = ITEM_CYCLE * (ITEM_CYCLE - 1) // 2
    return F.expr(f"{m} + ({m} div {ITEM_CYCLE}) * {cycle_sum} + ({r} * ({r} + 1)) div 2")


def sale_items(sale: DataFrame, product: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Items of consecutive sales 1..n; product/price via position lookup."""
    p = F.broadcast(positions(product, "product_id", PRODUCT_CYCLE, "product_id", "list_price"))
    g = F.col("sale_id")
    per_sale = sale.select("sale_id", "status",
                           F.explode(F.sequence(F.lit(1).cast("long"), 1 + g % ITEM_CYCLE)).alias("i"))
    k = F.col("sale_id") + F.col("i")
    df = per_sale.withColumn("pos", k % PRODUCT_CYCLE).join(p, "pos", "left")
    return conform(df.select(
        (items_before("sale_id") + F.col("i")).cast("long").alias("item_id"),
        "sale_id", "product_id",
        (1 + k % QTY_CYCLE).cast("int").alias("qty"),
        scaled_price(F.col("list_price"), k).alias("unit_price"),
        seed_discount(F.col("status") == S.STATUS_COMPLETED, k).alias("discount"),
        _stamp(as_of).alias("created_at"), _stamp(as_of).alias("updated_at"),
    ), S.SALE_ITEM)


def seed(spark: SparkSession, as_of: dt.datetime, n_customers: int = SEED_N_CUSTOMERS,
         n_sales: int = SEED_N_SALES, customer_ids: DataFrame | None = None,
         sale_ids: DataFrame | None = None) -> OpTables:
    """The five operational tables of the seed.

    ``customer_ids`` / ``sale_ids`` (column ``gs`` = 1..n) override the sizes.
    """
    branch = branches(spark, as_of)
    product = products(spark, as_of)
    customer = customers(customer_ids if customer_ids is not None else series(spark, n_customers), as_of)
    sale = sales(sale_ids if sale_ids is not None else series(spark, n_sales), branch, customer, as_of)
    return OpTables(branch=branch, customer=customer, product=product, sale=sale,
                    sale_item=sale_items(sale, product, as_of))
