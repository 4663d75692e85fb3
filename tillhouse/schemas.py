"""Table contracts: StructTypes, domains and fixed constants of the warehouse.

Types follow the operational / dimensional DDL: exact decimals for money,
``timestamp_ntz`` for timestamps without zone, small ints for date parts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference model for identical results)
# ---------------------------------------------------------------------------
# Sale status domain (reference: CONCLUIDA, CANCELADA, PENDENTE).
STATUS_COMPLETED = "COMPLETED"
STATUS_CANCELLED = "CANCELLED"
STATUS_PENDING = "PENDING"
STATUSES = (STATUS_COMPLETED, STATUS_CANCELLED, STATUS_PENDING)
# Sale channel domain (reference: LOJA, ONLINE, TELEVENDAS).
CHANNEL_STORE = "STORE"
CHANNEL_ONLINE = "ONLINE"
CHANNEL_PHONE = "PHONE"
CHANNELS = (CHANNEL_STORE, CHANNEL_ONLINE, CHANNEL_PHONE)
# ETL control: process name and the mark a new control row starts from.
PROCESS_NAME = "carga_dw_vendas"
DEFAULT_LAST_RUN = dt.datetime(2000, 1, 1, 0, 0, 0)
# Reports: default window of the daily report, in days before "today".
DEFAULT_REPORT_DAYS = 20
# Reports: number of categories kept in the monthly stacked report.
TOP_CATEGORIES = 6
# Reconciliation: rows listed by the missing / surplus item checks.
CHECK_LIST_LIMIT = 200

MONEY = T.DecimalType(12, 2)       # operational money columns
FACT_MONEY = T.DecimalType(14, 2)  # fact measures
SUM_MONEY = T.DecimalType(18, 2)   # aggregated money (contract type of sums)
NTZ = T.TimestampNTZType()


def _f(name, dtype, nullable=False):
    return T.StructField(name, dtype, nullable)


BRANCH = T.StructType([
    _f("branch_id", T.IntegerType()), _f("name", T.StringType()), _f("city", T.StringType()),
    _f("uf", T.StringType()), _f("active", T.BooleanType()),
    _f("created_at", NTZ), _f("updated_at", NTZ),
])

CUSTOMER = T.StructType([
    _f("customer_id", T.LongType()), _f("name", T.StringType()), _f("doc_hash", T.StringType(), True),
    _f("city", T.StringType(), True), _f("uf", T.StringType(), True),
    _f("created_at", NTZ), _f("updated_at", NTZ),
])

PRODUCT = T.StructType([
    _f("product_id", T.LongType()), _f("sku", T.StringType()), _f("name", T.StringType()),
    _f("category", T.StringType()), _f("list_price", MONEY), _f("active", T.BooleanType()),
    _f("created_at", NTZ), _f("updated_at", NTZ),
])

SALE = T.StructType([
    _f("sale_id", T.LongType()), _f("branch_id", T.IntegerType()), _f("customer_id", T.LongType(), True),
    _f("sold_at", NTZ), _f("status", T.StringType()), _f("channel", T.StringType()),
    _f("note", T.StringType(), True), _f("created_at", NTZ), _f("updated_at", NTZ),
])

SALE_ITEM = T.StructType([
    _f("item_id", T.LongType()), _f("sale_id", T.LongType()), _f("product_id", T.LongType()),
    _f("qty", T.IntegerType()), _f("unit_price", MONEY), _f("discount", MONEY),
    _f("created_at", NTZ), _f("updated_at", NTZ),
])

ETL_CONTROL = T.StructType([
    _f("process", T.StringType()), _f("last_run", NTZ), _f("updated_at", NTZ),
])

DIM_DATE = T.StructType([
    _f("date_sk", T.IntegerType()), _f("date", T.DateType()), _f("year", T.ShortType()),
    _f("month", T.ShortType()), _f("day", T.ShortType()), _f("quarter", T.ShortType()),
    _f("weekday", T.ShortType()), _f("month_name", T.StringType()),
])

DIM_BRANCH = T.StructType([
    _f("branch_sk", T.IntegerType()), _f("branch_id", T.IntegerType()), _f("name", T.StringType()),
    _f("city", T.StringType()), _f("uf", T.StringType()), _f("active", T.BooleanType()),
    _f("updated_at", NTZ),
])

DIM_PRODUCT = T.StructType([
    _f("product_sk", T.LongType()), _f("product_id", T.LongType()), _f("sku", T.StringType()),
    _f("name", T.StringType()), _f("category", T.StringType()), _f("active", T.BooleanType()),
    _f("updated_at", NTZ),
])

DIM_CUSTOMER = T.StructType([
    _f("customer_sk", T.LongType()), _f("customer_id", T.LongType()), _f("city", T.StringType(), True),
    _f("uf", T.StringType(), True), _f("updated_at", NTZ),
])

# ``sale_month`` (yyyymm of the sale date) is the storage partition column of
# the fact; it lets date-range reports prune whole partitions.
FACT_SALE_ITEM = T.StructType([
    _f("date_sk", T.IntegerType()), _f("branch_sk", T.IntegerType()), _f("product_sk", T.LongType()),
    _f("customer_sk", T.LongType(), True), _f("sale_id", T.LongType()), _f("item_id", T.LongType()),
    _f("qty", T.IntegerType()), _f("gross", FACT_MONEY), _f("discount", FACT_MONEY), _f("net", FACT_MONEY),
    _f("loaded_at", NTZ), _f("sale_month", T.IntegerType()),
])

OP_SCHEMAS = {
    "branch": BRANCH, "customer": CUSTOMER, "product": PRODUCT, "sale": SALE, "sale_item": SALE_ITEM,
}
DW_SCHEMAS = {
    "etl_control": ETL_CONTROL, "dim_date": DIM_DATE, "dim_branch": DIM_BRANCH,
    "dim_product": DIM_PRODUCT, "dim_customer": DIM_CUSTOMER, "fact_sale_item": FACT_SALE_ITEM,
}

# Natural key and surrogate key of each dimension.
DIM_KEYS = {
    "dim_date": ("date", "date_sk"),
    "dim_branch": ("branch_id", "branch_sk"),
    "dim_product": ("product_id", "product_sk"),
    "dim_customer": ("customer_id", "customer_sk"),
}
