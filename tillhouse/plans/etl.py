"""Incremental, idempotent load from the operational tables into the star schema.

Steps (one run):

1. ensure the control row of the process exists (insert if absent);
2. read its high-water mark (exactly one row);
3. changed range: MIN/MAX sale time over sales updated at or after the mark,
   any status; stop when there is none;
4. date dimension: dense days of the changed range, insert if absent;
5. type-1 upserts of the branch, product and customer dimensions;
6. fact: COMPLETED sales updated since the mark joined to their items and to
   the dimensions, replaced by item id (re-runs are harmless);
7. advance the mark to the run timestamp.

Every step is a DataFrame function; ``run_etl`` returns the new table
contents lazily.  ``tillhouse.sources.store`` persists and publishes them.

Kept on purpose (the reconciliation suite reports them): items whose sale
date / branch / product has no dimension row are dropped by inner joins; a
sale that leaves COMPLETED keeps its fact rows; changes only to items are not
picked up, the mark lives on the sale.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillhouse import schemas as S
from tillhouse.functions.dates import calendar_columns, date_series, ntz, year_month
from tillhouse.functions.money import line_gross, line_net
from tillhouse.model import DwTables, OpTables, conform, literal_rows
from tillhouse.operators.joins import calendar
from tillhouse.operators.upsert import insert_if_absent, upsert_by_key, upsert_scd1


# Number of distinct join keys the NULL-customer sales are spread over.
NULL_CUSTOMER_SALT = 1024


@dataclass(frozen=True)
class EtlRun:
    dw: DwTables
    last_run: dt.datetime
    changed: tuple[dt.datetime, dt.datetime] | None
    as_of: dt.datetime
    lookups: dict[str, int] | None = None       # what the fact load's lookups read and lost, where a store counts it

    @property
    def loaded(self) -> bool:
        return self.changed is not None


# --- control (D1, D2, D9) ---------------------------------------------------

def ensure_control(control: DataFrame, process: str = S.PROCESS_NAME,
                   initial_mark: dt.datetime = S.DEFAULT_LAST_RUN,
                   as_of: dt.datetime | None = None) -> DataFrame:
    spark = control.sparkSession
    stamp = as_of or initial_mark
    row = literal_rows(spark, [(process, initial_mark, stamp)], S.ETL_CONTROL)
    return insert_if_absent(control, row, "process", schema=S.ETL_CONTROL)


def read_last_run(control: DataFrame, process: str = S.PROCESS_NAME) -> dt.datetime:
    rows = control.filter(F.col("process") == process).select("last_run").limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected exactly one control row for {process!r}, found {len(rows)}")
    return rows[0]["last_run"]


def advance_mark(control: DataFrame, as_of: dt.datetime, process: str = S.PROCESS_NAME) -> DataFrame:
    hit = F.col("process") == process
    return conform(control.select(
        "process",
        F.when(hit, ntz(as_of)).otherwise(F.col("last_run")).alias("last_run"),
        F.when(hit, ntz(as_of)).otherwise(F.col("updated_at")).alias("updated_at"),
    ), S.ETL_CONTROL)


# --- changed range (D3) -----------------------------------------------------

def changed_range_frame(sale: DataFrame, last_run: dt.datetime) -> DataFrame:
    return (sale.filter(F.col("updated_at") >= ntz(last_run))
            .agg(F.min("sold_at").alias("min_sold_at"), F.max("sold_at").alias("max_sold_at")))


def changed_range(sale: DataFrame, last_run: dt.datetime):
    row = changed_range_frame(sale, last_run).first()
    if row is None or row["min_sold_at"] is None or row["max_sold_at"] is None:
        return None
    return row["min_sold_at"], row["max_sold_at"]


# --- date dimension (D4) ----------------------------------------------------

def date_rows(spark: SparkSession, first: dt.date, last: dt.date) -> DataFrame:
    """Dense calendar rows first..last (inclusive), without surrogate key.

    The row count is the number of days in the range, independent of data size.
    """
    d = F.col("date")
    return (spark.range(1)
            .select(F.explode(date_series(F.lit(first), F.lit(last))).alias("date"))
            .select(d, *calendar_columns(d)))


def upsert_dim_date(dim_date: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    src = date_rows(dim_date.sparkSession, first, last)
    return insert_if_absent(dim_date, src, "date", sk="date_sk", sk_type="int", schema=S.DIM_DATE)


# --- type-1 dimensions (D5-D7) ----------------------------------------------

def branch_source(branch: DataFrame, as_of: dt.datetime) -> DataFrame:
    return branch.select("branch_id", "name", "city", "uf", "active", ntz(as_of).alias("updated_at"))


def product_source(product: DataFrame, as_of: dt.datetime) -> DataFrame:
    return product.select("product_id", "sku", "name", "category", "active", ntz(as_of).alias("updated_at"))


def customer_source(customer: DataFrame, as_of: dt.datetime) -> DataFrame:
    return customer.select("customer_id", "city", "uf", ntz(as_of).alias("updated_at"))


def dimension_sources(op: OpTables, as_of: dt.datetime) -> dict[str, DataFrame]:
    """The source rows of each type-1 dimension."""
    return {"dim_branch": branch_source(op.branch, as_of), "dim_product": product_source(op.product, as_of),
            "dim_customer": customer_source(op.customer, as_of)}


def upsert_dimension(dw: DwTables, name: str, source: DataFrame) -> DataFrame:
    key, sk = S.DIM_KEYS[name]
    schema = S.DW_SCHEMAS[name]
    return upsert_scd1(getattr(dw, name), source, key, sk, schema[sk].dataType.simpleString(), schema)


# --- fact (D8, D14) ---------------------------------------------------------

def customer_key() -> Column:
    """The customer id, or one of NULL_CUSTOMER_SALT numbers; the salt is in the key itself, where no rewrite removes it."""
    return F.coalesce("customer_id", -1 - F.pmod(F.xxhash64("sale_id"), F.lit(NULL_CUSTOMER_SALT)))


class LookupCounts:
    """What each lookup of a fact load read and lost, counted by the load's own pass (no extra job).

    A counter is an observation in the load's plan; ``get`` waits for the
    action that runs it.  Where Spark evaluates an observed part more than
    once, the first run counts.
    """

    COUNTERS = ("sales_read", "sales_without_date", "sales_without_branch", "sales_without_customer", "items_read",
                "items_without_product", "rows_loaded")

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.seen = {name: Observation(f"lookup-{name}-{uuid.uuid4().hex}") for name in ("sales", "items")}

    def of_sales(self, df: DataFrame) -> DataFrame:
        date, branch = F.col("date_sk").isNull(), F.col("branch_sk").isNull()
        kept = ~date & ~branch
        return df.observe(self.seen["sales"], F.count(F.lit(1)).alias("sales_read"), F.count_if(date).alias("sales_without_date"),
                          F.count_if(~date & branch).alias("sales_without_branch"),
                          F.count_if(kept & F.col("customer_sk").isNull()).alias("sales_without_customer"))

    def of_items(self, df: DataFrame) -> DataFrame:
        lost = F.col("product_sk").isNull()
        return df.observe(self.seen["items"], F.count(F.lit(1)).alias("items_read"), F.count_if(lost).alias("items_without_product"),
                          F.count_if(~lost).alias("rows_loaded"))

    def get(self) -> dict[str, int]:
        found = {**self.seen["sales"].get, **self.seen["items"].get}
        return {name: int(found[name]) for name in self.COUNTERS}


def fact_source(op: OpTables, dw: DwTables, last_run: dt.datetime, as_of: dt.datetime,
                status: str = S.STATUS_COMPLETED, counts: LookupCounts | None = None) -> DataFrame:
    """Fact rows of sales in ``status`` (COMPLETED) updated since ``last_run``.

    Join order keeps the wide shuffles small: sale-level lookups (date,
    branch, customer) come before the item join on sale id; the product lookup
    is last.  Which of them are broadcast follows from the tables' bytes.
    Sales without customer are dealt out by ``customer_key`` and match nothing:
    a large NULL group spreads over ``NULL_CUSTOMER_SALT`` shuffle keys instead
    of landing in one partition, and the sales are scanned once.

    With ``counts`` the lookups are outer joins whose misses are counted and
    then dropped, so the rows are the same.
    """
    how = "inner" if counts is None else "left"
    sales = op.sale.filter((F.col("status") == status) & (F.col("updated_at") >= ntz(last_run)))
    sales = sales.select("sale_id", "branch_id", "customer_id", F.to_date("sold_at").alias("date"))
    dates = calendar(dw.dim_date.select("date", "date_sk"))
    branches = dw.dim_branch.select("branch_id", "branch_sk")
    s = sales.join(dates, "date", how).join(branches, "branch_id", how)
    customers = dw.dim_customer.select(F.col("customer_id").alias("_dk"), "customer_sk")
    s = s.withColumn("_ck", customer_key())
    s = s.join(customers, (F.col("_ck") == F.col("_dk")) & F.col("customer_id").isNotNull(), "left")
    if counts is not None:
        s = counts.of_sales(s).where("date_sk is not null and branch_sk is not null")
    s = s.select(
        "sale_id", "date_sk", "branch_sk", "customer_sk", year_month(F.col("date")).alias("sale_month"))
    items = op.sale_item.select("item_id", "sale_id", "product_id", "qty", "unit_price", "discount")
    f = (s.join(items, "sale_id")
         .join(dw.dim_product.select("product_id", "product_sk"), "product_id", how))
    if counts is not None:
        f = counts.of_items(f).where("product_sk is not null")
    q, p, d = F.col("qty"), F.col("unit_price"), F.col("discount")
    return conform(f.select(
        "date_sk", "branch_sk", "product_sk", "customer_sk", "sale_id", "item_id", "qty",
        line_gross(q, p).alias("gross"),
        F.round(d, 2).cast(S.FACT_MONEY).alias("discount"),
        line_net(q, p, d).alias("net"),
        ntz(as_of).alias("loaded_at"),
        "sale_month",
    ), S.FACT_SALE_ITEM)


def load_fact(op: OpTables, dw: DwTables, last_run: dt.datetime, as_of: dt.datetime) -> DataFrame:
    return upsert_by_key(dw.fact_sale_item, fact_source(op, dw, last_run, as_of), "item_id")


# --- pipeline (D10) ---------------------------------------------------------

Stage = Callable[[str, DataFrame], DataFrame]
MergeFact = Callable[[DataFrame, DataFrame], DataFrame]
MergeDimension = Callable[[str, DataFrame], DataFrame]


def lazy(name: str, df: DataFrame) -> DataFrame:
    """Default stage: keep the frame lazy."""
    return df


def run_etl(op: OpTables, dw: DwTables, as_of: dt.datetime, process: str = S.PROCESS_NAME,
            initial_mark: dt.datetime = S.DEFAULT_LAST_RUN, stage: Stage = lazy,
            merge_fact: MergeFact | None = None, merge_dimension: MergeDimension | None = None,
            since: dt.datetime | None = None, counts: LookupCounts | None = None) -> EtlRun:
    """One ETL run; returns the new warehouse content.

    ``stage(table, frame)`` is called for each new table as soon as it is
    final (dimensions before the fact, the control row last) and returns the
    frame later steps read.  A store writes the table and returns a scan of
    it, so the fact load joins small written dimensions instead of their
    upsert lineage, and surrogate keys are fixed once written.

    ``merge_fact(target, source)`` applies the fact upsert; the default
    replaces rows by item id over the whole target and stages the result.
    A partitioned store rewrites only the partitions the source touches.
    ``merge_dimension(name, source)`` does the same for a type-1 dimension.

    ``since`` replaces the stored mark when the caller already restricted
    ``op.sale`` to the changed sales (a stream's micro-batch); the mark then
    stays, so that a later batch run misses nothing.

    ``counts`` observes the fact load's lookups (``LookupCounts``).
    """
    control = ensure_control(dw.etl_control, process, initial_mark, as_of)
    last_run = read_last_run(control, process) if since is None else since
    rng = changed_range(op.sale, last_run)
    if rng is None:
        return EtlRun(dw.with_(etl_control=control), last_run, None, as_of)
    dw = dw.with_(dim_date=stage("dim_date", upsert_dim_date(dw.dim_date, rng[0].date(), rng[1].date())))
    sources = dimension_sources(op, as_of)
    with ThreadPoolExecutor(len(sources)) as pool:      # dimensions do not depend on one another
        jobs = {name: pool.submit(merge_dimension or (lambda n, rows: stage(n, upsert_dimension(dw, n, rows))), name, rows)
                for name, rows in sources.items()}
        dims = {name: job.result() for name, job in jobs.items()}
    dw = dw.with_(**dims)
    source = fact_source(op, dw, last_run, as_of, counts=counts)
    if merge_fact is None:
        fact = stage("fact_sale_item", upsert_by_key(dw.fact_sale_item, source, "item_id"))
    else:
        fact = merge_fact(dw.fact_sale_item, source)
    dw = dw.with_(fact_sale_item=fact)
    moved = advance_mark(control, as_of, process) if since is None else control
    dw = dw.with_(etl_control=stage("etl_control", moved))
    return EtlRun(dw, last_run, rng, as_of)


def first_load(op: OpTables, as_of: dt.datetime, initial_mark: dt.datetime = S.DEFAULT_LAST_RUN,
               stage: Stage = lazy) -> EtlRun:
    """ETL into an empty warehouse."""
    spark = op.sale.sparkSession
    return run_etl(op, DwTables.empty(spark), as_of, initial_mark=initial_mark, stage=stage)
