"""

Every registered query derives the operational tables from the driver's
parquet tables (``tillhouse.sources.testdata``), runs the warehouse load and
then the query.  Within one Spark application the warehouse of a table folder is
loaded once, through ``WarehouseStore`` on the shared folder, and the queries
share it.

Results are presented with portable types on both sides: money as DOUBLE
(computed exactly in decimals, converted last), dates and timestamps as
ISO strings, integers as BIGINT.  Surrogate keys are never output (they
depend on load order); natural keys are.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tillhouse import schemas as S  # noqa: E402
from tillhouse.model import DwTables, OpTables  # noqa: E402
from tillhouse.functions.dates import ntz  # noqa: E402
from tillhouse.operators import quality  # noqa: E402
from tillhouse.operators.joins import calendar  # noqa: E402
from tillhouse.operators.rank import ordered_positions  # noqa: E402
from tillhouse.plans import drift, etl, kpi, reports, validate, views  # noqa: E402
from tillhouse.session import scratch_path, sized_hash_joins  # noqa: E402
from tillhouse.sources import extract, kpistore, readers, rulestore, seed, store, testdata  # noqa: E402

try:  # the training-data operators are a removable part
    import corpus_pipeline
    from tillhouse.llm import queries as llm
except ImportError:
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

# Fixed parameters of the registered scenarios.
FIRST_MARK = dt.datetime(1990, 1, 1)      # initial mark: before every sale of the driver tables
LOAD_AS_OF = dt.datetime(2002, 1, 1)      # run timestamp of the full load
REPORT_AS_OF = dt.date(2001, 8, 1)        # "today" of the reports
REPORT_DAYS = 365                         # daily window: as_of - 365 .. as_of
INCR_MARK = dt.datetime(1998, 1, 1)       # incremental scenario: run 1 as of this mark
INCR_AS_OF = dt.datetime(2002, 1, 1)      # incremental scenario: run 2 timestamp
FLIP_EVERY = 17                           # run 2: COMPLETED sales with sale_id % 17 = 0 become CANCELLED
MOVE_AS_OF = dt.datetime(2002, 2, 1)      # moved-sales scenario: the run after the full load
MOVE_EVERY, MOVE_DAYS = 53, 40            # sales with id % 53 = 0 get a date 40 days later
RELOCATE_EVERY = 1000                     # run 2: customers with id % 1000 = 3 move to city 'MOVED'
NEW_CATEGORY_EVERY = 10                   # run 2: products with id % 10 = 0 move to category 'NEW'
BROKEN_YEAR, COPIED_YEAR, COPY_MONTH = 1996, 1995, 209901
DRIFT_MISSING, DRIFT_AMOUNT, DRIFT_PENDING, DRIFT_COPY, DRIFT_BROKEN = 97, 89, 101, 107, 83

SEED_AS_OF = dt.datetime(2024, 3, 10, 12, 0)  # the seed's NOW()

# The columns of the wide reports (branch names of the driver tables): fixed values.
BRANCHES = sorted(f"NATION_{k}" for k in range(25))

D0, D1 = kpi.report_window(REPORT_AS_OF, REPORT_DAYS)
M0, M1 = (D0.year, D0.month), (D1.year, D1.month)


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(cols)


_BUILT: dict = {}


def _key(spark: SparkSession, *parts):
    return (spark.sparkContext.applicationId, *parts)


def source(spark: SparkSession, sf_dir: str, category: str = "p_type") -> OpTables:
    k = _key(spark, "op", sf_dir, category)
    if k not in _BUILT:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))     # fewer would be dealt out anew for a join
        _BUILT[k] = store.persist_op(testdata.op_tables(spark, sf_dir, category, buckets), buckets)
    return _BUILT[k]


def _store(spark: SparkSession, name: str, **options: int) -> store.WarehouseStore:
    return store.WarehouseStore(scratch_path(spark, f"warehouse-{name}-{uuid.uuid4().hex}"), **options)


def warehouse(spark: SparkSession, sf_dir: str, category: str = "p_type") -> tuple[OpTables, DwTables]:
    """Operational tables and the first-load warehouse (built once per app)."""
    k = _key(spark, "dw", sf_dir, category)
    if k not in _BUILT:
        op = source(spark, sf_dir, category)
        _BUILT[k] = (op, _store(spark, "full").run(op, LOAD_AS_OF, initial_mark=FIRST_MARK).dw)
    return _BUILT[k]


def incremental(spark: SparkSession, sf_dir: str) -> tuple[DwTables, DwTables, OpTables]:
    """Two runs: run 1 sees sales updated before INCR_MARK; run 2 sees all
    sales after status flips and category changes."""
    k = _key(spark, "incr", sf_dir)
    if k not in _BUILT:
        op = source(spark, sf_dir)
        sale1 = op.sale.filter(F.col("updated_at") < ntz(INCR_MARK))
        op1 = op.with_(sale=sale1, sale_item=op.sale_item.join(sale1.select("sale_id"), "sale_id", "left_semi"))
        loads = _store(spark, "incremental", dim_bucket_rows=500)
        dw1 = loads.run(op1, INCR_MARK, initial_mark=FIRST_MARK).dw
        flip = (F.col("sale_id") % FLIP_EVERY == 0) & (F.col("status") == S.STATUS_COMPLETED)
        sale2 = (op.sale.withColumn("updated_at", F.when(flip, F.greatest("updated_at", ntz(INCR_MARK)))
                                    .otherwise(F.col("updated_at")))
                 .withColumn("status", F.when(flip, F.lit(S.STATUS_CANCELLED)).otherwise(F.col("status"))))
        prod2 = op.product.withColumn(
            "category", F.when(F.col("product_id") % NEW_CATEGORY_EVERY == 0, F.lit("NEW"))
            .otherwise(F.col("category")))
        cust2 = op.customer.withColumn("city", F.when(F.col("customer_id") % RELOCATE_EVERY == 3, "MOVED").otherwise(F.col("city")))
        op2 = op.with_(sale=sale2, product=prod2, customer=cust2)
        dw2 = loads.run(op2, INCR_AS_OF).dw
        _BUILT[k] = (dw1, dw2, op2)
        _BUILT[_key(spark, "incr store", sf_dir)] = loads
    return _BUILT[k]


def stored_kpis(spark: SparkSession, sf_dir: str) -> kpistore.KpiStore:
    """The KPI tables of the incremental scenario: made after run 1, refreshed after run 2."""
    k = _key(spark, "kpis", sf_dir)
    if k not in _BUILT:
        incremental(spark, sf_dir)
        kpis = kpistore.KpiStore(_BUILT[_key(spark, "incr store", sf_dir)])
        kpis.refresh(spark, 1)
        kpis.refresh(spark, 2, 1)
        _BUILT[k] = kpis
    return _BUILT[k]


def moved(spark: SparkSession, sf_dir: str) -> DwTables:
    """A full load, then a run in which some sales have another date: their items are stored in other months."""
    k = _key(spark, "moved", sf_dir)
    if k not in _BUILT:
        op, loads = source(spark, sf_dir), _store(spark, "moved")
        loads.run(op, LOAD_AS_OF, initial_mark=FIRST_MARK)
        hit, later = F.col("sale_id") % MOVE_EVERY == 0, F.make_dt_interval(F.lit(MOVE_DAYS))
        sale = (op.sale.withColumn("sold_at", F.when(hit, F.col("sold_at") + later).otherwise(F.col("sold_at")))
                .withColumn("updated_at", F.when(hit, ntz(LOAD_AS_OF)).otherwise(F.col("updated_at"))))
        _BUILT[k] = loads.run(op.with_(sale=sale), MOVE_AS_OF).dw
    return _BUILT[k]


def fact_natural(dw: DwTables) -> DataFrame:
    """Fact rows with natural keys in place of surrogate keys."""
    f = dw.fact_sale_item
    return (f.join(calendar(dw.dim_date.select("date_sk", "date")), "date_sk")
            .join(dw.dim_branch.select("branch_sk", "branch_id"), "branch_sk")
            .join(dw.dim_product.select("product_sk", "product_id"), "product_sk")
            .join(dw.dim_customer.select("customer_sk", "customer_id"), "customer_sk", "left")
            .select("item_id", "sale_id", "date", "branch_id", "product_id", "customer_id", "qty",
                    "gross", "discount", "net", "loaded_at", "sale_month"))


def _daily(spark, d):
    _, dw = warehouse(spark, d)
    return kpi.kpi_daily_range(dw, D0, D1)


def _monthly(spark, d, category="p_type"):
    _, dw = warehouse(spark, d, category)
    return kpi.kpi_monthly_range(dw, *M0, *M1)


def _drifted(spark, d, kind: str) -> tuple[OpTables, DwTables]:
    op, dw = warehouse(spark, d)
    item = F.col("item_id")
    if kind == "missing":
        return op, drift.drop_facts(dw, item % DRIFT_MISSING == 0)
    if kind == "amount":
        return op, drift.bump_amounts(dw, (item % DRIFT_AMOUNT == 0) & (item % DRIFT_MISSING != 0))
    if kind == "pending":
        return op, drift.add_foreign_status(dw, op, S.STATUS_PENDING, item % DRIFT_PENDING == 0, LOAD_AS_OF)
    if kind == "copy":
        return op, drift.add_unknown_copies(dw, item % DRIFT_COPY == 0)
    if kind == "broken":
        return op, drift.break_product_key(dw, (item % DRIFT_BROKEN == 0) & (item % DRIFT_MISSING != 0))
    raise ValueError(kind)


def stored_rules(spark: SparkSession, sf_dir: str) -> rulestore.RuleStore:
    """Rule counts of the incremental scenario: made after run 1, brought to run 2 by its changes."""
    k = _key(spark, "rules", sf_dir)
    if k not in _BUILT:
        incremental(spark, sf_dir)
        rules = rulestore.RuleStore(_BUILT[_key(spark, "incr store", sf_dir)])
        rules.refresh(spark, 1)
        rules.refresh(spark, 2, 1)
        _BUILT[k] = rules
    return _BUILT[k]


def _stored_rules_drift(spark, d):
    """A full load, then months with defects: unknown products in one year, items of another year copied to a new month."""
    op, loads = source(spark, d), _store(spark, "rules")
    fact = loads.run(op, LOAD_AS_OF, initial_mark=FIRST_MARK).dw.fact_sale_item
    year, item = F.floor(F.col("sale_month") / 100), F.col("item_id")
    hit = F.when(item % DRIFT_BROKEN == 0, -1).otherwise(F.col("product_sk"))
    broken = fact.where(year == BROKEN_YEAR).withColumn("product_sk", hit.cast("long"))
    copies = fact.where((year == COPIED_YEAR) & (item % DRIFT_COPY == 0)).withColumn("sale_month", F.lit(COPY_MONTH))
    rules = rulestore.RuleStore(loads)
    rules.refresh(spark, 1)
    loads.replace_months(broken.unionByName(copies), MOVE_AS_OF)
    rules.refresh(spark, 2, 1)
    return rules.counts(spark, 2)


def _staged_sides(op: OpTables, dw: DwTables) -> validate.Sides:
    with sized_hash_joins(op.sale.sparkSession):
        return validate.Sides.staged_by(op, dw, store.parquet_stage)


def _list_sides(op: OpTables, dw: DwTables) -> validate.Sides:
    with sized_hash_joins(op.sale.sparkSession):
        return validate.Sides.of_lists(op, dw, store.parquet_stage)


CHECKS: dict[str, Callable[[OpTables, DwTables], DataFrame]] = {
    "check1_item_count": validate.item_counts,
    "check2_money_totals": validate.money_totals,
    "check3_daily_diffs": validate.daily_diffs,
    "check4_missing_items": lambda op, dw: validate.missing_items(op, dw, sides=_list_sides(op, dw)),
    "check5_surplus_items": lambda op, dw: validate.surplus_items(op, dw, sides=_list_sides(op, dw)),
    "check6_dim_keys": lambda op, dw: validate.dim_key_check(dw),
    "check7_sanity": validate.sanity,
    "check_verdict": lambda op, dw: validate.verdict(op, dw, _staged_sides(op, dw)).select("check", "passed", "n_bad"),
}


CHECK_DRIFT = {
    "check1_item_count": "missing", "check2_money_totals": "amount", "check3_daily_diffs": "pending",
    "check4_missing_items": "missing", "check5_surplus_items": "copy", "check6_dim_keys": "broken",
    "check7_sanity": "amount", "check_verdict": "missing",
}


def _check_query(name: str, kind: str | None):
    def run(spark, d):
        if kind == "incremental":
            _, dw, op = incremental(spark, d)
        else:
            op, dw = warehouse(spark, d) if kind is None else _drifted(spark, d, kind)
        return CHECKS[name](op, dw)
    return run


# Checks also registered on the incremental scenario: sales that left
# COMPLETED keep their facts (listed by V5), days with such sales differ (V3).
INCREMENTAL_CHECKS = ["check3_daily_diffs", "check5_surplus_items", "check_verdict"]


def _sql_daily(spark, d):
    _, dw = warehouse(spark, d)
    views.register(spark, dw)
    return views.load_daily(spark, D0, D1)


def _dims_query(table: str, cols: list[str]):
    def run(spark, d):
        _, dw = warehouse(spark, d)
        return getattr(dw, table).select(*cols)
    return run


def _surrogate_keys(spark, d):
    _, dw = warehouse(spark, d)
    frames = []
    for table, (_, sk) in S.DIM_KEYS.items():
        frames.append(getattr(dw, table).agg(
            F.lit(table).alias("table"), F.count(F.lit(1)).alias("n_rows"),
            F.countDistinct(sk).alias("n_keys"), F.min(sk).cast("long").alias("min_sk"),
            F.max(sk).cast("long").alias("max_sk")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _control_marks(spark, d):
    """The control row after each of the two runs, with the number of source sales it leaves for the next."""
    dw1, dw2, _ = incremental(spark, d)
    marks = dw1.etl_control.unionByName(dw2.etl_control)
    sales = source(spark, d).sale.select("updated_at")
    return (marks.select("process", "last_run").join(sales, sales["updated_at"] >= F.col("last_run"), "left")
            .groupBy("process", "last_run").agg(F.count(sales["updated_at"]).alias("sales_left")))


def _dim_product_scd1(spark, d):
    dw1, dw2, _ = incremental(spark, d)
    p1 = dw1.dim_product.select("product_id", F.col("product_sk").alias("sk1"))
    return (dw2.dim_product.join(p1, "product_id", "left")
            .select("product_id", "sku", "name", "category", "active", "updated_at",
                    (F.col("product_sk") == F.col("sk1")).alias("sk_kept")))


def _dim_customer_scd1(spark, d):
    dw1, dw2, _ = incremental(spark, d)
    c1 = dw1.dim_customer.select("customer_id", F.col("customer_sk").alias("sk1"))
    return (dw2.dim_customer.join(c1, "customer_id", "left")
            .select("customer_id", "city", "uf", "updated_at", (F.col("customer_sk") == F.col("sk1")).alias("sk_kept")))


def _sql_monthly(spark, d):
    _, dw = warehouse(spark, d)
    views.register(spark, dw)
    return views.load_monthly(spark, *M0, *M1)


def _quarter_city(spark, d):
    rows = stored_kpis(spark, d).rollup(spark, 2, kpistore.quarter_of(), "city")
    q = F.col("period")
    return rows.select(F.floor(q / 10).alias("year"), (q % 10).alias("quarter"), "city", "net", "n_sales", "units_sold")


def _appended_products(spark, d):
    """Products appended in two writes with a column list, read back with the defaults filled in."""
    root = scratch_path(spark, f"appended-{uuid.uuid4().hex}")
    rows = source(spark, d).product.select("product_id", "sku", "name", "category", "list_price")
    for half in (0, 1):
        readers.append_rows(rows.where(F.col("product_id") % 2 == half), root, "product", SEED_AS_OF)
    return spark.read.schema(S.PRODUCT).parquet(f"{root}/product")


def _report_written(spark, d):
    """The stacked report written as CSV and read back; an empty report beside it leaves no folder."""
    out = scratch_path(spark, f"reports-{uuid.uuid4().hex}")
    cells = reports.stack_cells(_monthly(spark, d, "p_brand"), BRANCHES)
    written = reports.write_reports({"stack": cells, "nothing": cells.where("net < 0")}, out)
    if written != [f"{out}/stack"]:
        raise ValueError(f"unexpected folders {written}")
    return reports.read_report(spark, out, "stack", cells.schema)


def _lookup_counts(spark, d):
    """What the two runs of the incremental scenario read and lost in their lookups."""
    incremental(spark, d)
    return _BUILT[_key(spark, "incr store", d)].lookup_counts(spark)


def _from_extract(spark, d):
    """The fact rows of the sales changed since the mark, loaded from the laid-out extract."""
    op, dw = warehouse(spark, d)
    root = scratch_path(spark, f"extract-{uuid.uuid4().hex}")
    extract.write_extract(op, root)
    with extract.Extract(spark, root) as e:
        rows = store.parquet_stage("from-extract", etl.fact_source(e.read(INCR_MARK), dw, INCR_MARK, LOAD_AS_OF))
    return rows.select("item_id", "sale_id", "qty", "gross", "discount", "net", "sale_month")


def _customer_positions(spark, d):
    rows = source(spark, d).customer.select("customer_id", "name")
    return ordered_positions(rows, ["name", "customer_id"], store.parquet_stage)


def seeded(spark: SparkSession, sf_dir: str) -> OpTables:
    """Seed tables sized by the driver tables: one customer per customer row,
    one sale per order row (ids 1..n from the dense table keys)."""
    customer_ids = testdata.read_table(spark, sf_dir, "customer").select((F.col("c_custkey") + 1).alias("gs"))
    sale_ids = testdata.read_table(spark, sf_dir, "orders").select((F.col("o_orderkey") + 1).alias("gs"))
    return seed.seed(spark, SEED_AS_OF, customer_ids=customer_ids, sale_ids=sale_ids)


def _queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        # KPI views and range loads
        "kpi_daily_branch": lambda s, d: kpi.kpi_daily_branch(warehouse(s, d)[1]),
        "kpi_monthly_branch_category": lambda s, d: kpi.kpi_monthly_branch_category(warehouse(s, d)[1]),
        "kpi_daily_range": _daily,
        "kpi_monthly_range": _monthly,
        # reports
        "report_daily_pivot": lambda s, d: reports.daily_net_pivot(_daily(s, d), BRANCHES),
        "report_branch_total": lambda s, d: reports.branch_totals(_daily(s, d)),
        "report_weekday_matrix": lambda s, d: reports.weekday_matrix(_daily(s, d), warehouse(s, d)[1].dim_date, BRANCHES),
        "report_top_categories": lambda s, d: reports.top_category_matrix(_monthly(s, d, "p_brand"), BRANCHES),
        "report_stack_bases": lambda s, d: reports.stack_cells(_monthly(s, d, "p_brand"), BRANCHES),
        # operational queries
        "item_count": lambda s, d: kpi.item_count(source(s, d)),
        "sales_by_branch": lambda s, d: kpi.sales_by_branch(source(s, d)),
        "status_histogram": lambda s, d: kpi.status_histogram(source(s, d)),
        "branch_listing": lambda s, d: kpi.branch_listing(source(s, d)),
        # warehouse tables after the full load
        "dim_date": _dims_query("dim_date", ["date", "year", "month", "day", "quarter", "weekday", "month_name"]),
        "dim_branch": _dims_query("dim_branch", ["branch_id", "name", "city", "uf", "active", "updated_at"]),
        "dim_product": _dims_query("dim_product", ["product_id", "sku", "name", "category", "active",
                                                   "updated_at"]),
        "dim_customer": _dims_query("dim_customer", ["customer_id", "city", "uf", "updated_at"]),
        "fact_first_load": lambda s, d: fact_natural(warehouse(s, d)[1]),
        "surrogate_keys": _surrogate_keys,
        "etl_control": _control_marks,
        "changed_range": lambda s, d: etl.changed_range_frame(source(s, d).sale, INCR_MARK),
        # incremental scenario
        "fact_incremental": lambda s, d: fact_natural(incremental(s, d)[1]),
        "dim_product_scd1": _dim_product_scd1,
        "dim_customer_scd1": _dim_customer_scd1,
        "fact_moved": lambda s, d: fact_natural(moved(s, d)),
        "kpi_stored_daily": lambda s, d: stored_kpis(s, d).daily(s, 2),
        "kpi_stored_monthly": lambda s, d: stored_kpis(s, d).monthly(s, 2),
        "kpi_quarter_city": _quarter_city,
        # written tables read back, positions in an order
        "lookup_counts": _lookup_counts,
        "fact_from_extract": _from_extract,
        "appended_products": _appended_products,
        "report_written": _report_written,
        "customer_positions": _customer_positions,
        # data quality
        "dq_domains": lambda s, d: quality.domain_violations(*warehouse(s, d)),
        "dq_not_null": lambda s, d: quality.null_violations(*warehouse(s, d)),
        "dq_duplicates": lambda s, d: quality.duplicate_keys(*warehouse(s, d)),
        "dq_orphans": lambda s, d: quality.orphans(*warehouse(s, d)),
        "dq_orphans_drift": lambda s, d: quality.orphans(*_drifted(s, d, "broken")),
        "dq_stored": lambda s, d: stored_rules(s, d).counts(s, 2),
        "dq_stored_drift": _stored_rules_drift,
        # seed dataset job
        "seed_customers": lambda s, d: seeded(s, d).customer,
        "seed_sales": lambda s, d: seeded(s, d).sale,
        "seed_items": lambda s, d: seeded(s, d).sale_item,
    }
    for name in CHECK_DRIFT:
        q[name] = _check_query(name, None)
        q[name + "_drift"] = _check_query(name, CHECK_DRIFT[name])
    for name in INCREMENTAL_CHECKS:
        q[name + "_incremental"] = _check_query(name, "incremental")
    q["kpi_daily_range_sql"] = _sql_daily
    q["kpi_monthly_range_sql"] = _sql_monthly
    return q


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = {name: (lambda fn: (lambda spark, sf_dir: present(fn(spark, sf_dir))))(fn)
           for name, fn in _queries().items()}
    return own if llm is None else {**own, **llm.QUERIES, "pipeline": corpus_pipeline.run}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily KPI per branch over the full load of the sf0.001 tables."""
    return queries()["kpi_daily_branch"](spark, SMOKE_DIR)


# ---------------------------------------------------------------------------
# DuckDB oracle
# ---------------------------------------------------------------------------
# Money is carried in integer cents; ratios use exact half-up integer
# rounding: round(a / b, 2) on cents = (2 * a + b) // (2 * b) hundredths.

def _ts(x: dt.datetime) -> str:
    return f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'"


def _op_cte(category: str = "p_type") -> str:
    return f"""
op_branch AS (
  SELECT n_nationkey AS branch_id, n_name AS name, r_name AS city, 'XX' AS uf, TRUE AS active,
         TIMESTAMP '1990-01-01 00:00:00' AS created_at, TIMESTAMP '1990-01-01 00:00:00' AS updated_at
  FROM nation JOIN region ON n_regionkey = r_regionkey),
op_customer AS (
  SELECT c_custkey AS customer_id, c_name AS name, md5(CAST(c_custkey AS VARCHAR)) AS doc_hash,
         n_name AS city, 'XX' AS uf,
         TIMESTAMP '1990-01-01 00:00:00' AS created_at, TIMESTAMP '1990-01-01 00:00:00' AS updated_at
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
op_product AS (
  SELECT p_partkey AS product_id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, p_name AS name,
         {category} AS category, CAST(round(p_retailprice * 100) AS BIGINT) AS list_c, TRUE AS active,
         TIMESTAMP '1990-01-01 00:00:00' AS created_at, TIMESTAMP '1990-01-01 00:00:00' AS updated_at
  FROM part),
op_sale AS (
  SELECT o_orderkey AS sale_id, c_nationkey AS branch_id,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_custkey END AS customer_id,
         o_orderdate + INTERVAL 10 HOUR + to_minutes(CAST((o_orderkey % 9) * 45 AS BIGINT)) AS sold_at,
         CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'P' THEN 'CANCELLED' WHEN 'O' THEN 'PENDING' END
           AS status,
         CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'ONLINE'
              WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'PHONE' ELSE 'STORE' END AS channel,
         o_orderdate AS created_at, o_orderdate AS updated_at
  FROM orders JOIN customer ON o_custkey = c_custkey),
op_lines AS (
  SELECT l_orderkey, l_partkey, l_quantity,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate,
                            l_extendedprice, l_quantity, l_discount, l_tax) AS n
  FROM lineitem),
op_item AS (
  SELECT l_orderkey * 100 + n AS item_id, l_orderkey AS sale_id, l_partkey AS product_id,
         CAST(l_quantity AS INTEGER) AS qty,
         (p.list_c * (95 + (l_orderkey + n) % 7) + 50) // 100 AS price_c,
         CASE WHEN o_orderstatus = 'F' THEN CASE (l_orderkey + n) % 6 WHEN 0 THEN 1500 WHEN 1 THEN 1000
                                                 WHEN 2 THEN 500 ELSE 0 END ELSE 0 END AS disc_c,
         o_orderdate AS created_at, o_orderdate AS updated_at
  FROM op_lines JOIN orders ON l_orderkey = o_orderkey JOIN op_product p ON l_partkey = p.product_id)"""


def _fact_cte(name: str = "fact", sale: str = "op_sale", where: str = "s.status = 'COMPLETED'") -> str:
    return f"""
{name} AS (
  SELECT i.item_id, s.sale_id, CAST(s.sold_at AS DATE) AS date, s.branch_id, i.product_id,
         c.customer_id, i.qty, i.qty * i.price_c AS gross_c, i.disc_c, i.qty * i.price_c - i.disc_c AS net_c,
         s.updated_at, s.status
  FROM {sale} s JOIN op_item i ON i.sale_id = s.sale_id
  JOIN op_branch b ON b.branch_id = s.branch_id
  JOIN op_product p ON p.product_id = i.product_id
  LEFT JOIN op_customer c ON c.customer_id = s.customer_id
  WHERE {where})"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def _money(c: str) -> str:
    return f"CAST({c} AS DOUBLE) / 100"


def _half_up(num: str, den: str) -> str:
    """round(num / den, 2) in hundredths for non-negative num, positive den, as DOUBLE."""
    return f"CAST((2 * ({num}) + ({den})) // (2 * ({den})) AS DOUBLE) / 100"


BASE = _with(_op_cte(), _fact_cte())
BRAND = _with(_op_cte("p_brand"), _fact_cte())

# One row per sale first: a sale has one day and one branch, so counting rows counts sales.
DAILY_SELECT = f"""
SELECT CAST(s.date AS VARCHAR) AS date, b.name AS branch, b.city, b.uf, COUNT(*) AS n_sales,
       CAST(SUM(s.units) AS BIGINT) AS units_sold, {_money('SUM(s.net)')} AS net, {_money('SUM(s.gross)')} AS gross,
       {_money('SUM(s.disc)')} AS discount,
       CASE SUM(s.gross) WHEN 0 THEN 0 ELSE {_half_up('10000 * SUM(s.disc)', 'SUM(s.gross)')} END AS discount_pct,
       {_half_up('SUM(s.net)', 'COUNT(*)')} AS avg_ticket, {_half_up('100 * SUM(s.units)', 'COUNT(*)')} AS units_per_sale
FROM (SELECT f.date, f.branch_id, f.sale_id, SUM(f.qty) AS units, SUM(f.net_c) AS net, SUM(f.gross_c) AS gross, SUM(f.disc_c) AS disc
      FROM fact f {{where}} GROUP BY f.sale_id, f.branch_id, f.date) s
JOIN op_branch b USING (branch_id)
GROUP BY s.date, b.name, b.city, b.uf"""

MONTHLY_SELECT = f"""
SELECT CAST(year(f.date) AS BIGINT) AS year, CAST(month(f.date) AS BIGINT) AS month, b.name AS branch,
       p.category, {_money('SUM(f.net_c)')} AS net, COUNT(DISTINCT f.sale_id) AS n_sales,
       CAST(SUM(f.qty) AS BIGINT) AS units_sold
FROM fact f JOIN op_branch b ON b.branch_id = f.branch_id JOIN op_product p ON p.product_id = f.product_id
{{where}}
GROUP BY 1, 2, 3, 4"""

DAILY_WHERE = f"WHERE f.date BETWEEN DATE '{D0}' AND DATE '{D1}'"
MONTHLY_WHERE = (f"WHERE (year(f.date) > {M0[0]} OR (year(f.date) = {M0[0]} AND month(f.date) >= {M0[1]})) "
                 f"AND (year(f.date) < {M1[0]} OR (year(f.date) = {M1[0]} AND month(f.date) <= {M1[1]}))")


# Top categories and their dense (period, category) x branch cells, in cents.
TOP_CELLS = f""",
rows AS (
  SELECT CAST(year(f.date) AS VARCHAR) || '-' || lpad(CAST(month(f.date) AS VARCHAR), 2, '0') AS period,
         p.category, b.name AS branch, SUM(f.net_c) AS net_c
  FROM fact f JOIN op_branch b ON b.branch_id = f.branch_id JOIN op_product p ON p.product_id = f.product_id
  {MONTHLY_WHERE}
  GROUP BY 1, 2, 3),
top AS (SELECT category FROM rows GROUP BY category ORDER BY SUM(net_c) DESC, category LIMIT 6),
trows AS (SELECT * FROM rows WHERE category IN (SELECT category FROM top)),
cells AS (
  SELECT k.period, k.category, br.branch, COALESCE(SUM(r.net_c), 0) AS net_c
  FROM (SELECT DISTINCT period, category FROM trows) k CROSS JOIN (SELECT name AS branch FROM op_branch) br
  LEFT JOIN trows r ON r.period = k.period AND r.category = k.category AND r.branch = br.branch
  GROUP BY 1, 2, 3)
"""

LABEL = "period || chr(10) || category"

# Dense date dimension of the full load: every day between the first and last sale.
DIM_DATE_SQL = """(SELECT d, CAST(month(d) AS INT) AS month, CAST(day(d) AS INT) AS day,
        CAST(quarter(d) AS INT) AS quarter, CAST(isodow(d) AS INT) AS weekday FROM (
        SELECT CAST(unnest(generate_series(min(CAST(sold_at AS DATE)), max(CAST(sold_at AS DATE)),
               INTERVAL 1 DAY)) AS DATE) AS d FROM op_sale))"""

FACT_NATURAL_SELECT = f"""
SELECT item_id, sale_id, CAST(date AS VARCHAR) AS date, CAST(branch_id AS BIGINT) AS branch_id, product_id,
       customer_id, CAST(qty AS BIGINT) AS qty, {_money('gross_c')} AS gross, {_money('disc_c')} AS discount,
       {_money('net_c')} AS net, {{loaded}} AS loaded_at,
       CAST(year(date) * 100 + month(date) AS BIGINT) AS sale_month
FROM {{src}}"""

INCR_CTES = f""",
op_sale2 AS (
  SELECT sale_id, branch_id, customer_id, sold_at,
         CASE WHEN sale_id % {FLIP_EVERY} = 0 AND status = 'COMPLETED' THEN 'CANCELLED' ELSE status END AS status,
         CASE WHEN sale_id % {FLIP_EVERY} = 0 AND status = 'COMPLETED'
              THEN greatest(updated_at, {_ts(INCR_MARK)}) ELSE updated_at END AS updated_at
  FROM op_sale),
{_fact_cte("run1", "op_sale", f"s.status = 'COMPLETED' AND s.updated_at < {_ts(INCR_MARK)}")[1:]},
{_fact_cte("run2", "op_sale2", f"s.status = 'COMPLETED' AND s.updated_at >= {_ts(INCR_MARK)}")[1:]},
incr AS (
  SELECT *, '{INCR_AS_OF:%Y-%m-%d %H:%M:%S}' AS loaded FROM run2
  UNION ALL
  SELECT *, '{INCR_MARK:%Y-%m-%d %H:%M:%S}' AS loaded FROM run1 WHERE item_id NOT IN (SELECT item_id FROM run2))
"""

# Warehouse content after defects (natural keys; -1 = key without dimension row).
DRIFT_FACT = {
    "missing": f"SELECT * FROM fact WHERE item_id % {DRIFT_MISSING} <> 0",
    "amount": f"""SELECT item_id, sale_id, date, branch_id, product_id, customer_id, qty,
       gross_c + CASE WHEN item_id % {DRIFT_AMOUNT} = 0 AND item_id % {DRIFT_MISSING} <> 0 THEN 100 ELSE 0 END
         AS gross_c, disc_c,
       net_c + CASE WHEN item_id % {DRIFT_AMOUNT} = 0 AND item_id % {DRIFT_MISSING} <> 0 THEN 100 ELSE 0 END
         AS net_c, updated_at, status FROM fact""",
    "pending": f"""SELECT * FROM fact UNION ALL
       SELECT * FROM fact_pending WHERE item_id % {DRIFT_PENDING} = 0""",
    "copy": f"SELECT * FROM fact UNION ALL SELECT -item_id AS item_id, * EXCLUDE (item_id) FROM fact "
            f"WHERE item_id % {DRIFT_COPY} = 0",
    "broken": f"""SELECT item_id, sale_id, date, branch_id,
       CASE WHEN item_id % {DRIFT_BROKEN} = 0 AND item_id % {DRIFT_MISSING} <> 0 THEN -1 ELSE product_id END
         AS product_id, customer_id, qty, gross_c, disc_c, net_c, updated_at, status FROM fact""",
}


def _dw_cte(kind: str | None) -> str:
    """CTE ``dwf``: the warehouse fact (natural keys) for a clean or drifted load."""
    body = "SELECT * FROM fact" if kind is None else DRIFT_FACT[kind]
    extra = _fact_cte("fact_pending", "op_sale", "s.status = 'PENDING'") + "," if kind == "pending" else ""
    return f"{extra}\ndwf AS ({body})"


OP_COMPLETED = """(SELECT i.item_id, s.sale_id, s.sold_at, s.branch_id, i.product_id, i.qty, i.price_c, i.disc_c,
         i.qty * i.price_c AS gross_c, i.qty * i.price_c - i.disc_c AS net_c
  FROM op_sale_v s JOIN op_item i ON i.sale_id = s.sale_id WHERE s.status = 'COMPLETED')"""

# dwf rows visible through inner joins to the date and branch dimensions
DW_DATED = "(SELECT * FROM dwf WHERE branch_id IN (SELECT branch_id FROM op_branch))"


# What the dimension-key check looks up: result column, fact column, key and table of the dimension.
DIM_OF_FACT = [("no_dim_date", "date", "d", f"{DIM_DATE_SQL} t"), ("no_dim_branch", "branch_id", "branch_id", "op_branch"),
               ("no_dim_product", "product_id", "product_id", "op_product")]


def _check_sql(name: str, kind: str | None) -> str:
    """Oracle of a check; ``op_sale_v`` is the operational sale table the check sees."""
    if kind == "incremental":
        pre = BASE + INCR_CTES + ", op_sale_v AS (SELECT * FROM op_sale2), dwf AS (SELECT * FROM incr)\n"
    else:
        pre = BASE + "," + _dw_cte(kind) + ", op_sale_v AS (SELECT * FROM op_sale)\n"
    if name == "check1_item_count":
        return pre + f"""SELECT (SELECT COUNT(*) FROM {OP_COMPLETED}) AS op_items_completed,
                               (SELECT COUNT(*) FROM dwf) AS dw_items"""
    if name == "check2_money_totals":
        sums = {"gross": "gross_c", "discount": "disc_c", "net": "net_c"}
        cols = ", ".join(f"{_money(f'SUM({c}) FILTER (op)')} AS {m}_op, {_money(f'SUM({c}) FILTER (NOT op)')} AS {m}_dw, "
                         f"{_money(f'SUM(CASE WHEN op THEN {c} ELSE -{c} END)')} AS diff_{m}" for m, c in sums.items())
        return pre + f"""SELECT {cols} FROM (SELECT TRUE AS op, gross_c, disc_c, net_c FROM {OP_COMPLETED}
      UNION ALL SELECT FALSE, gross_c, disc_c, net_c FROM dwf)"""
    if name == "check3_daily_diffs":
        measures = {"n_sales": "COUNT(DISTINCT sale_id)", "n_items": "COUNT(item_id)", "gross": "SUM(gross_c)",
                    "discount": "SUM(disc_c)", "net": "SUM(net_c)"}
        cols, bad = [], []
        for m, agg in measures.items():
            o, d = f"COALESCE({agg} FILTER (op), 0)", f"COALESCE({agg} FILTER (NOT op), 0)"
            conv = (lambda c: f"CAST({c} AS BIGINT)") if m.startswith("n_") else _money
            cols += [f"{conv(f'({o})')} AS op_{m}", f"{conv(f'({d})')} AS dw_{m}", f"{conv(f'({o} - {d})')} AS diff_{m}"]
            bad.append(f"{o} - {d} <> 0")
        return pre + f"""SELECT CAST(day AS VARCHAR) AS date, CAST(branch_id AS BIGINT) AS branch_id, {', '.join(cols)}
FROM (SELECT TRUE AS op, CAST(sold_at AS DATE) AS day, branch_id, sale_id, item_id, gross_c, disc_c, net_c FROM {OP_COMPLETED}
      UNION ALL SELECT FALSE, CAST(date AS DATE), branch_id, sale_id, item_id, gross_c, disc_c, net_c FROM {DW_DATED})
GROUP BY day, branch_id HAVING {' OR '.join(bad)}"""
    if name == "check4_missing_items":
        return pre + f"""SELECT item_id, sale_id, CAST(sold_at AS VARCHAR) AS sold_at,
       CAST(branch_id AS BIGINT) AS branch_id, product_id, CAST(qty AS BIGINT) AS qty,
       {_money('price_c')} AS unit_price, {_money('disc_c')} AS discount
FROM {OP_COMPLETED} o WHERE item_id NOT IN (SELECT item_id FROM dwf)
ORDER BY sold_at, item_id LIMIT 200"""
    if name == "check5_surplus_items":
        return pre + f"""SELECT f.item_id, f.sale_id, CAST(f.date AS VARCHAR) AS date_dw,
       CAST(f.branch_id AS BIGINT) AS branch_id_dw, CAST(f.qty AS BIGINT) AS qty, {_money('f.gross_c')} AS gross,
       {_money('f.disc_c')} AS discount, {_money('f.net_c')} AS net
FROM {DW_DATED} f
WHERE NOT EXISTS (SELECT 1 FROM op_item i WHERE i.item_id = f.item_id)
   OR NOT EXISTS (SELECT 1 FROM op_sale_v s WHERE s.sale_id = f.sale_id AND s.status = 'COMPLETED')
ORDER BY f.date DESC, f.item_id LIMIT 200"""
    if name == "check6_dim_keys":
        lost = ", ".join(f"CAST((SELECT COUNT(*) FROM dwf WHERE {c} IN (SELECT {c} FROM dwf EXCEPT SELECT {k} FROM {t})) AS BIGINT) AS {n}"
                         for n, c, k, t in DIM_OF_FACT)
        return pre + f"SELECT {lost}"
    if name == "check7_sanity":
        return pre + f"""SELECT {_money('d.n')} AS dw_net_total, {_money('o.n')} AS op_net_total,
       {_half_up('d.n', 'NULLIF(d.k, 0)')} AS dw_avg_ticket, {_half_up('o.n', 'NULLIF(o.k, 0)')} AS op_avg_ticket
FROM (SELECT SUM(net_c) AS n, COUNT(DISTINCT sale_id) AS k FROM dwf) d,
     (SELECT SUM(net_c) AS n, COUNT(DISTINCT sale_id) AS k FROM {OP_COMPLETED}) o"""
    if name == "check_verdict":
        return pre + f""",
op_c AS {OP_COMPLETED},
c1 AS (SELECT (SELECT COUNT(*) FROM op_c) AS o, (SELECT COUNT(*) FROM dwf) AS d),
c2 AS (SELECT (SELECT SUM(gross_c) FROM op_c) - (SELECT SUM(gross_c) FROM dwf) AS g,
              (SELECT SUM(disc_c) FROM op_c) - (SELECT SUM(disc_c) FROM dwf) AS dd,
              (SELECT SUM(net_c) FROM op_c) - (SELECT SUM(net_c) FROM dwf) AS n),
signed AS (SELECT 1 AS sign, CAST(sold_at AS DATE) AS day, branch_id, sale_id, gross_c, disc_c, net_c FROM op_c
  UNION ALL SELECT -1, CAST(date AS DATE), branch_id, sale_id, gross_c, disc_c, net_c FROM {DW_DATED}),
c3 AS (SELECT COUNT(*) AS k FROM (
  SELECT day, branch_id FROM signed GROUP BY day, branch_id
  HAVING SUM(sign) <> 0 OR SUM(sign * gross_c) <> 0 OR SUM(sign * disc_c) <> 0 OR SUM(sign * net_c) <> 0
      OR COUNT(DISTINCT sale_id) FILTER (sign = 1) <> COUNT(DISTINCT sale_id) FILTER (sign = -1))),
c4 AS (SELECT COUNT(*) AS k FROM op_c WHERE item_id NOT IN (SELECT item_id FROM dwf)),
c5 AS (SELECT COUNT(*) AS k FROM {DW_DATED} f
  WHERE NOT EXISTS (SELECT 1 FROM op_item i WHERE i.item_id = f.item_id)
     OR NOT EXISTS (SELECT 1 FROM op_sale_v s WHERE s.sale_id = f.sale_id AND s.status = 'COMPLETED')),
c6 AS (SELECT {" + ".join(f"(SELECT COUNT(*) FROM dwf WHERE {c} IN (SELECT {c} FROM dwf EXCEPT SELECT {k} FROM {t}))" for _, c, k, t in DIM_OF_FACT)} AS k)
SELECT 'item_counts' AS "check", o = d AS passed, CAST(abs(o - d) AS BIGINT) AS n_bad FROM c1
UNION ALL SELECT 'money_totals', (COALESCE(g, 0) = 0 AND COALESCE(dd, 0) = 0 AND COALESCE(n, 0) = 0),
  CAST((COALESCE(g, 0) <> 0)::INT + (COALESCE(dd, 0) <> 0)::INT + (COALESCE(n, 0) <> 0)::INT AS BIGINT) FROM c2
UNION ALL SELECT 'daily_diffs', k = 0, CAST(k AS BIGINT) FROM c3
UNION ALL SELECT 'missing_items', k = 0, CAST(k AS BIGINT) FROM c4
UNION ALL SELECT 'surplus_items', k = 0, CAST(k AS BIGINT) FROM c5
UNION ALL SELECT 'dim_key_check', k = 0, CAST(k AS BIGINT) FROM c6
UNION ALL SELECT 'sanity', TRUE, CAST(0 AS BIGINT)"""
    raise KeyError(name)


def _dq_sql() -> dict[str, str]:
    def rule(table, name, ok, src):
        return (f"SELECT '{table}' AS \"table\", '{name}' AS rule, "
                f"CAST(COUNT(*) FILTER (WHERE NOT COALESCE({ok}, FALSE)) AS BIGINT) AS n_bad FROM {src}")

    dim_date = DIM_DATE_SQL
    domains = [
        rule("product", "list_price >= 0", "list_c >= 0", "op_product"),
        rule("sale", "status in domain", "status IN ('COMPLETED', 'CANCELLED', 'PENDING')", "op_sale"),
        rule("sale", "channel in domain", "channel IN ('STORE', 'ONLINE', 'PHONE')", "op_sale"),
        rule("sale_item", "qty > 0", "qty > 0", "op_item"),
        rule("sale_item", "unit_price >= 0", "price_c >= 0", "op_item"),
        rule("sale_item", "discount >= 0", "disc_c >= 0", "op_item"),
        rule("dim_date", "month 1-12", "month BETWEEN 1 AND 12", dim_date),
        rule("dim_date", "day 1-31", "day BETWEEN 1 AND 31", dim_date),
        rule("dim_date", "quarter 1-4", "quarter BETWEEN 1 AND 4", dim_date),
        rule("dim_date", "weekday 1-7", "weekday BETWEEN 1 AND 7", dim_date),
        rule("fact_sale_item", "qty > 0", "qty > 0", "fact"),
        rule("fact_sale_item", "gross >= 0", "gross_c >= 0", "fact"),
        rule("fact_sale_item", "discount >= 0", "disc_c >= 0", "fact"),
        rule("fact_sale_item", "net >= 0", "net_c >= 0", "fact"),
    ]
    op_src = {"branch": "op_branch", "customer": "op_customer", "product": "op_product", "sale": "op_sale",
              "sale_item": "op_item"}
    op_cols = {"product": {"list_price": "list_c"}, "sale_item": {"unit_price": "price_c", "discount": "disc_c"}}
    nulls = []
    for table, schema in S.OP_SCHEMAS.items():
        for f in schema.fields:
            if not f.nullable:
                c = op_cols.get(table, {}).get(f.name, f.name)
                nulls.append(rule(table, f"{f.name} not null", f"{c} IS NOT NULL", op_src[table]))
    dups = []
    # A warehouse row stands for one natural key, whose source column tells whether the row's keys repeat.
    dw_src = {"etl_control": "(SELECT 1 AS k)", "dim_date": f"(SELECT d AS k FROM {dim_date} t)",
              "dim_branch": "(SELECT branch_id AS k FROM op_branch)", "dim_product": "(SELECT product_id AS k FROM op_product)",
              "dim_customer": "(SELECT customer_id AS k FROM op_customer)", "fact_sale_item": "(SELECT item_id AS k FROM fact)"}
    for name, key in quality.KEYS.items():
        table = name.split(".")[0]
        k = ", ".join(key)
        if table not in op_src:
            dups.append(f"SELECT '{table}' AS \"table\", 'unique {k}' AS rule, CAST(COUNT(*) AS BIGINT) AS n_bad "
                        f"FROM (SELECT k FROM {dw_src[table]} GROUP BY k HAVING COUNT(*) > 1)")
            continue
        dups.append(f"SELECT '{table}' AS \"table\", 'unique {k}' AS rule, CAST(COUNT(*) AS BIGINT) AS n_bad "
                    f"FROM (SELECT {k} FROM {op_src[table]} GROUP BY {k} HAVING COUNT(*) > 1)")

    def orphan(table, name, child, ckey, parent, pkey):
        return (f"SELECT '{table}' AS \"table\", '{name}' AS rule, CAST(COUNT(*) AS BIGINT) AS n_bad "
                f"FROM {child} c WHERE c.{ckey} IS NOT NULL AND c.{ckey} NOT IN (SELECT {pkey} FROM {parent})")

    def orphans(fact):
        return [
            orphan("sale", "branch_id -> branch", "op_sale", "branch_id", "op_branch", "branch_id"),
            orphan("sale", "customer_id -> customer", "op_sale", "customer_id", "op_customer", "customer_id"),
            orphan("sale_item", "sale_id -> sale", "op_item", "sale_id", "op_sale", "sale_id"),
            orphan("sale_item", "product_id -> product", "op_item", "product_id", "op_product", "product_id"),
            orphan("fact_sale_item", "date_sk -> dim_date", fact, "date", dim_date, "d"),
            orphan("fact_sale_item", "branch_sk -> dim_branch", fact, "branch_id", "op_branch", "branch_id"),
            orphan("fact_sale_item", "product_sk -> dim_product", fact, "product_id", "op_product", "product_id"),
            orphan("fact_sale_item", "customer_sk -> dim_customer", fact, "customer_id", "op_customer",
                   "customer_id"),
        ]

    dw_nulls = {
        "etl_control": {"process": "TRUE", "last_run": "TRUE", "updated_at": "TRUE"},
        "dim_date": {"date_sk": "d IS NOT NULL", "date": "d IS NOT NULL", "year": "d IS NOT NULL", "month_name": "d IS NOT NULL"},
        "dim_branch": {"branch_sk": "branch_id IS NOT NULL"}, "dim_product": {"product_sk": "product_id IS NOT NULL"},
        "dim_customer": {"customer_sk": "customer_id IS NOT NULL"},
        "fact_sale_item": {"date_sk": "date IS NOT NULL", "branch_sk": "branch_id IS NOT NULL", "product_sk": "product_id IS NOT NULL",
                           "gross": "gross_c IS NOT NULL", "discount": "disc_c IS NOT NULL", "net": "net_c IS NOT NULL",
                           "loaded_at": "TRUE", "sale_month": "date IS NOT NULL"}}
    dw_rows = {"etl_control": "(SELECT 1 AS k)", "dim_date": f"{dim_date} t", "dim_branch": "op_branch", "dim_product": "op_product",
               "dim_customer": "op_customer", "fact_sale_item": "fact"}
    for table, schema in S.DW_SCHEMAS.items():
        for f in schema.fields:
            if not f.nullable:
                ok = dw_nulls[table].get(f.name, f"{f.name} IS NOT NULL")
                nulls.append(rule(table, f"{f.name} not null", ok, dw_rows[table]))

    fact_duplicates = "SELECT 'fact_sale_item' AS \"table\", 'unique item_id' AS rule, CAST(COUNT(*) AS BIGINT) AS n_bad " \
        "FROM (SELECT item_id FROM {0} GROUP BY item_id HAVING COUNT(*) > 1)"

    def fact_rules(src):
        """All rules of the fact over the rows of ``src``."""
        about_fact = [q for q in domains + nulls if q.startswith("SELECT 'fact_sale_item'")]
        return "\nUNION ALL\n".join([q.removesuffix("FROM fact") + f"FROM {src}" for q in about_fact] + orphans(src)[4:]
                                    + [fact_duplicates.format(src)])

    defects = f""",
defects AS (SELECT * REPLACE (CASE WHEN year(date) = {BROKEN_YEAR} AND item_id % {DRIFT_BROKEN} = 0 THEN -1 ELSE product_id END AS product_id)
  FROM fact UNION ALL SELECT * FROM fact WHERE year(date) = {COPIED_YEAR} AND item_id % {DRIFT_COPY} = 0)
"""
    return {
        "dq_stored": BASE + INCR_CTES + fact_rules("incr"),
        "dq_stored_drift": BASE + defects + fact_rules("defects"),
        "dq_domains": BASE + "\nUNION ALL\n".join(domains),
        "dq_not_null": BASE + "\nUNION ALL\n".join(nulls),
        "dq_duplicates": BASE + "\nUNION ALL\n".join(dups),
        "dq_orphans": BASE + "\nUNION ALL\n".join(orphans("fact")),
        "dq_orphans_drift": BASE + "," + _dw_cte("broken") + "\n" + "\nUNION ALL\n".join(orphans("dwf")),
    }


def _seed_sql() -> dict[str, str]:
    stamp = f"'{SEED_AS_OF:%Y-%m-%d %H:%M:%S}'"
    cities = ", ".join(f"'{c}'" for c in seed.SEED_CITIES)
    prices = ", ".join(f"({i + 1}, {int(round(float(p) * 100))})" for i, (_, _, _, p) in enumerate(seed.SEED_PRODUCTS))
    sales = f"""seed_sale AS (
  SELECT gs AS sale_id, gs % 5 + 1 AS branch_id, gs % 20 + 1 AS customer_id,
         CAST(DATE '{SEED_AS_OF:%Y-%m-%d}' - CAST(gs % 20 AS INTEGER) AS TIMESTAMP) + INTERVAL 10 HOUR
           + to_minutes(CAST((gs % 9) * 45 AS BIGINT)) AS sold_at,
         CASE gs % 10 WHEN 0 THEN 'CANCELLED' WHEN 1 THEN 'PENDING' ELSE 'COMPLETED' END AS status,
         CASE WHEN gs % 10 IN (0, 1) THEN 'ONLINE' WHEN gs % 10 = 2 THEN 'PHONE' ELSE 'STORE' END AS channel
  FROM (SELECT o_orderkey + 1 AS gs FROM orders))"""
    return {
        "seed_customers": f"""SELECT c_custkey + 1 AS customer_id, 'Cliente ' || CAST(c_custkey + 1 AS VARCHAR) AS name,
       md5('cpf_fake_' || CAST(c_custkey + 1 AS VARCHAR)) AS doc_hash,
       ([{cities}])[CAST(1 + (c_custkey + 1) % 5 AS INTEGER)] AS city, 'SP' AS uf,
       {stamp} AS created_at, {stamp} AS updated_at FROM customer""",
        "seed_sales": f"""WITH {sales}
SELECT sale_id, CAST(branch_id AS BIGINT) AS branch_id, customer_id, CAST(sold_at AS VARCHAR) AS sold_at, status,
       channel, CAST(NULL AS VARCHAR) AS note, {stamp} AS created_at, {stamp} AS updated_at FROM seed_sale""",
        "seed_items": f"""WITH {sales},
price(product_id, list_c) AS (VALUES {prices}),
it AS (SELECT s.sale_id, s.status, i, s.sale_id + i AS k
       FROM seed_sale s, LATERAL (SELECT unnest(range(1, 2 + s.sale_id % 4)) AS i))
SELECT row_number() OVER (ORDER BY it.sale_id, i) AS item_id, it.sale_id, k % 12 + 1 AS product_id,
       CAST(1 + k % 3 AS BIGINT) AS qty, {_money('(p.list_c * (95 + k % 7) + 50) // 100')} AS unit_price,
       {_money("CASE WHEN status = 'COMPLETED' THEN CASE k % 6 WHEN 0 THEN 1500 WHEN 1 THEN 1000 WHEN 2 THEN 500 ELSE 0 END ELSE 0 END")}
         AS discount, {stamp} AS created_at, {stamp} AS updated_at
FROM it JOIN price p ON p.product_id = k % 12 + 1""",
    }


def oracle_sql() -> dict[str, str]:
    window_rows = f"""SELECT f.date, b.name AS branch, f.net_c FROM fact f JOIN op_branch b ON b.branch_id = f.branch_id
  {DAILY_WHERE}"""
    wide = ", ".join(f"{_money(f"COALESCE(SUM(net_c) FILTER (WHERE branch = '{b}'), 0)")} AS \"{b}\"" for b in BRANCHES)
    sql = {
        "kpi_daily_branch": BASE + DAILY_SELECT.format(where=""),
        "kpi_monthly_branch_category": BASE + MONTHLY_SELECT.format(where=""),
        "kpi_daily_range": BASE + DAILY_SELECT.format(where=DAILY_WHERE) + " ORDER BY 1, 2",
        "kpi_monthly_range": BASE + MONTHLY_SELECT.format(where=MONTHLY_WHERE) + " ORDER BY 1, 2, 3, 4",
        "report_daily_pivot": BASE + f"SELECT CAST(date AS VARCHAR) AS date, {wide} FROM ({window_rows}) GROUP BY 1 ORDER BY 1",
        "report_branch_total": BASE + f"SELECT branch, {_money('SUM(net_c)')} AS net FROM ({window_rows}) "
        "GROUP BY branch",
        "report_weekday_matrix": BASE + f"SELECT CAST(isodow(date) AS BIGINT) AS weekday, {wide} FROM ({window_rows}) GROUP BY 1 "
        "ORDER BY 1",
        "report_top_categories": BRAND + TOP_CELLS + f"SELECT period, category, {LABEL} AS label, {wide} FROM cells GROUP BY 1, 2 ORDER BY 1, 2",
        "report_stack_bases": BRAND + TOP_CELLS + f"""SELECT period, category, {LABEL} AS label, branch, {_money('net_c')} AS net,
       {_money("""COALESCE(SUM(net_c) OVER (PARTITION BY period, category ORDER BY branch
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)""")} AS base
FROM cells""",
        "item_count": _with(_op_cte()) + "SELECT COUNT(*) AS items FROM op_item",
        "sales_by_branch": _with(_op_cte()) + f"""SELECT b.name AS branch, COUNT(*) AS total_sales,
       {_money('SUM(ps.amount_c)')} AS revenue
FROM op_sale s LEFT JOIN (SELECT sale_id, SUM(qty * price_c - disc_c) AS amount_c FROM op_item GROUP BY sale_id) ps
  ON ps.sale_id = s.sale_id
JOIN op_branch b ON b.branch_id = s.branch_id GROUP BY b.name ORDER BY revenue DESC NULLS LAST, branch""",
        "status_histogram": _with(_op_cte()) + "SELECT status, COUNT(*) AS n FROM op_sale GROUP BY status",
        "branch_listing": _with(_op_cte()) + """SELECT CAST(branch_id AS BIGINT) AS branch_id, name, city, uf, active,
       CAST(created_at AS VARCHAR) AS created_at, CAST(updated_at AS VARCHAR) AS updated_at
FROM op_branch ORDER BY branch_id""",
        "dim_date": _with(_op_cte()) + """SELECT CAST(d AS VARCHAR) AS date, CAST(year(d) AS BIGINT) AS year,
       CAST(month(d) AS BIGINT) AS month, CAST(day(d) AS BIGINT) AS day, CAST(quarter(d) AS BIGINT) AS quarter,
       CAST(isodow(d) AS BIGINT) AS weekday, monthname(d) AS month_name
FROM (SELECT CAST(unnest(generate_series(min(CAST(sold_at AS DATE)), max(CAST(sold_at AS DATE)),
             INTERVAL 1 DAY)) AS DATE) AS d FROM op_sale)""",
        "dim_branch": _with(_op_cte()) + f"""SELECT CAST(branch_id AS BIGINT) AS branch_id, name, city, uf, active,
       '{LOAD_AS_OF:%Y-%m-%d %H:%M:%S}' AS updated_at FROM op_branch""",
        "dim_product": _with(_op_cte()) + f"""SELECT product_id, sku, name, category, active,
       '{LOAD_AS_OF:%Y-%m-%d %H:%M:%S}' AS updated_at FROM op_product""",
        "dim_customer": _with(_op_cte()) + f"""SELECT customer_id, city, uf,
       '{LOAD_AS_OF:%Y-%m-%d %H:%M:%S}' AS updated_at FROM op_customer""",
        "fact_first_load": BASE + FACT_NATURAL_SELECT.format(
            loaded=f"'{LOAD_AS_OF:%Y-%m-%d %H:%M:%S}'", src="fact"),
        "surrogate_keys": _with(_op_cte()) + """SELECT 'dim_date' AS "table", n AS n_rows, n AS n_keys,
       CAST(1 AS BIGINT) AS min_sk, n AS max_sk
FROM (SELECT CAST(date_diff('day', min(CAST(sold_at AS DATE)), max(CAST(sold_at AS DATE))) + 1 AS BIGINT) AS n
      FROM op_sale)
UNION ALL SELECT 'dim_branch', COUNT(*), COUNT(*), 1, COUNT(*) FROM op_branch
UNION ALL SELECT 'dim_product', COUNT(*), COUNT(*), 1, COUNT(*) FROM op_product
UNION ALL SELECT 'dim_customer', COUNT(*), COUNT(*), 1, COUNT(*) FROM op_customer""",
        "etl_control": _with(_op_cte()) + f"""SELECT '{S.PROCESS_NAME}' AS process, CAST(mark AS VARCHAR) AS last_run,
       (SELECT COUNT(*) FROM op_sale WHERE updated_at >= mark) AS sales_left
FROM (VALUES ({_ts(INCR_MARK)}), ({_ts(INCR_AS_OF)})) m(mark)""",
        "changed_range": _with(_op_cte()) + f"""SELECT CAST(min(sold_at) AS VARCHAR) AS min_sold_at,
       CAST(max(sold_at) AS VARCHAR) AS max_sold_at FROM op_sale WHERE updated_at >= {_ts(INCR_MARK)}""",
        "fact_incremental": BASE + INCR_CTES + FACT_NATURAL_SELECT.format(loaded="loaded", src="incr"),
        "dim_product_scd1": _with(_op_cte()) + f"""SELECT product_id, sku, name,
       CASE WHEN product_id % {NEW_CATEGORY_EVERY} = 0 THEN 'NEW' ELSE category END AS category, active,
       '{INCR_AS_OF:%Y-%m-%d %H:%M:%S}' AS updated_at, TRUE AS sk_kept FROM op_product""",
    }
    stamp = f"'{SEED_AS_OF:%Y-%m-%d %H:%M:%S}'"
    incr = BASE + INCR_CTES
    sql.update({
        "dim_customer_scd1": _with(_op_cte()) + f"""SELECT customer_id,
       CASE WHEN customer_id % {RELOCATE_EVERY} = 3 THEN 'MOVED' ELSE city END AS city, uf,
       '{INCR_AS_OF:%Y-%m-%d %H:%M:%S}' AS updated_at, TRUE AS sk_kept FROM op_customer""",
        "fact_moved": BASE + f""",
dated AS (SELECT * REPLACE (CAST(CASE WHEN sale_id % {MOVE_EVERY} = 0 THEN date + {MOVE_DAYS} ELSE date END AS DATE) AS date),
                 CASE WHEN sale_id % {MOVE_EVERY} = 0 THEN '{MOVE_AS_OF:%Y-%m-%d %H:%M:%S}'
                      ELSE '{LOAD_AS_OF:%Y-%m-%d %H:%M:%S}' END AS loaded FROM fact)
""" + FACT_NATURAL_SELECT.format(loaded="loaded", src="dated"),
        "kpi_stored_daily": incr + DAILY_SELECT.format(where="").replace("FROM fact f", "FROM incr f"),
        "kpi_stored_monthly": incr + MONTHLY_SELECT.format(where="").replace("FROM fact f", "FROM incr f").replace(
            "JOIN op_product p ON", f"JOIN (SELECT product_id, CASE WHEN product_id % {NEW_CATEGORY_EVERY} = 0 THEN 'NEW' "
            "ELSE category END AS category FROM op_product) p ON"),
        "kpi_quarter_city": incr + f"""SELECT CAST(year(f.date) AS BIGINT) AS year, CAST(quarter(f.date) AS BIGINT) AS quarter, b.city,
       {_money('SUM(f.net_c)')} AS net, COUNT(DISTINCT f.sale_id) AS n_sales, CAST(SUM(f.qty) AS BIGINT) AS units_sold
FROM incr f JOIN op_branch b ON b.branch_id = f.branch_id GROUP BY 1, 2, 3""",
        "lookup_counts": incr + ", " + """seen AS (
  SELECT 1 AS v, s.* FROM op_sale s WHERE s.status = 'COMPLETED' AND s.updated_at < """ + _ts(INCR_MARK) + """
  UNION ALL SELECT 2, s.sale_id, s.branch_id, s.customer_id, s.sold_at, s.status, NULL, NULL, s.updated_at
  FROM op_sale2 s WHERE s.status = 'COMPLETED' AND s.updated_at >= """ + _ts(INCR_MARK) + """),
found AS (SELECT v, s.sale_id, b.branch_id IS NOT NULL AS has_branch, c.customer_id IS NOT NULL AS has_customer FROM seen s
  LEFT JOIN op_branch b ON b.branch_id = s.branch_id LEFT JOIN op_customer c ON c.customer_id = s.customer_id),
items AS (SELECT v, p.product_id IS NOT NULL AS has_product FROM found f JOIN op_item i ON i.sale_id = f.sale_id
  LEFT JOIN op_product p ON p.product_id = i.product_id WHERE has_branch)
SELECT CAST(v AS BIGINT) AS version, counter, CAST(n AS BIGINT) AS n FROM (
  SELECT v, COUNT(*) AS sales_read, 0 AS sales_without_date, COUNT(*) FILTER (NOT has_branch) AS sales_without_branch,
         COUNT(*) FILTER (has_branch AND NOT has_customer) AS sales_without_customer FROM found GROUP BY v)
  UNPIVOT (n FOR counter IN (sales_read, sales_without_date, sales_without_branch, sales_without_customer))
UNION ALL SELECT CAST(v AS BIGINT), counter, CAST(n AS BIGINT) FROM (
  SELECT v, COUNT(*) AS items_read, COUNT(*) FILTER (NOT has_product) AS items_without_product,
         COUNT(*) FILTER (has_product) AS rows_loaded FROM items GROUP BY v)
  UNPIVOT (n FOR counter IN (items_read, items_without_product, rows_loaded))""",
        "fact_from_extract": BASE + f"""SELECT item_id, sale_id, CAST(qty AS BIGINT) AS qty, {_money('gross_c')} AS gross,
       {_money('disc_c')} AS discount, {_money('net_c')} AS net, CAST(year(date) * 100 + month(date) AS BIGINT) AS sale_month
FROM fact WHERE updated_at >= {_ts(INCR_MARK)}""",
        "appended_products": _with(_op_cte()) + f"""SELECT product_id, sku, name, category, {_money('list_c')} AS list_price,
       TRUE AS active, {stamp} AS created_at, {stamp} AS updated_at FROM op_product""",
        "report_written": sql["report_stack_bases"],
        "customer_positions": _with(_op_cte()) + """SELECT customer_id, name,
       row_number() OVER (ORDER BY name, customer_id) - 1 AS pos FROM op_customer""",
        "kpi_monthly_range_sql": sql["kpi_monthly_range"],
    })
    sql.update(_dq_sql())
    sql.update(_seed_sql())
    for name, kind in CHECK_DRIFT.items():
        sql[name] = _check_sql(name, None)
        sql[name + "_drift"] = _check_sql(name, kind)
    for name in INCREMENTAL_CHECKS:
        sql[name + "_incremental"] = _check_sql(name, "incremental")
    sql["kpi_daily_range_sql"] = sql["kpi_daily_range"]
    if llm is not None:
        sql.update(llm.ORACLES)
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
