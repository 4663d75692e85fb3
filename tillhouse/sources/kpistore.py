"""Stored KPI tables, kept up by the difference between two versions of the warehouse.

Layout under the store's root::

    kpi_daily/sale_month=<m>/kv=<N>/      rows of the daily KPI view of one month
    kpi_monthly/sale_month=<m>/kv=<N>/    rows of the monthly KPI view of one month
    kpi_sales/sale_month=<m>/kv=<N>/      bitmaps of sale ids by month and branch
    kpi_manifest/v=<N>/                   (kpi, sale_month, fv, kv) and the names the rows were made with

A KPI row depends on one month of the fact, on branch names and (monthly) on
product categories.  ``refresh`` recomputes the months whose fact folder is
another one than the manifest says; all months if a branch is called
differently; and for the monthly table the months that sold a product whose
category has changed.  Other months keep their files.

Distinct sales do not add up over categories, months or branches.  Sets of
sale ids do: ``kpi_sales`` holds them as bitmaps (32,768 ids in 4 KB), so
``distinct_sales`` counts any coarser grouping exactly without the fact.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.dates import year_month
from tillhouse.functions.money import sum_money
from tillhouse.model import DwTables, empty, literal_rows
from tillhouse.plans import kpi
from tillhouse.session import sized_hash_joins
from tillhouse.sources.store import WarehouseStore

MANIFEST = T.StructType([
    T.StructField("kpi", T.StringType(), False), T.StructField("sale_month", T.IntegerType(), False),
    T.StructField("fv", T.LongType(), False), T.StructField("kv", T.LongType(), False),
    T.StructField("branches", T.LongType(), False),
])


def _daily(dw: DwTables) -> DataFrame:
    rows = kpi.kpi_daily_branch(dw)
    return rows.withColumn("sale_month", year_month(F.col("date")))


def _monthly(dw: DwTables) -> DataFrame:
    return kpi.kpi_monthly_branch_category(dw).withColumn("sale_month", (F.col("year") * 100 + F.col("month")).cast("int"))


def sale_bitmaps(fact: DataFrame) -> DataFrame:
    """Rows (sale_month, branch_sk, bucket, bits): which sales a branch had in a month."""
    return fact.groupBy("sale_month", "branch_sk", F.bitmap_bucket_number("sale_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("sale_id")).alias("bits"))


TABLES: dict[str, Callable[[DwTables], DataFrame]] = {
    "kpi_daily": _daily, "kpi_monthly": _monthly, "kpi_sales": lambda dw: sale_bitmaps(dw.fact_sale_item)}


def distinct_sales(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Exact number of distinct sales per ``keys``: bitmaps are united per bucket, then counted."""
    sets = bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return sets.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("n_sales"))


def _branch_names(dw: DwTables) -> int:
    """One number for what the branches are called."""
    named = F.xxhash64("branch_sk", "name", "city", "uf", F.col("city").isNull())
    return dw.dim_branch.agg(F.coalesce(F.bit_xor(named), F.lit(0).cast("long"))).first()[0]


class KpiStore:
    def __init__(self, store: WarehouseStore):
        self.store, self.root = store, store.root

    def manifest(self, spark: SparkSession, version: int) -> dict[str, dict[int, tuple]]:
        """kpi -> sale_month -> (fv, kv, branches); bounded by tables x months."""
        try:
            rows = spark.read.schema(MANIFEST).parquet(f"{self.root}/kpi_manifest/v={version}").collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = []
        out: dict[str, dict[int, tuple]] = {name: {} for name in TABLES}
        for r in rows:
            out[r["kpi"]][r["sale_month"]] = (r["fv"], r["kv"], r["branches"])
        return out

    def _months_of_changed_categories(self, spark: SparkSession, dw: DwTables, previous: int,
                                      entries: list[tuple[int, int]]) -> set[int]:
        """Months among ``entries`` that sold a product whose category is not what it was in version ``previous``."""
        old = self.store.read(spark, previous).dim_product.select("product_sk", F.col("category").alias("old"))
        changed = dw.dim_product.join(old, "product_sk").where(~F.col("category").eqNullSafe(F.col("old"))).select("product_sk")
        sold = self.store._fact_from(spark, entries).select("product_sk", "sale_month").distinct()
        return {r["sale_month"] for r in sold.join(changed, "product_sk", "left_semi").select("sale_month").distinct().collect()}

    def refresh(self, spark: SparkSession, version: int, previous: int | None = None) -> dict[str, list[int]]:
        """Bring the KPI tables from version ``previous`` to ``version``; returns the months recomputed per table."""
        dw = self.store.read(spark, version)
        folders = {r["sale_month"]: r["fv"] for r in self.store.manifest(spark, version).collect()}
        then = self.manifest(spark, previous) if previous is not None else {name: {} for name in TABLES}
        branches = _branch_names(dw)
        done, rows = {}, []
        for name, make in TABLES.items():
            kept = {m: e for m, e in then[name].items()
                    if folders.get(m) == e[0] and (name == "kpi_sales" or e[2] == branches)}
            if name == "kpi_monthly" and kept:
                for m in self._months_of_changed_categories(spark, dw, previous, [(m, e[0]) for m, e in kept.items()]):
                    del kept[m]
            months = sorted(folders.keys() - kept.keys())
            if months:
                part = self.store._fact_from(spark, [(m, folders[m]) for m in months])
                out = make(dw.with_(fact_sale_item=part)).withColumn("kv", F.lit(version).cast("long"))
                with sized_hash_joins(spark):
                    (out.hint("rebalance", "sale_month").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                     .partitionBy("sale_month", "kv").parquet(f"{self.root}/{name}"))
            done[name] = months
            rows += [(name, m, e[0], e[1], e[2]) for m, e in sorted(kept.items())]
            rows += [(name, m, folders[m], version, branches) for m in months]
        literal_rows(spark, rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/kpi_manifest/v={version}")
        return done

    def _read(self, spark: SparkSession, name: str, version: int) -> DataFrame:
        schema = T.StructType([f for f in TABLES[name](DwTables.empty(spark)).schema.fields if f.name != "sale_month"])
        schema = T.StructType(schema.fields + [T.StructField("sale_month", T.IntegerType()), T.StructField("kv", T.LongType())])
        entries = self.manifest(spark, version)[name]
        if not entries:
            return empty(spark, schema).drop("kv")
        paths = [f"{self.root}/{name}/sale_month={m}/kv={kv}" for m, (_, kv, _) in sorted(entries.items())]
        return spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*paths).drop("kv")

    def daily(self, spark: SparkSession, version: int, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
        """The daily KPI of a version; a range prunes months, then rows."""
        rows = self._read(spark, "kpi_daily", version)
        if first is not None and last is not None:
            rows = rows.where(F.col("sale_month").between(first.year * 100 + first.month, last.year * 100 + last.month)
                              & F.col("date").between(F.lit(first), F.lit(last)))
        return rows.select(*kpi.DAILY_COLUMNS)

    def monthly(self, spark: SparkSession, version: int) -> DataFrame:
        return self._read(spark, "kpi_monthly", version).select(*kpi.MONTHLY_COLUMNS)

    def rollup(self, spark: SparkSession, version: int, period: Column, *by: str) -> DataFrame:
        """net, n_sales and units_sold per ``period`` (an expression over sale_month) and branch columns ``by``; no fact is read."""
        sold = self._read(spark, "kpi_daily", version).withColumn("period", period)
        sums = sold.groupBy("period", *by).agg(sum_money(F.col("net")).alias("net"), F.sum("units_sold").cast("long").alias("units_sold"))
        branch = self.store.read(spark, version).dim_branch.select("branch_sk", F.col("name").alias("branch"), "city", "uf")
        sets = self._read(spark, "kpi_sales", version).join(branch, "branch_sk").withColumn("period", period)
        counts = distinct_sales(sets, ["period", *by])
        same = [sums[c].eqNullSafe(counts[c]) for c in ("period", *by)]
        on = same[0]
        for c in same[1:]:
            on = on & c
        return sums.join(counts, on).select(*[sums[c] for c in ("period", *by)], "net", "n_sales", "units_sold")


def quarter_of(sale_month: str = "sale_month") -> Column:
    """yyyyq from yyyymm."""
    m = F.col(sale_month)
    return (F.floor(m / 100) * 10 + F.ceil((m % 100) / 3)).cast("int")
