"""Persisting and publishing the warehouse (parquet on shared storage).

Layout under ``root``::

    <table>/v=<N>/                               control row and date dimension, one folder per version
    <dim>/bucket=<b>/dv=<N>/, <dim>_manifest/    type-1 dimensions by hash bucket (``dimstore``)
    fact_sale_item/sale_month=<yyyymm>/fv=<N>/   fact rows of one month as written by load N
    fact_manifest/v=<N>/                         (sale_month, fv): the month folders of version N
    fact_summary/v=<N>/, fact_filter/v=<N>/      where item ids may be stored (``locator``)
    fact_rules/v=<N>/                            rule violations of the fact by month (``rulestore``)
    fact_lookups/v=<N>/                          what the load's lookups read and lost (counter, n)
    _commits/                                    one row per published version

A load writes new dimension versions first, then the fact months it touches
as new ``fv=N`` partitions, then the manifest of version N (months it did not
touch keep pointing at older ``fv`` folders), the control row, and finally
appends the commit row.  Readers take a committed version and read exactly
the month folders its manifest lists, so a reader never sees half a load,
older versions stay readable, and no job ever overwrites a folder somebody
reads.  An incremental load costs O(touched months), not O(fact), and
dimension buckets without a changed row keep their files.

Recovery is a rerun: the mark moves only with the commit, the fact load is a
keyed upsert, and surrogate keys are a pure function of the new natural keys,
so a rerun writes the same rows (replacing its own uncommitted ``fv=N``
folders); folders of a failed attempt that no manifest lists are never read.
"""

from __future__ import annotations

import datetime as dt
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse import schemas as S
from tillhouse.model import DwTables, OpTables, conform, empty, literal_rows
from tillhouse.operators.upsert import upsert_by_key
from tillhouse.plans.etl import EtlRun, LookupCounts, run_etl
from tillhouse.session import scratch_path, sized_hash_joins, unsorted_buckets
from tillhouse.sources.dimstore import BUCKET_ROWS, DimensionStore
from tillhouse.sources.locator import Locator

FACT = "fact_sale_item"
BUCKETED = ("dim_branch", "dim_product", "dim_customer")
MANIFEST = "fact_manifest"
FACT_VERSION = "fv"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("sale_month", T.IntegerType(), False),
    T.StructField(FACT_VERSION, T.LongType(), False),
])
LOOKUPS = T.StructType([T.StructField("counter", T.StringType(), False), T.StructField("n", T.LongType(), False)])
COMMITS = T.StructType([
    T.StructField("version", T.LongType(), False),
    T.StructField("as_of", S.NTZ, False),
    T.StructField("loaded", T.BooleanType(), False),
])


def _missing_path(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(getattr(e, "getCondition", lambda: "")() or "") or "does not exist" in str(e)


def parquet_stage(name: str, df: DataFrame) -> DataFrame:
    """ETL stage that writes the table to the shared folder and reads it back: prunable, and of known size."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with sized_hash_joins(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed_stage(name: str, df: DataFrame, key: str, buckets: int) -> DataFrame:
    """``parquet_stage`` in hash buckets of ``key``: joins and groups on it need no exchange of these rows.

    Rows that already lie in ``buckets`` partitions by ``key`` make one file a
    bucket, without a sort.  The catalog entry is dropped at once: the frame is resolved, and
    an external table's files stay.
    """
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    path = scratch_path(spark, table)
    try:
        with sized_hash_joins(spark), unsorted_buckets(spark):
            df.write.bucketBy(buckets, key).option("path", path).saveAsTable(table, format="parquet")
        return spark.table(table)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


def persist_op(op: OpTables, item_buckets: int | None = None) -> OpTables:
    """The tables staged, side by side; with ``item_buckets``, the items in so many buckets of their sale."""
    def staged(name: str) -> DataFrame:
        if name == "sale_item" and item_buckets is not None:
            return bucketed_stage(name, op.sale_item, "sale_id", item_buckets)
        return parquet_stage(name, getattr(op, name))

    names = ("sale_item", "sale", "customer", "product", "branch")
    with sized_hash_joins(op.sale.sparkSession), ThreadPoolExecutor(len(names)) as pool:
        return OpTables(**dict(zip(names, pool.map(staged, names), strict=True)))


class WarehouseStore:
    def __init__(self, root: str, dim_bucket_rows: int = BUCKET_ROWS):
        self.root = root.rstrip("/")
        self.dims = {name: DimensionStore(self.root, name, dim_bucket_rows) for name in BUCKETED}
        self.locator = Locator(self.root)

    def _path(self, *parts) -> str:
        return "/".join([self.root, *parts])

    # --- reading --------------------------------------------------------

    def versions(self, spark: SparkSession) -> list[int]:
        try:
            rows = spark.read.schema(COMMITS).parquet(self._path("_commits")).select("version").collect()
        except AnalysisException as e:
            if _missing_path(e):  # no commit yet
                return []
            raise
        return sorted(int(r[0]) for r in rows)

    def _read_table(self, spark: SparkSession, name: str, version: int) -> DataFrame:
        if name in self.dims:
            return self.dims[name].read(spark, version)
        schema = S.DW_SCHEMAS[name]
        return conform(spark.read.schema(schema).parquet(self._path(name, f"v={version}")), schema)

    def manifest(self, spark: SparkSession, version: int) -> DataFrame:
        try:
            return spark.read.schema(MANIFEST_SCHEMA).parquet(self._path(MANIFEST, f"v={version}"))
        except AnalysisException as e:
            if _missing_path(e):
                return empty(spark, MANIFEST_SCHEMA)
            raise

    def _fact_from(self, spark: SparkSession, entries: list[tuple[int, int]]) -> DataFrame:
        """Fact rows of the given (month, fact version) folders."""
        if not entries:
            return empty(spark, S.FACT_SALE_ITEM)
        paths = [self._path(FACT, f"sale_month={m}", f"{FACT_VERSION}={v}") for m, v in sorted(entries)]
        schema = T.StructType(S.FACT_SALE_ITEM.fields + [T.StructField(FACT_VERSION, T.LongType())])
        df = spark.read.schema(schema).option("basePath", self._path(FACT)).parquet(*paths)
        return conform(df, S.FACT_SALE_ITEM)

    def read_fact(self, spark: SparkSession, version: int) -> DataFrame:
        """The fact of a version: the month folders its manifest lists (bounded by the calendar)."""
        rows = self.manifest(spark, version).collect()
        return self._fact_from(spark, [(r["sale_month"], r[FACT_VERSION]) for r in rows])

    def read(self, spark: SparkSession, version: int | None = None) -> DwTables:
        """All tables of a committed version (latest by default)."""
        vs = self.versions(spark)
        if not vs:
            return DwTables.empty(spark)
        v = vs[-1] if version is None else version
        if v not in vs:
            raise ValueError(f"version {v} is not committed")
        tables = {name: self._read_table(spark, name, v) for name in S.DW_SCHEMAS if name != FACT}
        return DwTables(**tables, fact_sale_item=self.read_fact(spark, v))

    # --- writing --------------------------------------------------------

    def write_table(self, name: str, df: DataFrame, version: int) -> None:
        df.write.mode("overwrite").parquet(self._path(name, f"v={version}"))

    def merge_fact(self, target: DataFrame, source: DataFrame, previous: list[tuple[int, int]],
                   version: int) -> tuple[DataFrame, list[tuple[int, int]]]:
        """Upsert ``source`` into the fact of ``previous`` (month, fv) folders.

        Touched months: months of the source rows, plus months of stored rows
        whose item id is in the source (an item moves when its sale date
        changes; ``stored_elsewhere`` finds them).  The touched months are
        rewritten as ``fv=version`` folders (dynamic partition overwrite
        replaces only those, e.g. the leftovers of a failed attempt); the
        others are carried over by reference in the returned manifest.
        """
        spark = source.sparkSession
        if not previous:  # a first load writes its source as it is
            self._write_fact(source, version)
            months = self._fact_from_root(spark).where(F.col(FACT_VERSION) == version).select("sale_month").distinct().collect()
            entries = [(m, version) for m in sorted(r[0] for r in months)]
            self._locate(spark, entries, version)
            return self._fact_from(spark, entries), entries
        src = parquet_stage("fact_source", source)
        months = {r[0] for r in src.select("sale_month").distinct().collect()}
        if not months:  # nothing to load
            return target, previous
        moved = self.stored_elsewhere(src, previous)
        months = sorted(months | {r[0] for r in moved.select("sale_month").distinct().collect()})
        part = self._fact_from(spark, [(m, v) for m, v in previous if m in months])
        self._write_fact(upsert_by_key(part, src, "item_id"), version)
        touched = [(m, version) for m in months]
        self._locate(spark, touched, version)
        entries = [(m, v) for m, v in previous if m not in months] + touched
        return self._fact_from(spark, entries), entries

    def holding(self, ids: DataFrame, entries: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """The folders among ``entries`` that may hold an id of ``ids`` (item_id, sale_month) from another month.

        Named by the locator.  Where there are more (id, folder) pairs than
        the folders have items, all are named: reading one column is less work.
        """
        stored = self.locator.summary(ids.sparkSession, entries).agg(F.sum("n_items")).first()[0] or 0
        return self.locator.lookup(ids, entries) if ids.count() * len(entries) <= stored else entries

    def stored_elsewhere(self, source: DataFrame, entries: list[tuple[int, int]]) -> DataFrame:
        """Stored rows (item_id, sale_month) of the source's items in other months than the source gives them.

        Only the files of the folders that may hold such an item are read.
        """
        ids = source.select("item_id", "sale_month")
        folders = self.holding(ids, entries)
        own = ids.withColumnRenamed("sale_month", "own")
        rows = self._fact_from(source.sparkSession, folders).select("item_id", "sale_month").join(own, "item_id")
        return rows.where("own <> sale_month").select("item_id", "sale_month")

    def _locate(self, spark: SparkSession, entries: list[tuple[int, int]], version: int) -> None:
        """Write the locator of the folders that this load wrote."""
        if entries:
            paths = [self._path(FACT, f"sale_month={m}", f"{FACT_VERSION}={v}") for m, v in entries]
            rows = spark.read.schema("item_id long, sale_month int, fv long").option("basePath", self._path(FACT)).parquet(*paths)
            self.locator.write(rows, version)

    def _write_fact(self, rows: DataFrame, version: int) -> None:
        rows = (rows.withColumn(FACT_VERSION, F.lit(version).cast("long"))
                .hint("rebalance", "sale_month").sortWithinPartitions("sale_month", "item_id"))
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("sale_month", FACT_VERSION).parquet(self._path(FACT)))

    def _fact_from_root(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType(S.FACT_SALE_ITEM.fields + [T.StructField(FACT_VERSION, T.LongType())])
        return spark.read.schema(schema).parquet(self._path(FACT))

    def commit(self, spark: SparkSession, version: int, as_of: dt.datetime, loaded: bool) -> None:
        row = literal_rows(spark, [(version, as_of, loaded)], COMMITS)
        row.coalesce(1).write.mode("append").parquet(self._path("_commits"))

    def run(self, op: OpTables, as_of: dt.datetime, initial_mark: dt.datetime = S.DEFAULT_LAST_RUN,
            since: dt.datetime | None = None) -> EtlRun:
        """One ETL run against the latest committed version; publishes N+1.

        A run that finds nothing to load publishes nothing when the control
        row already exists.
        """
        spark = op.sale.sparkSession
        vs = self.versions(spark)
        version = (vs[-1] if vs else 0) + 1
        current = self.read(spark)
        previous = ([(r["sale_month"], r[FACT_VERSION]) for r in self.manifest(spark, vs[-1]).collect()]
                    if vs else [])
        written: set[str] = {FACT}
        manifest: list[list[tuple[int, int]]] = [previous]

        def stage(name: str, df: DataFrame) -> DataFrame:
            self.write_table(name, df, version)
            written.add(name)
            return self._read_table(spark, name, version)

        def merge(target: DataFrame, source: DataFrame) -> DataFrame:
            fact, manifest[0] = self.merge_fact(target, source, previous, version)
            return fact

        def merge_dimension(name: str, source: DataFrame) -> DataFrame:
            self.dims[name].upsert(source, vs[-1] if vs else None, version, as_of)
            written.add(name)
            return self._read_table(spark, name, version)

        counts = LookupCounts(spark)
        with sized_hash_joins(spark):
            result = run_etl(op, current, as_of, initial_mark=initial_mark, stage=stage, merge_fact=merge,
                             merge_dimension=merge_dimension, since=since, counts=counts)
        if not result.loaded and vs:
            return EtlRun(current, result.last_run, None, as_of)
        for name, df in result.dw.items():
            if name in written:
                continue
            if name in self.dims:  # a first, empty version
                self.dims[name].write_manifest(spark, version, None)
            else:  # carried over unchanged (or first, empty version)
                self.write_table(name, df, version)
        literal_rows(spark, manifest[0], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            self._path(MANIFEST, f"v={version}"))
        lookups = counts.get() if result.loaded else None
        if lookups:
            literal_rows(spark, list(lookups.items()), LOOKUPS).coalesce(1).write.mode("overwrite").parquet(
                self._path("fact_lookups", f"v={version}"))
        self.commit(spark, version, as_of, result.loaded)
        return EtlRun(self.read(spark, version), result.last_run, result.changed, as_of, lookups)

    def replace_months(self, rows: DataFrame, as_of: dt.datetime) -> int:
        """Publish a version whose months in ``rows`` (fact rows) hold exactly these rows; all else is carried over.

        For corrections that do not come from the operational tables; the
        mark stays where it is.  Returns the version.
        """
        spark = rows.sparkSession
        last = self.versions(spark)[-1]
        version = last + 1
        rows = parquet_stage("months", conform(rows, S.FACT_SALE_ITEM))
        months = sorted(r[0] for r in rows.select("sale_month").distinct().collect())
        self._write_fact(rows, version)
        self._locate(spark, [(m, version) for m in months], version)
        for name in S.DW_SCHEMAS:
            if name in self.dims:
                self.dims[name].write_manifest(spark, version, self.dims[name].manifest(spark, last))
            elif name != FACT:
                self.write_table(name, self._read_table(spark, name, last), version)
        entries = [(r["sale_month"], r[FACT_VERSION]) for r in self.manifest(spark, last).collect() if r["sale_month"] not in months]
        entries += [(m, version) for m in months]
        literal_rows(spark, entries, MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(self._path(MANIFEST, f"v={version}"))
        self.commit(spark, version, as_of, False)
        return version

    def lookup_counts(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """Rows (version, counter, n) of the loads: all of them, or one."""
        vs = [v for v in self.versions(spark) if version in (None, v)]
        kept = spark.read.schema(COMMITS).parquet(self._path("_commits")).where("loaded").select("version")
        loaded = [r["version"] for r in kept.collect() if r["version"] in vs]       # one row per load
        frames = [spark.read.schema(LOOKUPS).parquet(self._path("fact_lookups", f"v={v}")).select(F.lit(v).cast("long").alias("version"), "*")
                  for v in sorted(loaded)]
        return reduce(DataFrame.unionByName, frames) if frames else empty(spark, LOOKUPS)
