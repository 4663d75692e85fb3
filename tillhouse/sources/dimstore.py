"""Type-1 dimensions stored in hash buckets of the natural key.

Layout under the store's root::

    <dim>/bucket=<b>/dv=<N>/      rows of one bucket as written by load N
    <dim>_manifest/v=<N>/         one row per bucket: its dv, counts and fingerprint

A load computes one fingerprint per bucket of its source - row count, sum and
xor of two row hashes over the key and the attributes - in one partial
aggregate, and compares it with the manifest.  Buckets whose source is as it
was are carried over by reference; nothing of them is read or written.  Only
the others are joined with their source rows and written anew.

An upsert stamps every row that is in the source with the run's time, changed
or not.  Rows therefore carry a flag ``in_source`` and the manifest carries
the run's stamp: a reader shows the stamp for flagged rows and the stored time
for the rest (rows that have left the source), so a stamp rewrites no file.

The number of buckets is fixed by the first load: one for every ``bucket_rows``
rows, but at most MAX_BUCKETS, beyond which buckets hold more rows instead.
Manifest rows, folders and files of a load are bounded by it, whatever the
table's size.  New surrogate keys continue from the largest key, which the
manifest keeps as well.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse import schemas as S
from tillhouse.functions.dates import ntz
from tillhouse.model import conform, empty, literal_rows
from tillhouse.operators.upsert import upsert_scd1

BUCKET_ROWS = 1_000_000
MAX_BUCKETS = 128       # a bucket is a folder, a manifest row and a path of every read
IN_SOURCE = "in_source"
MANIFEST = T.StructType([
    T.StructField("buckets", T.IntegerType(), False), T.StructField("stamp", S.NTZ, False),
    T.StructField("bucket", T.IntegerType(), False), T.StructField("dv", T.LongType(), False),
    T.StructField("n_rows", T.LongType(), False), T.StructField("max_sk", T.LongType(), False),
    T.StructField("n_source", T.LongType(), False),
    T.StructField("sum_hash", T.DecimalType(38, 0), False), T.StructField("xor_hash", T.LongType(), False),
])


@dataclass(frozen=True)
class Bucket:
    dv: int
    n_rows: int
    max_sk: int
    source: tuple       # n_source, sum_hash, xor_hash


@dataclass(frozen=True)
class Manifest:
    buckets: int
    stamp: dt.datetime
    entries: dict[int, Bucket]

    @property
    def max_sk(self) -> int:
        return max((b.max_sk for b in self.entries.values()), default=0)


NO_SOURCE = (0, 0, 0)


def row_hash(columns: list[str], salt: int) -> Column:
    """64-bit hash of the columns; nulls are told apart by their place."""
    return F.xxhash64(F.lit(salt), *[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns])


class DimensionStore:
    def __init__(self, root: str, name: str, bucket_rows: int = BUCKET_ROWS):
        self.root, self.name, self.bucket_rows = root.rstrip("/"), name, bucket_rows
        self.schema = S.DW_SCHEMAS[name]
        self.key, self.sk = S.DIM_KEYS[name]
        self.stored = T.StructType(self.schema.fields + [T.StructField(IN_SOURCE, T.BooleanType())])

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/{self.name}_manifest/v={version}"

    def manifest(self, spark: SparkSession, version: int) -> Manifest | None:
        """The buckets of a version; None if it has none."""
        try:
            rows = spark.read.schema(MANIFEST).parquet(self._manifest_path(version)).collect()
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e):
                return None
            raise
        if not rows:
            return None
        entries = {r["bucket"]: Bucket(r["dv"], r["n_rows"], r["max_sk"], (r["n_source"], int(r["sum_hash"]), r["xor_hash"])) for r in rows}
        return Manifest(rows[0]["buckets"], rows[0]["stamp"], entries)

    def write_manifest(self, spark: SparkSession, version: int, m: Manifest | None) -> None:
        rows = [] if m is None else [(m.buckets, m.stamp, b, e.dv, e.n_rows, e.max_sk, e.source[0], str(e.source[1]), e.source[2])
                                     for b, e in sorted(m.entries.items())]
        literal_rows(spark, rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(self._manifest_path(version))

    def _folders(self, spark: SparkSession, m: Manifest, buckets: list[int]) -> DataFrame:
        """Stored rows of the given buckets, times as of the manifest's stamp."""
        paths = [f"{self.root}/{self.name}/bucket={b}/dv={m.entries[b].dv}" for b in buckets if m.entries[b].n_rows]
        if not paths:
            return empty(spark, self.schema)
        df = spark.read.schema(self.stored).parquet(*paths)
        seen = F.when(F.col(IN_SOURCE), ntz(m.stamp)).otherwise(F.col("updated_at"))
        return conform(df.withColumn("updated_at", seen), self.schema)

    def read(self, spark: SparkSession, version: int) -> DataFrame:
        m = self.manifest(spark, version)
        return empty(spark, self.schema) if m is None else self._folders(spark, m, sorted(m.entries))

    def upsert(self, source: DataFrame, previous: int | None, version: int, as_of: dt.datetime) -> list[int]:
        """Type-1 upsert into the buckets of version ``previous``; returns the buckets that were rewritten."""
        spark = source.sparkSession
        old = self.manifest(spark, previous) if previous is not None else None
        buckets = old.buckets if old else min(MAX_BUCKETS, max(1, -(-source.count() // self.bucket_rows)))
        attributes = [c for c in source.columns if c != "updated_at"]
        source = source.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int"))
        prints = {r["bucket"]: (r["n"], int(r["s"]), r["x"]) for r in source.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"), F.sum(row_hash(attributes, 1).cast("decimal(20,0)")).alias("s"),
            F.bit_xor(row_hash(attributes, 2)).alias("x")).collect()}       # at most one row per bucket
        entries = dict(old.entries) if old else {}
        touched = sorted(b for b in prints.keys() | entries.keys()
                         if prints.get(b, NO_SOURCE) != (entries[b].source if b in entries else NO_SOURCE))
        if touched:
            target = self._folders(spark, old, [b for b in touched if b in entries]) if old else empty(spark, self.schema)
            rows = upsert_scd1(target.withColumn(IN_SOURCE, F.lit(False)),
                               source.where(F.col("bucket").isin(touched)).drop("bucket").withColumn(IN_SOURCE, F.lit(True)),
                               self.key, self.sk, self.schema[self.sk].dataType.simpleString(), self.stored,
                               base=old.max_sk if old else 0)
            rows = (rows.withColumn("bucket", F.pmod(F.xxhash64(self.key), F.lit(buckets)).cast("int"))
                    .withColumn("dv", F.lit(version).cast("long")).hint("rebalance", "bucket"))
            (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "dv")
             .parquet(f"{self.root}/{self.name}"))
            written = (spark.read.schema(self.stored).option("basePath", f"{self.root}/{self.name}")
                       .parquet(*[f"{self.root}/{self.name}/bucket={b}/dv={version}" for b in touched])
                       .groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max(self.sk).cast("long").alias("m")).collect())
            counts = {r["bucket"]: (r["n"], r["m"]) for r in written}
            for b in touched:
                n, top = counts.get(b, (0, 0))
                entries[b] = Bucket(version, n, top, prints.get(b, NO_SOURCE))
        self.write_manifest(spark, version, Manifest(buckets, as_of, entries) if entries else None)
        return touched
