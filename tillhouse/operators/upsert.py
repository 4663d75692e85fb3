"""Keyed write semantics on immutable DataFrames.

Parquet has no MERGE, so each operation returns the new table content:

* ``insert_if_absent``  - INSERT ... ON CONFLICT (key) DO NOTHING
* ``upsert_scd1``       - INSERT ... ON CONFLICT (key) DO UPDATE (type-1 dimension)
* ``upsert_by_key``     - keyed replace of fact rows (idempotent load)

Matching is a join on the natural key; the target's surrogate keys are kept
for matched rows and new keys are assigned only to unseen natural keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.model import conform
from tillhouse.operators.keys import assign_surrogate_keys, max_key_of


def insert_if_absent(target: DataFrame, source: DataFrame, key: str, sk: str | None = None,
                     sk_type: str = "long", schema=None) -> DataFrame:
    """Rows of ``source`` whose ``key`` is not in ``target`` are appended.

    Duplicate keys inside ``source`` are dropped first (the first conflicting
    insert wins, later ones are ignored).
    """
    new = source.dropDuplicates([key]).join(target.select(key), key, "left_anti")
    if sk is not None:
        new = assign_surrogate_keys(new, [key], sk, max_key_of(target, sk), sk_type)
    out = target.unionByName(new.select(*target.columns))
    return conform(out, schema) if schema is not None else out


def upsert_scd1(target: DataFrame, source: DataFrame, key: str, sk: str, sk_type: str = "long",
                schema=None, base: int | None = None) -> DataFrame:
    """Type-1 upsert of a dimension.

    matched source rows  -> source attributes, target surrogate key kept
    new source rows      -> new surrogate keys (``base``, by default the target's largest, + rank by natural key)
    target-only rows     -> kept unchanged

    ``source`` must be unique on ``key`` (its primary key; ``quality.duplicate_keys``
    checks it) - an upsert cannot update the same target row twice.
    """
    joined = target.alias("t").join(source.withColumn("__in_source", F.lit(True)).alias("s"),
                                    F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")

    def merged(c: str):
        if c == key:
            return F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}")).alias(c)
        if c == sk or c not in source.columns:
            return F.col(f"t.{c}").alias(c)
        return F.when(F.col("s.__in_source"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)

    rows = joined.select([merged(c) for c in target.columns])
    new = assign_surrogate_keys(rows.where(F.col(sk).isNull()).drop(sk), [key], sk,
                                max_key_of(target, sk) if base is None else base, sk_type)
    out = rows.where(F.col(sk).isNotNull()).unionByName(new.select(*target.columns))
    return conform(out, schema) if schema is not None else out


def upsert_by_key(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Replace target rows whose ``key`` appears in ``source``; append the rest.

    ``source`` must be unique on ``key`` (the operational primary key).  The
    anti join shuffles on ``key``; when the source is small AQE turns it into
    a broadcast anti join and the target is streamed once without a shuffle.
    """
    kept = target.join(source.select(key), key, "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))
