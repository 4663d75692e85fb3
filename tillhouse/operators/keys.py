"""Surrogate keys, without single-task windows.

``assign_surrogate_keys`` gives new natural keys consecutive integer keys
``base + 1 .. base + n``:

1. bucket every new key by a hash of its natural key into B buckets
   (B = KEY_BUCKETS); natural keys are unique, so buckets are even
   and no bucket is hot;
2. count keys per bucket and turn the counts into bucket offsets with a
   running sum over the B count rows (a window over B rows, broadcast back);
3. key = base + offset[bucket] + row_number() within the bucket ordered by
   natural key (a window partitioned by bucket).

``base`` may be a scalar subquery (``max_key_of``), so the whole assignment
stays one lazy plan: no driver round trip.  Keys are dense and unique, and
they depend only on the set of new natural keys and ``base``: a recomputed
task, a different physical layout or a rerun after a failed load yields the
same keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "_sk_bucket"
_OFFSET = "_sk_offset"


def max_key_of(df: DataFrame, sk: str) -> Column:
    """Largest existing surrogate key (0 for an empty table) as a scalar subquery."""
    return df.agg(F.coalesce(F.max(sk).cast("long"), F.lit(0).cast("long"))).scalar()


KEY_BUCKETS = 1024     # fixed, so that keys do not depend on a session's settings


def assign_surrogate_keys(new_rows: DataFrame, order_cols: list[str], sk: str, base: int | Column,
                          sk_type: str = "long", buckets: int | None = None) -> DataFrame:
    """Add column ``sk`` with unique keys base+1 .. base+n (n = rows of ``new_rows``).

    ``order_cols`` must be unique in ``new_rows``.
    """
    n_buckets = buckets or KEY_BUCKETS
    # One exchange by bucket, shared by the per-bucket counts and the numbering.
    tagged = (new_rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*order_cols), F.lit(n_buckets)).cast("int"))
              .repartition(_BUCKET))
    running = Window.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (tagged.groupBy(_BUCKET).count()
               .select(_BUCKET, F.coalesce(F.sum("count").over(running), F.lit(0)).alias(_OFFSET)))
    w = Window.partitionBy(_BUCKET).orderBy(*order_cols)
    base_col = base if isinstance(base, Column) else F.lit(base)
    return (tagged.join(F.broadcast(offsets), _BUCKET)  # at most n_buckets rows
            .withColumn(sk, (base_col + F.col(_OFFSET) + F.row_number().over(w)).cast(sk_type))
            .drop(_BUCKET, _OFFSET))
