"""SimHash near-duplicates by vantage-point trees over Hamming space.

Fingerprints: 64-bit majority votes over the XXH64 hashes of a document's
word shingles.  Links: fingerprints that differ in at most ``max_bits`` = 3
bits; groups are the connected components.

Search.  A pair at distance <= 3 differs by at most one bit in one of its two
32-bit halves, so one vantage-point tree is kept per half and searched with
radius 1.  Level k of a tree looks at one block of the half and measures its
Hamming distance to that block of the vantage point; the path of distances is
the shard (a ring of each level).  By the triangle inequality, two
fingerprints within radius 1 have paths that differ by at most 1 in total, so
a fingerprint is searched in its home shard and in those boundary shards that
are one farther at one level; all other branches are pruned.  A shard that
counts more than SHARD_ROWS rows is divided by blocks of half the width (one
bit more or less in the wide block is one more or less in just one of the
narrow ones, so homes and guests stay what they were), down to single bits,
where a shard is one value of the half; what is still too full is cut into
parts, a task for each two.  Inside a task every candidate's full 64-bit
distance is verified, in blocks, and only a spanning forest of the links
leaves it - never all pairs.

Edge cases: null and empty texts have fingerprint 0 and link like any other;
a document without id gets its group's smallest id (null if none has one);
repeated rows give repeated result rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import components, merge_labels, stage, text_bytes

SHINGLE = 3
MAX_BITS = 3
SEED = 42
VANTAGE = 0x9D3A5C07E16B42F8    # the vantage point; any constant gives the same links
SHARD_ROWS = 20_000             # a shard with more rows goes one depth down
BLOCK = 1024


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    words = text.lower().split()            # bytes: A-Z only; splits at \x20 \x09-\x0D
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(accumulate(len(w) + 1 for w in words))
    x = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([x(line, SEED)], dtype=np.uint64)
    else:
        starts = [0, *ends]
        hashes = np.fromiter((x(line[a:b - 1], SEED) for a, b in zip(starts, ends[shingle - 1:])),
                             dtype=np.uint64, count=len(words) - shingle + 1)
    votes = np.zeros(64, dtype=np.int64)
    for k in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[k:k + 4096].astype("<u8").view(np.uint8), bitorder="little")
        votes += bits.reshape(-1, 64).sum(axis=0, dtype=np.int32)
    high = np.flatnonzero(2 * votes > len(hashes))
    return sum(1 << int(k) for k in high)


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Rows (doc_id, key, fp): key is a hash of the text, fp the fingerprint's bits as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, shingle) for t in text_bytes(b.column(2))], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))], ["doc_id", "key", "fp"])

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, key long, fp long")


def _rings(x: F.Column, width: int) -> F.Column:
    """Rings of blocks of 2 * ``width`` bits, from those of ``width`` bits, each in its block's place."""
    low = F.lit(sum(((1 << width) - 1) << k for k in range(0, 32, 2 * width)))
    return x.bitwiseAND(low) + F.shiftright(x, width).bitwiseAND(low)


def _shards(fps: DataFrame, block_bits: int) -> DataFrame:
    """Rows (shard, parent, guest, fp): each fingerprint at home and as a guest of its boundary shards, for both halves.

    The parent is the shard's place one depth up, in the tree with blocks twice as wide: there a ring is the sum of two rings.
    """
    off = F.col("fp").bitwiseXOR(F.lit(VANTAGE - (1 << 64)))
    rows = fps.select("fp", F.explode(F.array(*(F.struct(F.lit(h).alias("half"), F.shiftrightunsigned(off, 32 * h).bitwiseAND(
        F.lit((1 << 32) - 1)).alias("home")) for h in (0, 1)))).alias("p")).select("fp", "p.half", "p.home")
    width = 1
    while width < block_bits:
        rows, width = rows.withColumn("home", _rings(F.col("home"), width)), 2 * width
    rows = rows.withColumn("parent", _rings(F.col("home"), width))
    rows = rows.select("*", F.explode(F.sequence(F.lit(-1), F.lit(32 // width - 1))).alias("k"))     # -1: at home
    ring = F.expr(f"shiftright(home, {width} * k) & {(1 << width) - 1}")
    rows = rows.where((F.col("k") < 0) | (ring < width))
    farther, above = F.expr(f"shiftleft(1L, {width} * k)"), F.expr(f"shiftleft(1L, {2 * width} * cast(k div 2 as int))")
    tree = F.col("half").cast("long") * F.lit(1 << 40)
    guest = F.col("k") >= 0
    return rows.select((tree + F.col("home") + F.when(guest, farther).otherwise(0)).alias("shard"),
                       (tree + F.col("parent") + F.when(guest, above).otherwise(0)).alias("parent"), guest.alias("guest"), "fp")


def _pairs_of_parts(rows: DataFrame, shard_rows: int) -> DataFrame:
    """Rows (task, guest, fp) of shards that are full at the last depth: parts of about ``shard_rows`` / 2, a task for
    each two of them (which also compares each part with itself)."""
    parts = F.ceil(F.col("n") * 2 / F.lit(shard_rows)).cast("long")
    own = rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("fp"), "parts"))
    others = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).where("other <> part")
    return others.select(F.xxhash64("shard", F.least("part", "other"), F.greatest("part", "other")).alias("task"), "guest", "fp")


def tasks(fps: DataFrame, n: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Rows (task, guest, fp): every pair to compare meets in a task, and no task holds much more than ``shard_rows`` rows.

    The trees start at the depth that suits ``n`` random fingerprints.  Shards whose counted rows exceed ``shard_rows``
    go one depth down, alone; what is too full at the last depth (equal halves) is cut into parts.
    A task's name is a hash: two shards of one name only share a task.
    """
    spark = fps.sparkSession
    peak = {4: 0.375 ** 8, 2: 0.5 ** 16, 1: 0.5 ** 32}      # share of rows in the fullest shard
    start = next((b for b, p in peak.items() if n * p * (1 + 32 // b) <= shard_rows), 1)
    out, full = None, None
    for depth in [b for b in peak if b <= start]:
        rows = _shards(fps, depth)
        if full is not None:
            rows = rows.join(full.select(F.col("shard").alias("parent")), "parent", "left_semi")
        full = stage(spark, rows.groupBy("shard").agg(F.count("*").alias("n")).where(F.col("n") > shard_rows), "full-shards")
        more = not full.isEmpty()
        fit = rows.join(full, "shard", "left_anti") if more else rows
        fit = fit.select(F.xxhash64(F.lit(depth), "shard").alias("task"), "guest", "fp")
        out = fit if out is None else out.unionByName(fit)
        if not more:
            return out
    return out.unionByName(_pairs_of_parts(rows.join(full, "shard"), shard_rows))


def _links(max_bits: int):
    def shard_links(home: np.ndarray, guest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([home, guest])
        labels = np.arange(len(every))
        for i in range(0, len(home), BLOCK):
            for j in range(i, len(every), 4 * BLOCK):
                near = np.bitwise_count(home[i:i + BLOCK, None] ^ every[None, j:j + 4 * BLOCK]) <= max_bits
                a, b = np.nonzero(near)
                if len(a):
                    labels = merge_labels(labels, a + i, b + j)
        moved = np.flatnonzero(labels != np.arange(len(every)))
        return every[moved], every[labels[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by task; a task is handled when its last row is there."""
        shard, guest, fp = np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.uint64)

        def done(upto: int) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.diff(shard[:upto])) + 1
            a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            for lo, hi in zip(np.r_[0, cuts], np.r_[cuts, upto]):
                if hi - lo > 1:
                    g = guest[lo:hi]
                    x, y = shard_links(fp[lo:hi][~g], fp[lo:hi][g])
                    a.append(x)
                    b.append(y)
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            shard = np.r_[shard, batch.column(0).to_numpy()]
            guest = np.r_[guest, batch.column(1).to_numpy(zero_copy_only=False)]
            fp = np.r_[fp, batch.column(2).to_numpy().view(np.uint64)]
            upto = int(np.searchsorted(shard, shard[-1]))
            if upto:
                yield done(upto)
                shard, guest, fp = shard[upto:], guest[upto:], fp[upto:]
        if len(shard):
            yield done(len(shard))

    return run


def links(fps: DataFrame, n: int, max_bits: int = MAX_BITS, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """A spanning set of links (a, b) between distinct fingerprints ``fps`` (fp); n is their number."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the trees search with radius 1 per half, so at most 3 bits")
    placed = tasks(fps, n, shard_rows).repartition("task").sortWithinPartitions("task")
    return placed.mapInArrow(_links(max_bits), "a long, b long")


def simhash_groups(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Rows (doc_id, key, fp, root, component_id), one per document row; root tells groups apart."""
    rows = stage(spark, with_fingerprints(docs, id_col, text_col, shingle), "simhash")
    fps = stage(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-fps")
    nodes = components(spark, links(fps.select("fp"), fps.count(), max_bits))
    named = fps.join(nodes.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    by_fp = named.join(smallest, "root").select("fp", "root", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", "key", "fp", "root", "component_id")


def keep_first(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               **options: object) -> DataFrame:
    """The rows of ``docs`` whose doc_id names its group: one document of each group stays.

    Rows that repeat a kept id are reduced to one.  A document without id
    stays only if no document of its group has one.
    """
    groups = simhash_groups(spark, docs, id_col, text_col, **options)
    named = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    texts = named.groupBy("root", "doc_id", "key").agg(F.count("*").alias("n"))
    kept = stage(spark, texts.groupBy("root", "doc_id").agg(F.min(F.struct("key", "n")).alias("t"))
                 .select("doc_id", "t.key", "t.n"), "simhash-kept")
    keys = kept.select(*(F.col(c).alias(f"__kept_{c}") for c in kept.columns))
    on = F.col(id_col).eqNullSafe(F.col("__kept_doc_id")) & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__kept_key"))
    rows = docs.join(keys, on).drop("__kept_doc_id", "__kept_key")
    once = rows.where("__kept_n = 1").drop("__kept_n")
    again = rows.where("__kept_n > 1").drop("__kept_n").dropDuplicates([id_col, text_col])
    return once.unionByName(again)
