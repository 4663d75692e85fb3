"""Embedding near-duplicates by spherical-cap filters.

Vectors of equal label that differ in nothing are one class with a count.  A
class's unit vector, randomly rotated, is split in two halves, each with a
codebook of random directions; a filter direction is a pair of codes.  List
decoding finds all filters that the vector exceeds: codes of the first half
that can reach the threshold at all, each with every sufficient code of the
second.  Classes are joined on (label, filter), verified by cosine in double
precision, and a pair is counted in its smallest common filter only.

The threshold makes a filter hold a share p of random vectors, and there are
about LISTS / p filters, so a vector lists about LISTS of them at any size;
p = min(MAX_SHARE, BUCKET / vectors) keeps buckets near BUCKET rows as the
table grows (short vectors have larger caps, and below PRODUCT_SIZE dimensions
one undivided codebook).  A bucket above BLOCK rows (many near copies) is split into parts,
and each pair of parts is a task of its own.  Only per-vector link counts and
a spanning set of links leave a task.

Few codes of large books exceed a small cap's threshold, so list lengths
scatter more as the caps shrink; every vector therefore lists at least its
``least`` best filters (found among the best codes of both halves), a number
that grows with the logarithm of the table.

Recall is probabilistic: pairs at the threshold are found with probability
0.97 or more up to 10^8 vectors, by a test of the filters alone; another
compares the whole operator with all pairs.  Nothing below the threshold is
ever linked, and no list, bucket or partner count is capped.

Edge cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows without label, link with nothing (component: their own
id); vectors of different lengths never link; rows that repeat count as other
vectors of their class; rows without id get their group's smallest id; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.llm.common import components, merge_labels, stage

COSINE = 0.93
LISTS = 20
MAX_SHARE = 0.02
BUCKET = 2_000
BLOCK = 4_096
SEED = 20_240_229
MIN_LIST = 16           # up to 10^6 vectors; 4 more for each tenfold
MAX_HEIGHT = 0.85       # caps no smaller than this hold a near pair's both ends, however short the vectors
PRODUCT_SIZE = 16


def cap_share(size: int, height: float) -> float:
    """Share of the unit sphere within a cap: those whose product with the cap's direction is at least ``height``."""
    def area(angle: float) -> float:
        t = np.linspace(0, angle, 4001)
        return float(np.trapezoid(np.sin(t) ** (size - 2), t))

    return 0.5 if size == 1 else area(math.acos(height)) / area(math.pi)


class Filters:
    """Filter directions for one vector length: a rotation and two codebooks, all from the seed."""

    def __init__(self, size: int, vectors: int):
        share = min(MAX_SHARE, BUCKET / max(1, vectors))
        height = min(NormalDist().inv_cdf(1 - share) / math.sqrt(size), MAX_HEIGHT)
        filters = LISTS / cap_share(size, height)
        self.least = max(MIN_LIST, math.ceil(MIN_LIST + 4 * (math.log10(max(1, vectors)) - 6)))
        rng = np.random.default_rng([SEED, size])
        self.turn = np.linalg.qr(rng.normal(size=(size, size)))[0]
        book = lambda k, n: (lambda c: c / np.linalg.norm(c, axis=1, keepdims=True))(rng.normal(size=(k, n)))
        if size < PRODUCT_SIZE:     # halves this short have too few directions of their own
            self.cut, self.first, self.second, self.threshold = size, book(math.ceil(filters), size), np.zeros((1, 0)), height
        else:
            codes = math.ceil(math.sqrt(filters))
            self.cut = (size + 1) // 2
            self.first, self.second = book(codes, self.cut), book(codes, size - self.cut)
            self.threshold = math.sqrt(2) * height      # a pair of unit codes has length sqrt(2)

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """All filters that each vector exceeds, ascending; at least its ``least`` best."""
        turned = unit @ self.turn
        s1, s2 = turned[:, :self.cut] @ self.first.T, turned[:, self.cut:] @ self.second.T
        width = s2.shape[1]
        v, i = np.nonzero(s1 >= self.threshold - s2.max(axis=1, keepdims=True))
        owner, found = [], []
        for lo in range(0, len(v), 1 << 14):
            a, b = v[lo:lo + (1 << 14)], i[lo:lo + (1 << 14)]
            r, j = np.nonzero(s2[a] + s1[a, b][:, None] >= self.threshold)
            owner.append(a[r])
            found.append(b[r] * width + j)
        # The k best pairs of codes are pairs of the k best codes of either half.
        top1, top2 = self._best(s1), self._best(s2)
        sums = np.take_along_axis(s1, top1, 1)[:, :, None] + np.take_along_axis(s2, top2, 1)[:, None, :]
        names = (top1[:, :, None] * width + top2[:, None, :]).reshape(len(unit), -1)
        best = self._best(sums.reshape(len(unit), -1))
        owner.append(np.repeat(np.arange(len(unit)), best.shape[1]))
        found.append(np.take_along_axis(names, best, 1).ravel())
        total = len(self.first) * width
        every = np.unique(np.concatenate(owner) * total + np.concatenate(found))
        return [part % total for part in np.split(every, np.searchsorted(every, np.arange(1, len(unit)) * total))]

    def _best(self, scores: np.ndarray) -> np.ndarray:
        """Columns of the ``least`` greatest scores of each row."""
        k = min(self.least, scores.shape[1])
        return np.argpartition(-scores, k - 1, axis=1)[:, :k]


def _decoded(vectors: int, kind: str):
    """Rows (cid, vector, filters); vectors are kept as the numpy type ``kind``, that of the table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict = {}
        for b in batches:
            rows = [np.array(x, np.float64) for x in b.column(1).to_pylist()]
            sizes = np.array([len(x) for x in rows])
            lists: list = [None] * len(rows)
            for n in np.unique(sizes):
                filters = made.setdefault(n, Filters(int(n), vectors))
                for at in np.array_split(np.flatnonzero(sizes == n), max(1, int((sizes == n).sum()) // 512)):
                    x = np.stack([rows[k] for k in at])
                    x /= np.abs(x).max(axis=1, keepdims=True)
                    for k, f in zip(at, filters.decode(x / np.linalg.norm(x, axis=1, keepdims=True))):
                        lists[k] = f
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x.astype(kind).tobytes() for x in rows], pa.binary()),
                                              pa.array([f.tolist() for f in lists], pa.list_(pa.int64()))], ["cid", "vector", "filters"])

    return run


class SmallerFilters:
    """The filters below f that several rows of a bucket list, one bit each: tells whether two rows share one."""

    def __init__(self, lists: list[np.ndarray], f: int):
        low = [x[x < f] for x in lists]
        names, number, times = np.unique(np.concatenate(low), return_inverse=True, return_counts=True)
        row, several = np.repeat(np.arange(len(low)), [len(x) for x in low]), times[number] > 1
        bit = (np.cumsum(times > 1) - 1)[number[several]]
        self.bits = np.zeros((len(low), int((times > 1).sum()) // 8 + 1), np.uint8)
        np.bitwise_or.at(self.bits, (row[several], bit >> 3), np.left_shift(1, bit & 7).astype(np.uint8))
        self.at_once = max(256, (1 << 25) // self.bits.shape[1])       # 32 MB a side

    def shared(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        steps = range(0, len(i), self.at_once)
        return np.concatenate([(self.bits[i[k:k + self.at_once]] & self.bits[j[k:k + self.at_once]]).any(axis=1) for k in steps])


def _verify(cosine: float, kind: str):
    def bucket(f, cid, count, vector, lists, part, own):
        x = np.stack([np.frombuffer(v, kind) for v in vector]).astype(np.float64)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        n, labels, links = len(x), np.arange(len(x)), np.zeros(len(x), np.int64)
        left = np.arange(n) if own else np.flatnonzero(part == part.min())
        right = np.arange(n) if own else np.flatnonzero(part != part.min())
        smaller = None
        for lo in range(0, len(left), 512):
            a, b = np.nonzero(x[left[lo:lo + 512]] @ x[right].T >= cosine)
            i, j = left[lo + a], right[b]
            if own:
                i, j = i[i < j], j[i < j]
            if not len(i):
                continue
            labels = merge_labels(labels, i, j)
            smaller = smaller or SmallerFilters(lists, f)
            new = ~smaller.shared(i, j)
            np.add.at(links, i[new], count[j[new]])
            np.add.at(links, j[new], count[i[new]])
        told = np.flatnonzero((links > 0) | (labels != np.arange(n)))
        return cid[told], links[told], cid[labels[told]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by task; a task's rows are handled when the last is there."""
        held: list = []

        def done() -> pa.RecordBatch:
            cols = [[r[k] for r in held] for k in range(8)]
            cid, links, to = bucket(cols[1][0], np.array(cols[3]), np.array(cols[4]), cols[5], [np.array(x) for x in cols[6]],
                                    np.array(cols[7]), cols[2][0])
            return pa.RecordBatch.from_arrays([pa.array(cid, pa.int64()), pa.array(links, pa.int64()), pa.array(to, pa.int64())],
                                              ["cid", "links", "to"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if held and row[0] != held[0][0]:
                    if len(held) > 1:
                        yield done()
                    held = []
                held.append(row)
        if len(held) > 1:
            yield done()

    return run


def near_embeddings(spark: SparkSession, vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of ``vectors``."""
    v = F.col("v")
    # Double precision throughout the arithmetic; single-precision vectors travel as they are.
    kind = "<f4" if vectors.schema[vector_col].dataType == T.ArrayType(T.FloatType()) else "<f8"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists(v, lambda c: c != 0), F.lit(False))
    rows = rows.select("vec_id", "label", F.when(usable, v).alias("v"), F.when(usable, F.xxhash64("label", "v")).alias("k1"),
                       F.when(usable, F.xxhash64("v", F.lit(1), "label")).alias("k2"))
    classes = rows.where("k1 is not null").groupBy("k1", "k2").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("count"), F.any_value("label").alias("label"), F.any_value("v").alias("v"))
    classes = stage(spark, classes.withColumn("cid", F.monotonically_increasing_id()), "vector-classes")
    decoded = stage(spark, classes.select("cid", "v").mapInArrow(_decoded(classes.count(), kind), "cid long, vector binary, filters array<long>")
                    .join(classes.select("cid", "label", "count", F.size("v").alias("size")), "cid"), "vector-filters")

    listed = decoded.select("cid", "label", "size", F.explode("filters").alias("f"))
    buckets = listed.groupBy("label", "size", "f").agg(F.count("*").alias("n")).where("n > 1")
    buckets = buckets.select("label", "size", "f", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    placed = listed.join(buckets, ["label", "size", "f"])      # ids only; vectors follow once a task is named
    placed = placed.withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    placed = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    low, high = F.least("part", "other"), F.greatest("part", "other")
    placed = placed.select(
        F.concat_ws("/", F.col("label").cast("string"), "size", "f", low, high).alias("task"), "f", (low == high).alias("own"),
        "cid", "part")
    placed = placed.join(decoded.select("cid", "count", "vector", "filters"), "cid").select(
        "task", "f", "own", "cid", "count", "vector", "filters", "part")
    found = stage(spark, placed.repartition("task").sortWithinPartitions("task").mapInArrow(
        _verify(cosine, kind), "cid long, links long, to long"), "vector-links")

    nodes = components(spark, found.select(F.col("cid").alias("a"), F.col("to").alias("b")))
    links = found.groupBy("cid").agg(F.sum("links").alias("links"))
    named = (classes.select("cid", "k1", "k2", "first", "count").join(nodes.withColumnRenamed("node", "cid"), "cid", "left")
             .join(links, "cid", "left").withColumn("root", F.coalesce("root", "cid")))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.join(smallest, "root").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("count") - 1).alias("n_links"), "component")
    out = rows.select("vec_id", "k1", "k2").join(named, ["k1", "k2"], "left")
    component = F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.col("vec_id").eqNullSafe(component).alias("kept"))
