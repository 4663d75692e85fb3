"""Quality by ordinal cumulative-link regression on graded ratings.

P(grade <= k) = logistic(threshold_k - w . x): one weight vector for all
grades, ordered thresholds (each adds exp(delta) to the one before).  x is the
text as hashed features in DIMENSIONS slots, each family averaged over the
document's tokens: the word itself, its character classes with its length,
the same as the token before, and - one slot each - the shares of tokens seen
earlier in the document, of upper-case letters and of characters that are
neither letters nor spaces, in tenths.

Results per document: the expected grade, the probability of the top grades
(grade >= tail) and whether that selects it.  Fitted by gradient descent on a
bounded sample outside the held-out fold, each grade weighing the same: at most
SAMPLE_ROWS rated documents a grade, and in the order of a hash of them only so
many as hold SAMPLE_PAIRS (slot, value) pairs over all grades, but one of each
grade at least.  A document in the sample counts with its whole text.

Edge cases: null and empty texts have only the shares' slots; with one grade
or none in the ratings, that grade (or 0) is expected everywhere; ratings
without id or grade are left out, several ratings of a document count as
their highest; repeated rows give repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import Rolling, fold, mix, slices, stage, text_bytes
from tillhouse.llm.toxicity import labelled_sample

DIMENSIONS = 1 << 14
SAMPLE_ROWS = 3_000
SAMPLE_PAIRS = 1 << 24          # about 0.2 GB of pairs on the driver
STEPS = 300
SLICE_BYTES = 1 << 20
ROLL = Rolling(0x9FB21C651E98DF25)

#: A character's class bit: upper, lower, digit, beyond ASCII, then each common mark, then the rest.
MARKS = ".,!?*#%&$|-'\"():;"
KIND = np.full(256, 1 << (4 + len(MARKS)), np.uint32)
KIND[ord("A"):ord("Z") + 1] = 1
KIND[ord("a"):ord("z") + 1] = 2
KIND[ord("0"):ord("9") + 1] = 4
KIND[0x80:] = 8
for _i, _c in enumerate(MARKS):
    KIND[ord(_c)] = 16 << _i
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True


def _slot(family: int, value: np.ndarray) -> np.ndarray:
    return (mix(value.astype(np.uint64) * np.uint64(8) + np.uint64(family)) % np.uint64(DIMENSIONS)).astype(np.int64)


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice of texts: document, slot and value of every feature, not yet added up."""
    for lo, hi in slices(texts, SLICE_BYTES):
        part = texts[lo:hi]
        buf = np.frombuffer(b" ".join(part) + b" ", np.uint8)
        starts = np.r_[0, np.cumsum([len(t) + 1 for t in part])]
        gap = np.r_[True, SPACE[buf], True]
        a, b = np.flatnonzero(gap[:-1] & ~gap[1:]), np.flatnonzero(~gap[:-1] & gap[1:])
        doc = np.searchsorted(starts, a, "right") - 1
        n = np.maximum(1, np.bincount(doc, minlength=len(part)))
        word = ROLL.of(ROLL.prefix(buf), a, b)
        kinds = np.empty(0, np.uint64)
        if len(a):      # the blanks up to the next token carry no bits
            kinds = np.bitwise_or.reduceat(np.where(SPACE[buf], np.uint32(0), KIND[buf]), a).astype(np.uint64)
        shape = kinds * np.uint64(16) + np.minimum(b - a, 15).astype(np.uint64)
        again = np.zeros(len(a), bool)
        again[1:] = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
        order = np.lexsort((np.arange(len(a)), word, doc))
        seen = np.zeros(len(a), bool)
        if len(a):
            seen[order[1:]] = (word[order[1:]] == word[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
        weight = 1.0 / n[doc]
        families = [(doc, _slot(0, word), weight), (doc, _slot(1, shape), weight), (doc[again], _slot(2, np.ones(again.sum())), weight[again])]
        whole = np.add.reduceat
        size = np.maximum(1, np.diff(starts) - 1)
        every = np.arange(len(part))
        shares = [np.bincount(doc, weights=seen, minlength=len(part)) / n,
                  whole((KIND[buf] == 1).astype(np.int64), starts[:-1]) / size,
                  whole((KIND[buf] >= 4).astype(np.int64) - (KIND[buf] == 8) - SPACE[buf], starts[:-1]) / size]
        for f, s in enumerate(shares):
            tenth = np.clip(np.floor(s * 10), 0, 10)
            families.append((every, _slot(3 + f, tenth), np.full(len(part), 0.3)))
        yield tuple(np.concatenate(x) for x in zip(*((d + lo, s, v) for d, s, v in families)))


class Model:
    """Ordered grades, shared weights and thresholds."""

    def __init__(self, grades: list[int], weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = grades, weights, thresholds

    def below(self, eta: np.ndarray) -> np.ndarray:
        """P(grade <= k) for all but the last grade."""
        return 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - eta[:, None], -40, 40)))

    def score(self, texts: list[bytes], tail: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade and P(grade >= tail), tail being the top grade if not given."""
        eta = np.zeros(len(texts))
        if len(self.grades) > 1:
            for doc, slot, value in features(texts):
                eta += np.bincount(doc, weights=value * self.weights[slot], minlength=len(texts))
        cum = np.c_[np.zeros(len(texts)), self.below(eta), np.ones(len(texts))] if len(self.grades) > 1 else \
            np.c_[np.zeros(len(texts)), np.ones(len(texts))]
        p = np.diff(cum, axis=1)
        g = np.array(self.grades or [0], float)
        tail = g[-1] if tail is None else tail
        return p @ g, np.clip(p[:, g >= tail].sum(axis=1), 0, 1)


def fit(counts: np.ndarray, slots: np.ndarray, values: np.ndarray, grades: np.ndarray, steps: int = STEPS, rate: float = 0.3,
        penalty: float = 1e-5) -> Model:
    """Adam on the mean log-likelihood, each grade weighing the same.

    Pairs (slot, value) of all documents one after the other; ``counts`` has the number of pairs of each document.
    """
    levels = sorted(set(grades.tolist()))
    if len(levels) < 2:
        return Model(levels, np.zeros(DIMENSIONS), np.empty(0))
    y = np.searchsorted(levels, grades)
    rows = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    share = 1 / (len(levels) * np.bincount(y)[y])
    k = len(levels) - 1
    params = np.r_[np.zeros(DIMENSIONS), -1.0, np.zeros(k - 1)]      # weights, first threshold, log gaps
    m, v = np.zeros_like(params), np.zeros_like(params)
    sigmoid = lambda t: 1 / (1 + np.exp(-np.clip(t, -40, 40)))
    for t in range(1, steps + 1):
        w, theta = params[:DIMENSIONS], np.cumsum(np.r_[params[DIMENSIONS], np.exp(params[DIMENSIONS + 1:])])
        eta = np.bincount(rows, weights=values * w[slots], minlength=len(counts))
        upper = np.where(y < k, sigmoid(theta[np.minimum(y, k - 1)] - eta), 1.0)
        lower = np.where(y > 0, sigmoid(theta[np.maximum(y - 1, 0)] - eta), 0.0)
        p = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        slope = share * (du - dl)       # of -log p by eta
        g_w = np.bincount(slots, weights=values * slope[rows], minlength=DIMENSIONS) + penalty * w
        g_theta = np.bincount(np.minimum(y, k - 1), weights=np.where(y < k, -share * du, 0), minlength=k) + \
            np.bincount(np.maximum(y - 1, 0), weights=np.where(y > 0, share * dl, 0), minlength=k)
        tails = np.cumsum(g_theta[::-1])[::-1]
        grad = np.r_[g_w, tails[0], tails[1:] * np.exp(params[DIMENSIONS + 1:])]
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        params = params - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return Model(levels, params[:DIMENSIONS], np.cumsum(np.r_[params[DIMENSIONS], np.exp(params[DIMENSIONS + 1:])]))


def learn(spark: SparkSession, docs: DataFrame, ratings: DataFrame, grade_col: str = "quality", rows: int = SAMPLE_ROWS,
          pairs: int = SAMPLE_PAIRS, **options: object) -> Model:
    sample = stage(spark, labelled_sample(docs, ratings, label=grade_col, rows=rows, **options), "rated-sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = text_bytes(b.column(1))
            slots: list = [[] for _ in texts]
            values: list = [[] for _ in texts]
            for doc, slot, value in features(texts):
                key, back = np.unique(doc * DIMENSIONS + slot, return_inverse=True)
                added = np.bincount(back, weights=value)
                for d in np.unique(key // DIMENSIONS):
                    here = slice(*np.searchsorted(key, [d * DIMENSIONS, (d + 1) * DIMENSIONS]))
                    slots[d], values[d] = (key[here] % DIMENSIONS).tolist(), added[here].tolist()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(slots, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))],
                                             ["label", "slots", "values"])

    got = stage(spark, sample.select("label", "text").mapInArrow(run, "label int, slots array<int>, values array<float>"), "rated-features")
    order = Window.partitionBy("label").orderBy(F.xxhash64("slots", "values"))      # at most ``rows`` rows a grade
    before = F.sum(F.size("slots").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    grades = F.lit(max(1, got.select("label").distinct().count()))
    taken = got.withColumn("before", F.coalesce(before, F.lit(0))).where(
        (F.col("before") == 0) | (F.col("before") + F.size("slots") <= F.lit(pairs) / grades))
    table = taken.select("label", "slots", "values").toArrow()
    lists, values = (table.column(c).combine_chunks() for c in ("slots", "values"))
    if isinstance(lists, pa.ChunkedArray):      # no row
        return fit(*(np.empty(0, t) for t in (np.int64, np.int32, np.float32, np.int64)))
    return fit(np.diff(lists.offsets.to_numpy()), lists.flatten().to_numpy(), values.flatten().to_numpy(), table.column(0).to_numpy())


def grade(spark: SparkSession, docs: DataFrame, ratings: DataFrame, tail: int | None = None, least: float = 0.5,
          id_col: str = "doc_id", text_col: str = "text", **options: object) -> DataFrame:
    """Rows (doc_id, held_out, expected_grade, tail_probability, selected)."""
    model = learn(spark, docs, ratings, id_col=id_col, text_col=text_col, **options)
    held = spark.sparkContext.broadcast((model.grades, model.weights, model.thresholds))      # DIMENSIONS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Model(*held.value)
        for b in batches:
            expected, top = scorer.score(text_bytes(b.column(1)), tail)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(expected), pa.array(top)], ["doc_id", "expected_grade", "tail_probability"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.mapInArrow(run, "doc_id long, expected_grade double, tail_probability double")
    return rows.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "expected_grade", "tail_probability",
                       (F.col("tail_probability") >= least).alias("selected"))
