"""Packing of tokenised documents into fixed windows by non-negative least squares.

1. Every text is tokenised once; a document's ids end with END_ID.  Ids go to
   a stored table.  Whole windows of a long document are sequences of their
   own; what remains (0 to window - 1 ids) is to be packed.
2. Remainders are counted by length class of ``step`` ids: a histogram of at
   most window / step numbers, all that the driver ever sees.
3. All shallow combinations (up to ``depth`` classes) that fill the window are
   enumerated; non-negative least squares (active sets) solves how often each
   is repeated so that the histogram is met; counts are rounded down and cut
   to what each class holds.
4. The k-th document of a class (its rank, from per-shard counts) takes the
   k-th place that the plan has for that class, so documents find their
   sequences without any exchange of texts.
5. Documents beyond the plan are packed greedily: within a shard they follow
   one another, cut where a window is full.  Only these documents' ids are
   read again, for the checksums of the cut pieces.

Ids are computed with the byte-level BPE vocabulary by its rank file, which
gives the ids of the JSON file's tokenizer several times faster (a test holds
them equal); a text with an unbroken run of over LONG_RUN bytes goes to the
JSON file's tokenizer itself, whose merging stays near-linear there.  The JSON
file's added token is one id wherever its string stands in a text, as that
tokenizer has it.

Edge cases: a null or empty text is the document [END_ID]; rows without id or
with a repeated id are documents like any other; no documents give no pieces;
other columns are ignored.
"""

from __future__ import annotations

import base64
import os
import re
import zlib
from collections.abc import Iterator
from json import load

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillhouse.llm.common import slices, stage

WINDOW = 2048
END_ID = 1
STEP = 8
DEPTH = 3
LONG_RUN = 4096
RANKS = "byte_bpe_50k.tiktoken"
JSON = "byte_bpe_50k.json"

TOKENS = ("uid long, doc_id long, shard long, n long, n_full long, full_first long, rem int, class int, class_rank long, "
          "class_before long, full_crc array<long>, rem_crc long, full_ids binary, rem_ids binary")
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    def __init__(self, ranks: str, json: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        with open(json, encoding="utf-8") as f:
            added = {t["content"]: t["id"] for t in load(f)["added_tokens"]}
        self.fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=added)
        self.json, self.slow, self.tokenizer = json, re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN)), Tokenizer

    def ids(self, text: str) -> np.ndarray:
        if self.slow.search(text):
            if isinstance(self.tokenizer, type):
                self.tokenizer = self.tokenizer.from_file(self.json)
            out = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            out = self.fast.encode(text, allowed_special="all")
        return np.array([*out, END_ID], dtype="<u4")


def tokenize(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
             step: int = STEP, ranks: str | None = None, json: str | None = None) -> DataFrame:
    """The stored token table, one row per document row; a shard is what one task read."""
    ranks, json = ranks or vocabulary(RANKS), json or vocabulary(JSON)
    names = [c.split()[0] for c in TOKENS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, k, full, encode = TaskContext.get().partitionId(), 0, 0, Encoder(ranks, json).ids
        rank, before = np.zeros(window // step + 2, np.int64), np.zeros(window // step + 2, np.int64)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            sizes = [t or "" for t in texts]
            for lo, hi in slices(sizes, 1 << 21):
                rows = []
                for d in range(lo, hi):
                    t = encode(sizes[d])
                    n_full, rem = divmod(len(t), window)
                    c = -(-rem // step)
                    tail = t[n_full * window:].tobytes()
                    rows.append(((shard << 32) + k, ids[d], shard, len(t), n_full, full, rem, c, rank[c], before[c],
                                 [zlib.crc32(t[w * window:(w + 1) * window].tobytes()) for w in range(n_full)],
                                 zlib.crc32(tail), t[:n_full * window].astype("<u2").tobytes(), t[n_full * window:].astype("<u2").tobytes()))
                    rank[c] += 1
                    before[c] += rem
                    full += n_full
                    k += 1
                types = [pa.int64()] * 6 + [pa.int32()] * 2 + [pa.int64()] * 2 + [pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stage(spark, rows.mapInArrow(run, TOKENS), "tokens", **{"parquet.block.size": 16 << 20})


def combinations(classes: int, depth: int) -> list[tuple[int, ...]]:
    """Descending tuples of at most ``depth`` classes that add up to ``classes``."""
    def parts(left: int, most: int, places: int) -> Iterator[tuple[int, ...]]:
        if left == 0:
            yield ()
        elif places:
            for c in range(min(left, most), -(-left // places) - 1, -1):
                for rest in parts(left - c, c, places - 1):
                    yield (c, *rest)

    return list(parts(classes, classes, depth))


def nnls(a: np.ndarray, b: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """argmin |a x - b| with x >= 0, by active sets: columns enter by steepest descent, leave when they reach 0."""
    x, on = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    tolerance = 1e-9 * max(1.0, np.abs(b).max(initial=0))
    for _ in range(rounds):
        slope = a.T @ (b - a @ x)
        slope[on] = -np.inf
        best = int(np.argmax(slope))
        if slope[best] <= tolerance:
            break
        on[best] = True
        while True:
            held = np.flatnonzero(on)
            want = np.linalg.lstsq(a[:, held], b, rcond=None)[0]
            low = want <= 0
            if not low.any():
                x[:] = 0
                x[held] = want
                break
            now = x[held]
            ratio = now[low] / np.maximum(now[low] - want[low], 1e-300)
            x[held] = now + ratio.min() * (want - now)
            out = held[low][ratio <= ratio.min()]
            x[out] = 0
            on[out] = False
    return x


def plan(histogram: np.ndarray, depth: int = DEPTH) -> tuple[list[tuple[int, ...]], list[int]]:
    """Combinations with their whole repeat counts; histogram[c] = documents of class c (1..classes)."""
    classes = len(histogram) - 1
    combos = combinations(classes, depth)
    a = np.zeros((classes, len(combos)))
    for s, combo in enumerate(combos):
        for c in combo:
            a[c - 1, s] += 1
    scale = max(1, histogram[1:].max(initial=0))
    x = nnls(a, histogram[1:] / scale) * scale
    left, counts = histogram.astype(np.int64).copy(), [0] * len(combos)
    for s in np.argsort(-x, kind="stable"):
        need = {c: combos[s].count(c) for c in combos[s]}
        counts[s] = int(min([np.floor(x[s] + 1e-6), *(left[c] // m for c, m in need.items())]))
        if counts[s] <= 0:
            counts[s] = 0
            continue
        for c, m in need.items():
            left[c] -= m * counts[s]
    used = [s for s in range(len(combos)) if counts[s]]
    return [combos[s] for s in used], [counts[s] for s in used]


def _cut(window: int):
    """Pieces of documents that follow one another in their shard's stream, cut where a window is full."""
    names = [c.split()[0] for c in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc_id, shard, n, start, at, raw in zip(*(c.to_pylist() for c in batch.columns)):
                ids, done = np.frombuffer(raw, "<u2").astype("<u4"), 0
                while done < len(ids):
                    offset = (at + done) % window
                    k = min(len(ids) - done, window - offset)
                    out.append((doc_id, start + done, k, zlib.crc32(ids[done:done + k].tobytes()), n,
                                (((shard << 32) + (at + done) // window) << 2) + 2, offset))
                    done += k
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(7)], names)

    return run


def pack(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
         step: int = STEP, depth: int = DEPTH, tokens: DataFrame | None = None, **options: object) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    if window % step or window >= 1 << 16:
        raise ValueError("window must be a multiple of step below 65,536")
    tokens = tokenize(spark, docs, id_col, text_col, window, step, **options) if tokens is None else tokens
    classes = window // step
    counts = stage(spark, tokens.where("class > 0").groupBy("class", "shard")
                   .agg(F.count("*").alias("docs"), F.sum("rem").alias("ids")), "packing-counts")
    histogram = np.zeros(classes + 1, np.int64)
    for r in counts.groupBy("class").agg(F.sum("docs").alias("docs")).collect():     # at most window / step rows
        histogram[r["class"]] = r["docs"]
    combos, repeats = plan(histogram, depth)

    # Places: for each class, ranks [first, last) sit at one slot of sequences [base, ...). At most depth places for
    # each combination in use, and those are no more than the classes.
    places, planned, base = [], np.zeros(classes + 1, np.int64), 0
    for combo, k in zip(combos, repeats):
        for slot, c in enumerate(combo):
            places.append((int(c), int(planned[c]), int(planned[c] + k), base, slot))
            planned[c] += k
        base += k
    place = spark.createDataFrame(places, "p_class int, first long, last long, base long, slot int")
    limit = spark.createDataFrame([(c, int(planned[c])) for c in range(1, classes + 1)], "class int, planned long")

    earlier = Window.partitionBy("class").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("ranks_before", F.coalesce(F.sum("docs").over(earlier), F.lit(0))).join(F.broadcast(limit), "class")
    narrow = tokens.drop("full_ids", "rem_ids", "full_crc")
    placed = narrow.join(ranked.select("class", "shard", "ranks_before", "planned"), ["class", "shard"])
    placed = stage(spark, placed.withColumn("rank", F.col("ranks_before") + F.col("class_rank"))
                   .select("uid", "doc_id", "shard", "n", "n_full", "rem", "class", "class_before", "rem_crc", "rank", "planned"),
                   "packing-ranks")

    whole = tokens.where("n_full > 0").select(
        "doc_id", "shard", "full_first", F.col("n").alias("doc_tokens"), F.posexplode("full_crc").alias("w", "ids_crc32"))
    whole = whole.select(
        "doc_id", (F.col("w").cast("long") * window).alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32",
        "doc_tokens", F.shiftleft(F.shiftleft(F.col("shard"), 32) + F.col("full_first") + F.col("w"), 2).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))

    start = (F.col("n_full") * window).alias("start")
    before = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    fitted = placed.where("rank < planned").join(
        F.broadcast(place), F.expr("class = p_class and rank >= first and rank < last"))
    fitted = fitted.select(
        "doc_id", start, F.col("rem").cast("long").alias("length"), F.col("rem_crc").alias("ids_crc32"), F.col("n").alias("doc_tokens"),
        (F.shiftleft(F.col("base") + F.col("rank") - F.col("first"), 2) + 1).alias("sequence_id"), "slot")
    fitted = fitted.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0))).drop("slot")

    # The greedy rest. A class's plan ends inside at most one shard; what that shard's class holds before that point is
    # known from the document whose rank is the plan's end (one a class at most).
    ends = placed.where("rank = planned").select("class", "shard", F.col("class_before").alias("ids_planned"))
    shard_rest = ranked.join(F.broadcast(ends), ["class", "shard"], "left").withColumn(
        "skipped", F.when(F.col("ranks_before") >= F.col("planned"), F.coalesce("ids_planned", F.lit(0)))
        .when(F.col("ranks_before") + F.col("docs") <= F.col("planned"), F.col("ids")).otherwise(F.col("ids_planned")))
    stream = Window.partitionBy("shard").orderBy("class").rowsBetween(Window.unboundedPreceding, -1)
    shard_rest = shard_rest.withColumn("rest_before", F.coalesce(F.sum(F.col("ids") - F.col("skipped")).over(stream), F.lit(0)))
    rest = placed.where("rank >= planned").join(shard_rest.select("class", "shard", "rest_before", "skipped"), ["class", "shard"])
    rest = rest.select("uid", "n_full", (F.col("rest_before") + F.col("class_before") - F.col("skipped")).alias("at"))
    rest = tokens.select("uid", "doc_id", "shard", "n", "rem_ids").join(rest, "uid")
    rest = rest.select("doc_id", "shard", "n", start, "at", "rem_ids").mapInArrow(_cut(window), PIECES)

    columns = [c.split()[0] for c in PIECES.split(", ")]
    return whole.select(columns).unionByName(fitted.select(columns)).unionByName(rest.select(columns))
