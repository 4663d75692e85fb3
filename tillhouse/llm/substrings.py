"""Removal of repeated substrings by buckets of sampled suffixes and hashes of what surrounds them.

A byte is removed if a string of ``length`` bytes that covers it also starts
anywhere else in the corpus (overlaps count; texts are judged as they came in;
matches never cross documents).

1. Sampled suffixes.  Among the q-gram starts inside each ``length``-byte
   window, the one of smallest hash is the window's anchor, so equal windows
   have equal anchors at equal offsets, and only about one suffix in
   (length - q) / 2 is kept.  The q-gram's hash is the suffix's first bucket;
   suffixes alone in it are done: none of their windows repeats.
2. Refinement.  A suffix's bucket is refined by what stands at later (and
   earlier) offsets: the hash of the whole run of windows that share the
   anchor.  Suffixes in a common refined bucket have all these windows in
   common, so the run is settled at once.
3. Recursion.  What remains open - at the edges of repeats - is cut into groups
   of GROUP windows by their offset from the anchor and goes through the same
   step again: first bucket, what all windows of the group have in common;
   refined bucket, all they cover.  Then, for what is still open, each window is
   a bucket by itself.  At each level one representative of the settled
   members of an open first bucket goes on with the open ones.
4. The windows found are united, the bytes dropped.

Buckets are only counted (partial sums) and joined back, so no bucket's members
meet in one task.  Bucket names that decide are two 64-bit hashes by different
bases.  Texts are dealt out once, into buckets by document; every later join
with them moves only the windows' side.

Edge cases: null is empty text; texts shorter than ``length`` lose nothing;
repeated rows are repeated texts, so they lose what they share; texts of more
than STRETCH bytes are read in overlapping stretches (a run of windows ends
with its stretch, and what this leaves open is found by the finer levels); rows without
id are texts like others; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import Rolling, bucketed, discard, joined, slices, stage, text_bytes

LENGTH = 200
Q = 40
GROUP = 17
SLICE_BYTES = 1 << 18
STRETCH = 1 << 22               # longer texts are read in overlapping stretches
ROLLS = Rolling(0x2545F4914F6CDD1D), Rolling(0xD1342543DE82EF95)
POSITION_BITS = 28

#: A bucket's members: ``count`` windows of a text from ``first`` on, the anchor ``lead`` bytes later; first and refined bucket.
MEMBERS = "uid long, first int, count int, lead int, a long, b long"


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, from minima that restart every ``width``."""
    n = len(x) - width + 1
    pad = np.full(-len(x) % width, np.iinfo(x.dtype).max, x.dtype)
    grid = np.concatenate([x, pad]).reshape(-1, width)
    up = np.minimum.accumulate(grid, axis=1).ravel()
    down = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(down[:n], up[width - 1:width - 1 + n])


def anchored_runs(texts: list[bytes], length: int, q: int):
    """Text, first window, windows, anchor's lead, q-gram hash and run hash of each run of windows with one anchor."""
    buf, starts = joined(texts, lower=False)
    if len(buf) <= length:
        return (*(np.empty(0, np.int64),) * 4, *(np.empty(0, np.uint64),) * 2)
    near, whole = ROLLS[0].prefix(buf), ROLLS[1].prefix(buf)
    grams = np.arange(len(buf) - q + 1)
    keys = ROLLS[0].of(near, grams, grams + q)
    keys = (keys >> np.uint64(POSITION_BITS) << np.uint64(POSITION_BITS)) | grams.astype(np.uint64)     # ties: leftmost
    anchor = (_sliding_min(keys, length - q + 1) & np.uint64((1 << POSITION_BITS) - 1)).astype(np.int64)
    window = np.arange(len(anchor))
    doc = np.repeat(np.arange(len(texts)), np.diff(starts))[:len(anchor)]
    valid = window + length < starts[doc + 1]       # the text's own bytes only; its last is a separator
    window, anchor, doc = window[valid], anchor[valid], doc[valid]
    new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])]) if len(window) else np.empty(0, np.int64)
    first, count = window[new], np.diff(np.r_[new, len(window)])
    at, owner = anchor[new], doc[new]
    gram = ROLLS[0].of(near, at, at + q)
    run = _placed(ROLLS[1].of(whole, first, first + count + length - 1), at - first)
    return owner, first - starts[owner], count, at - first, gram, run


def _placed(hashes: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return hashes ^ (offset.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _batch(uid: np.ndarray, first, count, lead, a, b) -> pa.RecordBatch:
    ints = [pa.array(np.asarray(x).astype(np.int32)) for x in (first, count, lead)]
    return pa.RecordBatch.from_arrays([pa.array(uid), *ints, pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                                      [c.split()[0] for c in MEMBERS.split(", ")])


def _stretches(texts: list[bytes], stretch: int, beyond: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Row, begin and bytes of the texts' stretches: ``stretch`` bytes and ``beyond`` more, so that what starts in one lies in it whole."""
    places = [(k, at) for k, t in enumerate(texts) for at in range(0, max(len(t), 1), stretch)]
    row, begin = np.array(places, np.int64).reshape(-1, 2).T
    return row, begin, [texts[k][at:at + stretch + beyond] for k, at in places]


def _runs(length: int, q: int, stretch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid = b.column(0).to_numpy()
            row, begin, parts = _stretches(text_bytes(b.column(1)), stretch, length - 1)
            for lo, hi in slices(parts, SLICE_BYTES):
                owner, first, *rest = anchored_runs(parts[lo:hi], length, q)
                yield _batch(uid[row[lo + owner]], first + begin[lo + owner], *rest)

    return run


def _finer(length: int, group: int, stretch: int):
    """Rows (uid, text, runs): the runs' groups of windows, or single windows for groups of 1; each of a text once.

    A run has fewer than ``length`` windows, so the one that starts in a stretch ends within 2 * ``length`` bytes of it.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            uid, lists = b.column(0).to_numpy(), b.column(2)
            row, begin, texts = _stretches(text_bytes(b.column(1)), stretch, 2 * length)
            items, owner = lists.flatten(), np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            runs = np.stack([items.field(k).to_numpy().astype(np.int64) for k in range(3)], axis=1)
            place = np.searchsorted(row, owner) + runs[:, 0] // stretch         # the run's stretch
            order = np.argsort(place, kind="stable")
            runs, place = runs[order], place[order]
            runs[:, 0] -= begin[place]
            for lo, hi in slices(texts, SLICE_BYTES):
                buf, starts = joined(texts[lo:hi], lower=False)
                here = slice(*np.searchsorted(place, [lo, hi]))
                part, doc = runs[here], place[here] - lo
                first, count, lead = part.T
                near, whole = ROLLS[0].prefix(buf), ROLLS[1].prefix(buf)
                n = np.repeat(np.arange(len(part)), count)
                at = np.arange(len(n)) - np.repeat(np.cumsum(count) - count, count)        # the window's place in its run
                before = lead[n] - at                       # from the window's first byte to the anchor
                g = before // group
                new = np.flatnonzero(np.r_[True, (n[1:] != n[:-1]) | (g[1:] != g[:-1])]) if len(n) else np.empty(0, np.int64)
                size = np.diff(np.r_[new, len(n)])
                n, s, before, g = n[new], first[n[new]] + at[new], before[new], g[new]
                here = starts[doc[n]] + s
                anchor = here + before
                core = _placed(ROLLS[0].of(near, anchor - g * group, anchor + length - (g + 1) * group + 1), g)
                hull = _placed(ROLLS[1].of(whole, here, here + size + length - 1), before)
                if group == 1:      # windows are compared whatever their anchor
                    core, hull = ROLLS[0].of(near, here, here + length), ROLLS[1].of(whole, here, here + length)
                    keep = np.unique(here, return_index=True)[1]
                    n, s, size, before, core, hull = (x[keep] for x in (n, s, size, before, core, hull))
                at = lo + doc[n]
                yield _batch(uid[row[at]], s + begin[at], size, before, core, hull)

    return run


def refine(spark: SparkSession, members: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Settled members (their refined bucket a, b has others) and those to look at closer: open ones (only the first bucket
    a has others), with one settled member of each refined bucket in an open first bucket."""
    # The counts are written first: a join of two plain exchanges is one whose skewed keys Spark can split.
    shared = stage(spark, members.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").select("a"), name)
    alive = stage(spark, members.join(shared, "a", "left_semi"), name)
    discard(spark, members)
    equal = stage(spark, alive.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1"), name)
    parts = stage(spark, alive.join(equal, ["a", "b"], "left").select("uid", "first", "count", "lead", "a", "b",
                                                                     F.col("n").isNotNull().alias("settled")), name)
    discard(spark, alive)
    settled, open_ = parts.where("settled"), parts.where("not settled")
    stand_in = settled.groupBy("a", "b").agg(F.min(F.struct("uid", "first", "count", "lead")).alias("r"))
    stand_in = stand_in.join(open_.select("a").distinct(), "a", "left_semi").select("r.*")     # last, so that skew can be split
    return settled.select("uid", "first", "count"), open_.select("uid", "first", "count", "lead").unionByName(stand_in)


def _removed(length: int, keep_text: bool):
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * keep_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc_id, text, runs in zip(b.column(0).to_pylist(), text_bytes(b.column(1)), b.column(2).to_pylist()):
                spans, kept = 0, text
                if runs:
                    edge = np.zeros(len(text) + 1, np.int32)
                    at = np.array([(r["first"], r["first"] + r["count"] - 1 + length) for r in runs])
                    np.add.at(edge, at[:, 0], 1)
                    np.add.at(edge, at[:, 1], -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((doc_id, len(text), len(text) - len(kept), spans, hashlib.sha256(kept).hexdigest(), kept))
            types = [pa.int64()] * 4 + [pa.string()] + [pa.binary()] * keep_text
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)

    return run


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, q: int = Q, id_col: str = "doc_id",
                   text_col: str = "text", keep_text: bool = False, stretch: int = STRETCH) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256(, kept)), one per document row."""
    if not 8 <= q < length:
        raise ValueError("q must be at least 8 and below length")
    if not length <= stretch <= (1 << POSITION_BITS) - 4 * length:
        raise ValueError("a stretch must hold a window and less than 256 MB")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = bucketed(spark, rows.withColumn("uid", F.monotonically_increasing_id()), "texts", "uid")

    def finer(asked: DataFrame, group: int) -> DataFrame:
        lists = asked.groupBy("uid").agg(F.collect_list(F.struct("first", "count", "lead")).alias("runs"))
        members = texts.select("uid", "text").join(lists, "uid").mapInArrow(_finer(length, group, stretch), MEMBERS)
        return stage(spark, members, f"groups-of-{group}")

    members = stage(spark, texts.select("uid", "text").mapInArrow(_runs(length, q, stretch), MEMBERS), "runs")
    found, asked = refine(spark, members, "run-buckets")
    inside, asked = refine(spark, finer(asked, GROUP), "group-buckets")
    windows = finer(asked, 1)
    equal = stage(spark, windows.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").select("a", "b"), "windows")
    single = windows.join(equal, ["a", "b"], "left_semi").select("uid", "first", "count")

    marks = found.unionByName(inside).unionByName(single)
    marks = stage(spark, marks.groupBy("uid").agg(F.collect_list(F.struct("first", "count")).alias("runs")), "marks")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    return texts.join(marks, "uid", "left").select("doc_id", "text", "runs").mapInArrow(_removed(length, keep_text), schema)
