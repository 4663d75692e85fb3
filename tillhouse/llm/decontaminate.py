"""Benchmark decontamination by a distributed positional inverted index.

Index.  The corpus is cut into blocks of whole documents (about BLOCK_BYTES
of text; a longer document is a block of its own).  A block's row stores the
postings of all its words: the sorted 64-bit term hashes, where each term's
posting list begins, and the word positions, ascending within a term.  Blocks
are independent, so no term's list ever meets in one task, however frequent
the word, and the index serves any number of test sets.

Search.  The test items are dealt into packs of bounded size (PACK_BYTES; the
pack is what a task holds).  In each block a window's terms are looked up and
ordered by their posting counts; the rarest term's positions, shifted by its
offset in the window, are the candidates, and each next term's shifted list
is intersected with them until none is left.  What survives is an exact
phrase match.  A proximity match needs every term of the window within
``slop`` words of an occurrence of the rarest one, in the same document.

Words: A-Z lower-cased, runs matching ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
Windows: ``window`` consecutive item words, a shorter item being one window.
Terms are compared by 64-bit hashes; a window of 10 words compares 10 of them.

Edge cases: a null or wordless text has no words and no matches; a null or
wordless item has no windows; items without id are not searched; items that
share an id count as one; repeated document rows give repeated result rows;
empty documents or benchmark give zero matches; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import Rolling, joined, slices, stage, text_bytes, word_spans

WINDOW = 10
BLOCK_BYTES = 1 << 20
PACK_BYTES = 4 << 20
ROLL = Rolling(0x2545F4914F6CDD1D)

INDEX = ("block long, n_words long, doc_ids binary, doc_known binary, doc_first binary, "
         "terms binary, list_first binary, positions binary")
MATCHES = ("doc_id long, block long, ord int, n_words long, "
           "spans array<struct<item: string, start: long, length: long>>, "
           "near array<struct<item: string, start: long>>")


def term_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All words' hashes in order, and the first word of each text (one more at the end)."""
    buf, starts = joined(texts)
    a, b = word_spans(buf)
    return ROLL.of(ROLL.prefix(buf), a, b), np.searchsorted(a, starts)


def build_index(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The stored index, one row per block."""
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0), text_bytes(batch.column(1))
            for lo, hi in slices(texts, block_bytes):
                hashes, first = term_hashes(texts[lo:hi])
                order = np.argsort(hashes, kind="stable").astype(np.uint32)
                ranked = hashes[order]
                new = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]]) if len(ranked) else np.empty(0, np.int64)
                own = ids.slice(lo, hi - lo)
                row = [(task << 32) + k, len(hashes), own.fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes(),
                       own.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8).tobytes(),
                       first.astype("<u4").tobytes(), ranked[new].astype("<u8").tobytes(),
                       np.r_[new, len(hashes)].astype("<u4").tobytes(), order.astype("<u4").tobytes()]
                k += 1
                types = [pa.int64()] * 2 + [pa.binary()] * 6
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                                 [c.split()[0] for c in INDEX.split(", ")])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return stage(spark, rows.mapInArrow(blocks, INDEX), "postings", **{"parquet.block.size": 16 << 20})


class Pack:
    """The windows of some test items: a matrix of term numbers, -1 beyond a short item's end."""

    def __init__(self, ids: list[str], texts: list[bytes], window: int):
        self.ids = ids
        hashes, first = term_hashes(texts)
        self.terms, numbers = np.unique(hashes, return_inverse=True)
        starts, owner, sizes = [], [], []
        for k, (a, b) in enumerate(zip(first[:-1], first[1:])):
            if b > a:
                n = max(1, b - a - window + 1)
                starts.append(np.arange(a, a + n))
                owner.append(np.full(n, k))
                sizes.append(np.full(n, min(window, b - a)))
        cat = lambda v: np.concatenate(v) if v else np.empty(0, np.int64)
        starts, self.owner, self.size = cat(starts), cat(owner), cat(sizes)
        at = starts[:, None] + np.arange(window)
        inside = np.arange(window) < self.size[:, None]
        self.words = np.where(inside, numbers[np.minimum(at, max(0, len(numbers) - 1))] if len(numbers) else 0, -1)


def search_block(row: dict, pack: Pack, slop: int | None):
    """(window, start position) of phrase matches and (window, anchor position) of proximity matches."""
    terms = np.frombuffer(row["terms"], "<u8")
    first = np.frombuffer(row["list_first"], "<u4").astype(np.int64)
    positions = np.frombuffer(row["positions"], "<u4").astype(np.int64)
    doc_first = np.frombuffer(row["doc_first"], "<u4").astype(np.int64)
    phrase, near = [], []
    if not len(terms) or not len(pack.owner):
        return phrase, near
    at = np.minimum(np.searchsorted(terms, pack.terms), len(terms) - 1)
    count = np.where(terms[at] == pack.terms, first[at + 1] - first[at], 0)
    inside = pack.words >= 0
    counts = np.where(inside, count[pack.words], np.iinfo(np.int64).max)
    for w in np.flatnonzero(counts.min(axis=1) > 0):
        order = np.argsort(counts[w], kind="stable")[:pack.size[w]]
        lists = [positions[first[at[t]]:first[at[t] + 1]] for t in pack.words[w, order]]
        start = lists[0] - order[0]
        start = start[start >= 0]
        for held, offset in zip(lists[1:], order[1:]):
            if not len(start):
                break
            k = np.minimum(np.searchsorted(held, start + offset), len(held) - 1)
            start = start[held[k] == start + offset]
        if len(start):      # all words in one document
            same = np.searchsorted(doc_first, start, "right") == np.searchsorted(doc_first, start + pack.size[w] - 1, "right")
            phrase += [(w, s) for s in start[same]]
        if slop is not None:
            anchor = lists[0]
            doc = np.searchsorted(doc_first, anchor, "right")
            lo = np.maximum(doc_first[doc - 1], anchor - slop)
            hi = np.minimum(doc_first[doc], anchor + slop + 1)
            for held in lists[1:]:
                k = np.searchsorted(held, lo)
                ok = (k < len(held)) & (held[np.minimum(k, len(held) - 1)] < hi)
                anchor, lo, hi = anchor[ok], lo[ok], hi[ok]
            near += [(w, s) for s in anchor]
    return phrase, near


def _search(pack_of, slop: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = pack_of()
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                ids = np.frombuffer(row["doc_ids"], "<i8")
                known = np.frombuffer(row["doc_known"], np.uint8)
                doc_first = np.frombuffer(row["doc_first"], "<u4").astype(np.int64)
                spans: list[list] = [[] for _ in ids]
                around: list[list] = [[] for _ in ids]
                phrase, near = search_block(row, pack, slop)
                runs: dict = {}     # adjoining matches of an item make one span
                for item, s, n in sorted((int(pack.owner[w]), int(s), int(pack.size[w])) for w, s in phrase):
                    doc = int(np.searchsorted(doc_first, s, "right")) - 1
                    last = runs.get((item, doc))
                    if last is not None and s <= last[1]:
                        last[1] = max(last[1], s + n)
                    else:
                        runs[(item, doc)] = last = [s, s + n]
                        spans[doc].append((item, last))
                for w, s in near:
                    doc = int(np.searchsorted(doc_first, s, "right")) - 1
                    around[doc].append((pack.ids[pack.owner[w]], int(s - doc_first[doc])))
                yield pa.RecordBatch.from_arrays([
                    pa.array([int(i) if ok else None for i, ok in zip(ids, known)], pa.int64()),
                    pa.array([row["block"]] * len(ids), pa.int64()),
                    pa.array(range(len(ids)), pa.int32()),
                    pa.array(np.diff(doc_first), pa.int64()),
                    pa.array([[{"item": pack.ids[i], "start": a - int(doc_first[d]), "length": b - a} for i, (a, b) in v]
                              for d, v in enumerate(spans)],
                             pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64()), ("length", pa.int64())]))),
                    pa.array([[{"item": i, "start": s} for i, s in sorted(set(v))] for v in around],
                             pa.list_(pa.struct([("item", pa.string()), ("start", pa.int64())]))),
                ], ["doc_id", "block", "ord", "n_words", "spans", "near"])

    return run


def find_matches(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int = WINDOW, slop: int | None = None,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", index: DataFrame | None = None) -> DataFrame:
    """One row per document row: doc_id, n_words, spans (exact matches by item, in words) and near (proximity matches)."""
    index = build_index(spark, docs, id_col, text_col) if index is None else index
    tests = items.select(F.col(item_col).cast("string").alias("item"), F.col(item_text_col).cast("string").alias("text"))
    tests = tests.where("item is not null and text is not null").distinct()
    size = tests.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    packs = 1 + size // PACK_BYTES
    found = []
    for p in range(packs):      # each pack is a bounded part of the test set; its driver copy is freed before the next
        rows = tests.where(F.pmod(F.xxhash64("item", "text"), F.lit(packs)) == p).collect()
        held = spark.sparkContext.broadcast(([r["item"] for r in rows], [r["text"].encode() for r in rows]))
        made: dict = {}

        def pack_of(held=held, made=made):
            if "pack" not in made:
                made["pack"] = Pack(*held.value, window)
            return made["pack"]

        found.append(stage(spark, index.mapInArrow(_search(pack_of, slop), MATCHES), "matches"))
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    return every.groupBy("block", "ord").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("near")).alias("near"),
    ).drop("block", "ord")


def covered(spans: str = "spans") -> F.Column:
    """Words inside any span: the spans in order, each adding what lies beyond the end so far."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), (s["start"] + s["length"]).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("sum"))
    return F.aggregate(ordered, zero, lambda acc, s: F.struct(
        F.greatest(acc["end"], s["b"]).alias("end"),
        (acc["sum"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(acc["end"], s["a"]))).alias("sum")),
        lambda acc: acc["sum"])


def contamination(spark: SparkSession, docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """find_matches plus n_hit, the matched item ids (sorted as strings) and contaminated."""
    m = find_matches(spark, docs, items, **options)
    return (m.withColumn("n_hit", covered())
            .withColumn("items", F.array_sort(F.array_distinct(F.transform("spans", lambda s: s["item"]))))
            .withColumn("contaminated", F.col("n_hit") > 0))


def remove_contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """The rows of ``docs`` that hold no window of a test item."""
    # Rows are told apart by a key of their own, written once: ids can be missing or repeated.
    rows = stage(spark, docs.withColumn("__row", F.monotonically_increasing_id()), "keyed-rows")
    c = contamination(spark, rows, items, id_col="__row", **options)
    bad = c.where("contaminated").select(F.col("doc_id").alias("__row"))
    return rows.join(bad, "__row", "left_anti").drop("__row")
