"""Alignment of two tokenizers' tokens over the bytes of the same text, by sparse matrix products.

For a text, the incidence matrix of a tokenizer has a row for each token, a
column for each byte and a one where the token covers the byte.  With A and B
in compressed rows (``Csr``, built here from the tokens' byte ranges):

* A x B-transposed, multiplied row by row after Gustavson (``product``), has
  an entry for each pair of tokens whose ranges overlap: the overlap links,
  with the number of shared bytes as value;
* byte offsets where tokens of both end cut the text into groups; the product
  of the tokens' group incidences has an entry for each pair in one group:
  the shared-group links.  Their number comes from the row sizes alone
  (``product_size``), since a group without inner cuts has many.

Tables.  Texts are encoded once, in slices of about SLICE_BYTES of documents;
``encoded`` stages one row per slice: its documents' figures, the distinct
(A id, B id) pairs that are linked in it, how many of its documents hold each,
and each document's links as positions in that list.  ``link_counts`` sums
documents per pair over the corpus; counts return to the slices by a join on
the pair, where a hot pair has one row a slice (not one a document or link) and
a skewed partition can be split, and a slice's counts are put together again
by slice, which is bounded by the slice's bytes.  Nothing is broadcast but the
highest count of each A id, one number for each id of the vocabulary.

A's tokens come from its rank file (the ids of its JSON file); texts with an
unbroken run of LONG_RUN characters or with code points not yet assigned go to
the JSON file's own library.

Edge cases: null and empty texts, and texts whose tokens do not spell a space
and the text (a tokenizer that rewrites characters), have no tokens: all
figures 0, digest ''.  Rows without id, repeated ids and repeated rows are
documents each, also in the counts.  A text is encoded whole; products run
over blocks of its rows, so that a very long one needs little more than its
tokens.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import held, settled, slices, stage

RANKS, JSON, PIECES = "byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE_BYTES = 1 << 20
BLOCK_BYTES = 1 << 20
LONG_RUN = 4096
B_BITS = 32         # a pair is its A id, shifted by this, and its B id
FIGURES = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, "
           "n_group_links long")
LINKS = "doc_id long, a_at long, b_at long, a_id int, b_id int, n_bytes long"
FIGURE_TYPES = [pa.int64()] * 7 + [pa.string(), pa.int64()]
SLICE = ("slice long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, digests array<string>, "
         "n_group_links array<long>, pairs array<long>, n_docs array<long>, ends array<long>, places binary, times binary")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- matrices ---------------------------------------------------------------

class Csr(NamedTuple):
    """Compressed rows: row i holds columns[starts[i]:starts[i + 1]]."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.starts) - 1


def cover(ends: np.ndarray, lo: int, hi: int) -> Csr:
    """Incidence of tokens lo..hi (by their ends; a token begins where the one before ends) with the bytes."""
    first = ends[lo - 1] if lo else 0
    starts = np.concatenate([[first], ends[lo:hi]]) - first
    return Csr(starts, np.arange(first, ends[hi - 1] if hi > lo else first), int(ends[-1]) if len(ends) else 0)


def singles(column: np.ndarray, width: int) -> Csr:
    """One entry a row: byte -> token, token -> group."""
    return Csr(np.arange(len(column) + 1), column, width)


def transposed(m: Csr) -> Csr:
    """By counting sort of the columns."""
    rows = np.repeat(np.arange(m.height), np.diff(m.starts))
    starts = np.zeros(m.width + 1, np.int64)
    np.cumsum(np.bincount(m.columns, minlength=m.width), out=starts[1:])
    return Csr(starts, rows[np.argsort(m.columns, kind="stable")], m.height)


def product(a: Csr, b: Csr) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gustavson: each row of a x b is the sum of the rows of b that the row of a names. Gives (row, column, value)."""
    lengths = b.starts[a.columns + 1] - b.starts[a.columns]
    row = np.repeat(np.repeat(np.arange(a.height), np.diff(a.starts)), lengths)
    begin = np.repeat(b.starts[a.columns] - (np.cumsum(lengths) - lengths), lengths)
    key = row * np.int64(b.width) + b.columns[begin + np.arange(len(row))]
    if len(key) and (np.diff(key) < 0).any():       # a row's entries meet in its accumulator
        key = np.sort(key, kind="stable")
    first = np.flatnonzero(np.diff(key, prepend=-1))
    value = np.diff(np.append(first, len(key)))
    return key[first] // max(1, b.width), key[first] % max(1, b.width), value


def product_size(a: Csr, b: Csr) -> int:
    """How many terms the product has, without forming them (no two fall together if a or b has one entry a row)."""
    return int((b.starts[a.columns + 1] - b.starts[a.columns]).sum())


# ---- tokens of a text -------------------------------------------------------

class Pair:
    """Both tokenizers with the bytes of their tokens."""

    def __init__(self, ranks: str, json: str, pieces: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.whole = Tokenizer.from_file(json)
        self.whole.encode_special_tokens = True
        self.slow = re.compile(r"\S{%d}|\s{%d}" % (LONG_RUN, LONG_RUN))
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.a_bytes: list[bytes] = [b""] * (1 + max(table.values()))
        for token, i in table.items():
            self.a_bytes[i] = token
        spelt = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(spelt)]
        self.a_size, self.b_size = (np.array([len(t) for t in s], np.int64) for s in (self.a_bytes, self.b_bytes))
        # Four spellings of an id in the digest: before the next id of its group, and at its side's end.
        self.said = [f"{i}{end}" for s, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for end in ends for i in range(len(s))]

    def ids(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids by A of a space and the text, by B of the text; none where they do not spell that."""
        out = []
        for text, b in zip(texts, self.b.encode(texts, num_threads=1) if texts else []):
            spaced, a = " " + text, []
            if text:
                odd = self.slow.search(text) or not settled(text)
                a = self.whole.encode(spaced, add_special_tokens=False).ids if odd else self.a.encode_ordinary(spaced)
                raw = spaced.encode()
                if b"".join(map(self.b_bytes.__getitem__, b)) != raw or b"".join(map(self.a_bytes.__getitem__, a)) != raw:
                    a = []
            out.append((a, b if a else []))
        return out


class Aligned:
    """Texts one behind the other as one range of bytes: tokens, groups and links of each."""

    def __init__(self, pair: Pair, ids: list[tuple[list[int], list[int]]]):
        self.pair = pair
        self.n_a, self.n_b = (np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1))
        self.a, self.b = (np.array([i for x in ids for i in x[k]], np.int64) for k in (0, 1))
        self.a_end, self.b_end = np.cumsum(pair.a_size[self.a]), np.cumsum(pair.b_size[self.b])
        self.cuts = np.intersect1d(self.a_end, self.b_end, assume_unique=True)
        self.a_group, self.b_group = np.searchsorted(self.cuts, self.a_end), np.searchsorted(self.cuts, self.b_end)
        self.last_a = np.cumsum(self.n_a)
        text_of_a = np.repeat(np.arange(len(ids)), self.n_a)
        self.text_of_a = text_of_a
        ends = np.concatenate([[0], self.a_end])[self.last_a]           # where each text ends
        self.n_groups = np.diff(np.searchsorted(self.cuts, ends, "right"), prepend=0)

    def overlaps(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(a token, b token, shared bytes) of the overlap links, by blocks of A's rows."""
        byte_of = singles(np.repeat(np.arange(len(self.b)), self.pair.b_size[self.b]), len(self.b))      # B transposed: a token a byte
        lo = 0
        while lo < len(self.a):
            start = self.a_end[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(self.a_end, start + BLOCK_BYTES)))
            row, column, value = product(cover(self.a_end, lo, hi), byte_of)
            yield row + lo, column, value
            lo = hi

    def group_rows(self) -> tuple[Csr, Csr]:
        """Group incidence of A's tokens, and B's transposed."""
        n = len(self.cuts)
        return singles(self.a_group, n), transposed(singles(self.b_group, n))

    def group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(a token, b token) of the shared-group links, by blocks of A's rows."""
        a, b = self.group_rows()
        sizes = np.cumsum(np.diff(b.starts)[self.a_group])
        lo = 0
        while lo < len(self.a):
            hi = max(lo + 1, int(np.searchsorted(sizes, (sizes[lo - 1] if lo else 0) + BLOCK_BYTES)))
            row, column, _ = product(Csr(np.arange(hi - lo + 1), a.columns[lo:hi], a.width), b)
            yield row + lo, column
            lo = hi

    def group_link_counts(self) -> np.ndarray:
        a, b = self.group_rows()
        at = np.concatenate([[0], self.last_a])
        return np.array([product_size(Csr(np.arange(hi - lo + 1), a.columns[lo:hi], a.width), b) for lo, hi in zip(at[:-1], at[1:])], np.int64)

    def digests(self) -> list[str]:
        """sha256 of the groups' ids, text by text."""
        n_a, n_b = len(self.pair.a_bytes), len(self.pair.b_bytes)
        a_last, b_last = np.diff(self.a_group, append=-1) != 0, np.diff(self.b_group, append=-1) != 0
        word = np.concatenate([self.a + n_a * a_last, 2 * n_a + self.b + n_b * b_last])
        side = np.concatenate([self.a_group * 2, self.b_group * 2 + 1])
        word = word[np.argsort(side, kind="stable")].tolist()
        out, at = [], 0
        for size in (self.n_a + self.n_b).tolist():
            said = "".join(map(self.pair.said.__getitem__, word[at:at + size]))
            out.append(hashlib.sha256(said[:-1].encode()).hexdigest() if size else "")
            at += size
        return out


# ---- tables -----------------------------------------------------------------

def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def _slices(batches: Iterator[pa.RecordBatch], pair: Pair) -> Iterator[tuple[list[int | None], Aligned]]:
    """Documents of about SLICE_BYTES, aligned."""
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
        for lo, hi in slices(texts, SLICE_BYTES):
            yield ids[lo:hi], Aligned(pair, pair.ids(texts[lo:hi]))


def _paths(paths: tuple[str, str, str] | None) -> tuple[str, str, str]:
    return paths or (vocabulary(RANKS), vocabulary(JSON), vocabulary(PIECES))


def token_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", paths: tuple[str, str, str] | None = None) -> DataFrame:
    """The overlap links themselves: rows (doc_id, a_at, b_at, a_id, b_id, n_bytes), positions counted from 0 in each text."""
    paths = _paths(paths)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = held("token pair", paths, lambda: Pair(*paths))
        for ids, x in _slices(batches, pair):
            owner = np.array([-1 if i is None else i for i in ids], np.int64)
            unknown = np.array([i is None for i in ids])
            first_a, first_b = np.cumsum(x.n_a) - x.n_a, np.cumsum(x.n_b) - x.n_b
            for a, b, n in x.overlaps():
                t = x.text_of_a[a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owner[t], mask=unknown[t]), pa.array(a - first_a[t]), pa.array(b - first_b[t]), pa.array(x.a[a].astype(np.int32)),
                     pa.array(x.b[b].astype(np.int32)), pa.array(n)], [c.split()[0] for c in LINKS.split(", ")])

    return _texts(docs, id_col, text_col).mapInArrow(run, LINKS)


def encoded(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            paths: tuple[str, str, str] | None = None) -> DataFrame:
    """The staged table of slices."""
    paths = _paths(paths)
    names = [c.split()[0] for c in SLICE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, shard, k = held("token pair", paths, lambda: Pair(*paths)), TaskContext.get().partitionId(), 0
        for ids, x in _slices(batches, pair):
            key, text = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for a, b, _ in x.overlaps():
                key.append((x.a[a] << B_BITS) + x.b[b])
                text.append(x.text_of_a[a])
            pairs, place = np.unique(np.concatenate(key), return_inverse=True)
            text = np.concatenate(text)
            entry, times = np.unique(text * np.int64(len(pairs)) + place, return_counts=True)      # a document's distinct pairs
            owner, place = entry // max(1, len(pairs)), entry % max(1, len(pairs))
            row = [(shard << 32) + k, ids, x.n_a, x.n_b, x.n_groups, np.bincount(text, minlength=len(ids)), x.digests(), x.group_link_counts(),
                   pairs, np.bincount(place, minlength=len(pairs)), np.cumsum(np.bincount(owner, minlength=len(ids))),
                   place.astype("<i4").tobytes(), times.astype("<i4").tobytes()]
            types = [pa.int64()] + [pa.list_(pa.int64())] * 5 + [pa.list_(pa.string())] + [pa.list_(pa.int64())] * 4 + [pa.binary()] * 2
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)], names)
            k += 1

    return stage(spark, _texts(docs, id_col, text_col).mapInArrow(run, SLICE), "aligned-slices", **{"parquet.block.size": 16 << 20})


def link_counts(spark: SparkSession, table: DataFrame) -> DataFrame:
    """Rows (pair, n, best): documents of the corpus that hold the id pair linked; best if no pair of its A id has more."""
    part = table.select(F.explode(F.arrays_zip("pairs", "n_docs")).alias("p")).select("p.pairs", "p.n_docs")
    counts = stage(spark, part.groupBy(F.col("pairs").alias("pair")).agg(F.sum("n_docs").alias("n")), "link-counts")
    counts = counts.withColumn("a_id", F.shiftright("pair", B_BITS))
    highest = counts.groupBy("a_id").agg(F.max("n").alias("most"))       # at most one row for each id of A's vocabulary
    return counts.join(F.broadcast(highest), "a_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _figures(told: pa.Table, rows: pa.Table) -> pa.Table:
    """A slice's documents, from its row and the corpus counts of its pairs."""
    names = [c.split()[0] for c in FIGURES.split(", ")]
    if not rows.num_rows:
        return pa.table([pa.array([], t) for t in FIGURE_TYPES], names)
    row = rows.to_pylist()[0]
    at, n = told.column("at").to_numpy(), told.column("n").to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    count[at], best[at] = n, told.column("best").to_numpy(zero_copy_only=False)
    place, times = np.frombuffer(row["places"], "<i4"), np.frombuffer(row["times"], "<i4").astype(np.int64)
    last = np.array(row["ends"], np.int64)

    def summed(values: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(values[place] * times)])[np.concatenate([[0], last])])

    columns = [row["doc_ids"], row["n_a"], row["n_b"], row["n_groups"], row["n_links"], summed(best), summed(count), row["digests"],
               row["n_group_links"]]
    return pa.table([pa.array(c, t) for c, t in zip(columns, FIGURE_TYPES)], names)


def align(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          paths: tuple[str, str, str] | None = None) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, n_group_links), one per document row."""
    table = encoded(spark, docs, id_col, text_col, paths)
    counts = stage(spark, link_counts(spark, table), "best-links")
    asked = table.select(F.col("slice").alias("part"), F.posexplode("pairs").alias("at", "pair"))
    told = asked.join(counts, "pair").select("part", "at", "n", "best")
    whole = table.drop("pairs", "n_docs")
    return told.groupBy("part").cogroup(whole.groupBy("slice")).applyInArrow(_figures, FIGURES)
