"""Helpers shared by the operators: staged tables, labelled samples, connected components, byte buffers."""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.session import ensure_checkpoint_dir


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def stage(spark: SparkSession, df: DataFrame, name: str, **options: object) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    This cuts the lineage: a lost executor costs the tasks that read the
    table, never the Python work that made it.
    """
    path = shared_dir(spark, name)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(spark: SparkSession, df: DataFrame, name: str, column: str) -> DataFrame:
    """Like ``stage``, with the rows in buckets of ``column``: joins on it then move only their other side."""
    n, table = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{name}_{uuid.uuid4().hex}"
    (df.repartition(n, column).write.bucketBy(n, column).sortBy(column)
     .options(path=shared_dir(spark, name), compression="zstd").saveAsTable(table, format="parquet"))
    return spark.table(table)


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more (all that was made of it is written)."""
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fold(doc_id: str = "doc_id") -> F.Column:
    """crc32 of the id's text, modulo 5; fold 0 is held out of every training."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def sample_ids(rows: DataFrame, strata: list[str], per_stratum: int) -> DataFrame:
    """A bounded, repeatable sample: at most ``per_stratum`` rows of each stratum.

    ``rows`` holds the strata and a long ``h``.  Each stratum is dealt into
    ``per_stratum`` cells by h, and the smallest h of each cell is taken: two
    hash aggregates over longs, with partial sums before the shuffle.
    """
    cell = F.pmod(F.col("h"), F.lit(per_stratum))
    return rows.groupBy(*strata, cell.alias("cell")).agg(F.min("h").alias("h")).select(*strata, "h")


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b: long): rows (node, root), root = smallest node reachable.

    Alternates large-star and small-star steps; every step is a partial
    aggregate (the smallest neighbour) and an equi-join, checkpointed to the
    shared folder.  The number of rounds grows with the logarithm of the
    longest chain.  Nodes without an edge are not in the result.
    """
    ensure_checkpoint_dir(spark)
    e = (edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
         .distinct().checkpoint())

    def mark(df: DataFrame):
        r = df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("s")).first()
        return r["n"], r["s"]

    state = mark(e)
    while state[0]:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(low, "u")
        e = (near.select(F.col("u"), F.col("m").alias("v"))
             .union(near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
             .distinct().checkpoint())
        new = mark(e)
        if new == state:
            break
        state = new
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def merge_labels(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Union the groups of linked positions i, j; labels are the smallest positions of their groups."""
    while True:
        a, b = labels[i], labels[j]
        apart = a != b
        if not apart.any():
            return labels
        np.minimum.at(labels, np.maximum(a[apart], b[apart]), np.minimum(a[apart], b[apart]))
        while True:
            up = labels[labels]
            if np.array_equal(up, labels):
                break
            labels = up


# ---- texts as byte buffers -------------------------------------------------

def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def slices(texts: list[bytes], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts holding about ``limit`` bytes; a longer text stands alone."""
    lo = held = 0
    for k, t in enumerate(texts):
        if held and held + len(t) > limit:
            yield lo, k
            lo, held = k, 0
        held += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
WORD = np.zeros(256, dtype=bool)
WORD[ord("0"):ord("9") + 1] = WORD[ord("a"):ord("z") + 1] = WORD[0x80:] = True


def joined(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """One buffer of the texts with a space after each, and where each begins (one more at the end)."""
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return (LOWER[buf] if lower else buf), starts


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word: a run of digits, lower-case ASCII letters and non-ASCII bytes."""
    inside = np.zeros(len(buf) + 2, dtype=np.int8)
    inside[1:-1] = WORD[buf]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


class Rolling:
    """64-bit polynomial hashes of any substrings of a buffer, from one prefix sum.

    hash(a, b) = (S[b] - S[a]) * base**-a modulo 2**64, mixed; equal
    substrings have equal hashes wherever they stand.
    """

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.power, self.back = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        for name, base in (("power", self.base), ("back", self.inverse)):
            have = getattr(self, name)
            while len(have) < n:
                step = np.uint64(pow(base, len(have), 1 << 64))
                have = np.concatenate([have, have * step])
            setattr(self, name, have)

    def prefix(self, buf: np.ndarray) -> np.ndarray:
        self._grow(len(buf) + 1)
        out = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * self.power[:len(buf)], out=out[1:])
        return out

    def of(self, prefix: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((prefix[b] - prefix[a]) * self.back[a] + (b - a).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


# ---- state of a Python worker, tokenizers ----------------------------------

def held(slot: str, key: object, make):
    """What ``make()`` gave for this key in this worker process; it outlives the task, until the slot gets another key."""
    import sys
    import types

    store = sys.modules.setdefault("_tillhouse_held", types.ModuleType("_tillhouse_held")).__dict__
    if slot not in store or store[slot][0] != key:
        store[slot] = key, make()
    return store[slot][1]


def byte_level() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 characters stand for their own byte, 256.. for the others in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


PLAIN = re.compile("[^\\x00-\u0377\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a0-\u30ff\u4e00-\u9fff\uac00-\ud7a3]")


def settled(text: str) -> bool:
    """No code point that is not assigned yet: on the class of those, Unicode tables of different age differ."""
    if text.isascii() or not PLAIN.search(text):
        return True
    return all(unicodedata.category(c) != "Cn" for c in set(text))
