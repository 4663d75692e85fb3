"""Token counts of whole texts by a two-tier lookup of pre-token lengths.

A byte-level BPE cuts a text into pre-tokens by a pattern and encodes each by
itself, so a text's count is the sum of its pre-tokens' lengths in tokens.

Tier 1.  The TABLE_ENTRIES most frequent pre-tokens of a bounded sample (at
most SAMPLE_ROWS texts from all over the table, SAMPLE_CHARS of each) and
their lengths are broadcast as one compact table (see ``Table``): about a
MB, bounded by TABLE_ENTRIES and KEY_BYTES whatever the input.
Tier 2.  Other pre-tokens are encoded and kept in the worker's cache of at
most CACHE_ENTRIES, which serves all later tasks of that worker.  Short ones
are encoded from the vocabulary file's merges by the faster of two libraries,
where the file's ids follow the order of its merges (else, and long ones, by
the file's own library; a test holds both equal).

No pre-token is shuffled: sampling tasks send their own most frequent
pre-tokens to the driver, and documents are counted where they are read.
The sample only decides what is looked up where, never a count.

What the pattern's engine and the library's could see differently goes to the
library whole: pieces with a code point that is not assigned yet.  Texts over
PIECE_CHARS are cut between a character and the white space after it, where
the pattern always cuts, so memory stays bounded unless a text has no space.

Edge cases: null and empty texts have 0 bytes and 0 tokens; added tokens of
the vocabulary inside a text count as one each, as by the library's default;
rows without id, repeated rows and repeated ids are counted row by row; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import byte_level, held, sample_ids, settled

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 512
SAMPLE_ROWS = 4096
SAMPLE_CHARS = 4096
TABLE_ENTRIES = 1 << 17
KEY_BYTES = 64
CACHE_ENTRIES = 1 << 19
PIECE_CHARS = 1 << 18
RESULT = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Table:
    """Frequent pre-tokens and their lengths: sorted keys in one byte string, ends and lengths as small integers."""

    def __init__(self, lengths: dict[str, int]):
        keys = sorted(lengths)
        self.keys = "".join(keys)
        self.sizes = np.array([len(k) for k in keys], np.uint8)
        self.lengths = np.array([lengths[k] for k in keys], np.uint8)

    def hashed(self) -> dict[str, int]:
        ends = np.cumsum(self.sizes, dtype=np.int64).tolist()
        return {self.keys[b - s:b]: n for b, s, n in zip(ends, self.sizes.tolist(), self.lengths.tolist())}


class PreTokens:
    """Cuts texts as the vocabulary's tokenizer does; encodes what it is asked for."""

    def __init__(self, path: str):
        import json

        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as f:
            plan = json.load(f)
        cut, added = plan["pre_tokenizer"], plan["added_tokens"]
        if (cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or plan["normalizer"] or plan["post_processor"]
                or any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)):
            raise ValueError(f"{path} is no plain byte-level BPE")
        # The byte-level pattern (fixed value of the public format).
        self.find = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+").findall
        self.added = regex.compile("|".join(regex.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"]))) or r"(?!)")
        self.ranked = self._ranked(plan["model"])
        self.seam, self.tokenizer = regex.compile(r"(?<=[!-~])(?=[ \n])"), Tokenizer.from_file(path)

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The text between its added tokens, in pieces of about PIECE_CHARS, and how many added tokens there are."""
        parts = self.added.split(text)
        if len(text) <= PIECE_CHARS:
            return parts, len(parts) - 1
        out = []
        for part in parts:
            at = 0
            while len(part) - at > PIECE_CHARS and (m := self.seam.search(part, at + PIECE_CHARS)):
                out.append(part[at:m.start()])
                at = m.start()
            out.append(part[at:])
        return out, len(parts) - 1

    @staticmethod
    def _ranked(model: dict):
        """bytes -> ids by the ranks of the file's merges, if its ids follow their order."""
        import tiktoken

        byte = byte_level()
        pairs = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        made = [model["vocab"].get(p.replace(" ", "")) for p in pairs]
        if model.get("ignore_merges") or None in made or any(a >= b for a, b in zip(made, made[1:])):
            return None
        ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if all(c in byte for c in t)}
        return tiktoken.Encoding("merges", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def lengths(self, tokens: list[str]) -> list[int]:
        if self.ranked:
            return [len(self.ranked(t)) if len(t) <= KEY_BYTES else self.length(t) for t in tokens]
        return [len(e) for e in self.tokenizer.encode_batch_fast(tokens, add_special_tokens=False)]

    def length(self, text: str) -> int:
        """By the file's own library."""
        return len(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0])


class TwoTier:
    """Counts by the broadcast table, then by this worker's cache, then by the library."""

    def __init__(self, cutter: PreTokens, table: dict[str, int]):
        self.cutter, self.table, self.cache = cutter, table, {}

    def missing(self, tokens: list[str]) -> int:
        """Tokens of pre-tokens that the table lacks."""
        known = list(map(self.cache.get, tokens))
        if None not in known:
            return sum(known)
        rest = Counter(t for t, k in zip(tokens, known) if k is None)
        new = list(rest)
        lengths = self.cutter.lengths(new)
        if len(self.cache) + len(new) > CACHE_ENTRIES:
            self.cache.clear()
        self.cache.update((t, k) for t, k in zip(new, lengths) if len(t) <= KEY_BYTES)
        return sum(k for k in known if k is not None) + sum(rest[t] * k for t, k in zip(new, lengths))

    def count(self, texts: list[str]) -> list[int]:
        get, out = self.table.get, []
        for text in texts:
            pieces, n = self.cutter.pieces(text)
            for piece in pieces:
                if not settled(piece):
                    n += self.cutter.length(piece)
                    continue
                tokens = self.cutter.find(piece)
                known = list(map(get, tokens))
                if None in known:
                    n += self.missing([t for t, k in zip(tokens, known) if k is None])
                    n += sum(k for k in known if k is not None)
                else:
                    n += sum(known)
            out.append(n)
        return out


def frequent(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
             entries: int = TABLE_ENTRIES, rows: int = SAMPLE_ROWS) -> Table:
    """The table of frequent pre-tokens of a bounded sample."""
    path = path or vocabulary()
    ids = docs.select(F.xxhash64(F.col(id_col)).alias("h"))
    picked = sample_ids(ids, [], rows).dropDuplicates(["h"])                  # at most ``rows`` hashes
    texts = docs.select(F.xxhash64(F.col(id_col)).alias("h"), F.substring(F.col(text_col).cast("string"), 1, SAMPLE_CHARS).alias("text"))
    texts = texts.join(F.broadcast(picked), "h", "left_semi").dropDuplicates(["h"]).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, seen = held("pretokens", path, lambda: PreTokens(path)), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                for piece in cutter.pieces(text or "")[0]:
                    seen.update(t for t in cutter.find(piece) if len(t) <= KEY_BYTES and settled(t))
        top = seen.most_common(entries)
        if top:
            tokens, counts = zip(*top)
            lengths = cutter.lengths(list(tokens))
            yield pa.RecordBatch.from_arrays([pa.array([list(tokens)]), pa.array([list(counts)]), pa.array([lengths])], ["token", "n", "length"])

    seen, lengths = Counter(), {}
    for r in texts.mapInArrow(run, "token array<string>, n array<long>, length array<long>").toLocalIterator():
        seen.update(dict(zip(r["token"], r["n"])))
        lengths.update(zip(r["token"], r["length"]))
        if len(seen) > 4 * entries:
            seen = Counter(dict(seen.most_common(2 * entries)))
            lengths = {t: lengths[t] for t in seen}
    return Table({t: lengths[t] for t, _ in seen.most_common(entries)})


def token_counts(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 limit: int = LIMIT, **options: int) -> DataFrame:
    """Rows (doc_id, n_bytes, n_tokens, over_limit), one per document row."""
    path, name = path or vocabulary(), uuid.uuid4().hex
    table = spark.sparkContext.broadcast(frequent(spark, docs, id_col, text_col, path, **options))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = held("pretokens", path, lambda: PreTokens(path))
        counter = held("token counter", name, lambda: TwoTier(cutter, table.value.hashed()))
        for batch in batches:
            for lo in range(0, max(1, batch.num_rows), 256):
                part = batch.slice(lo, 256)
                texts = [t or "" for t in part.column(1).to_pylist()]
                n = np.array(counter.count(texts), np.int64)
                size = np.array([len(t.encode()) for t in texts], np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(size), pa.array(n), pa.array(n > limit)],
                                                 ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return rows.mapInArrow(run, RESULT)
