"""Language identification by cross-parsing against suffix automata.

Training.  A bounded sample of labelled texts per language (at most
``SAMPLE_ROWS`` texts of any length, at most ``MAX_ROW_BYTES`` of each from
the first letter on, up to about ``SAMPLE_BYTES`` of UTF-8, ASCII lower-cased)
is turned into a suffix automaton, which recognises every substring of the
sample.

Prediction.  A text is parsed greedily into the longest phrases that the
automaton recognises.  A phrase costs a pointer, log2 of the largest sample's
size for every language alike, so that a small sample is not cheap to point
into; a byte that the sample lacks is a phrase and costs half a pointer more
(about the 8 bits of a literal).  The language with the fewest normalised
phrases, that is the lowest cost, wins, ties going to the first name.  The
score is the winner's share of 2**-cost over all languages.

Whole texts are parsed, in lanes of LANE bytes that advance together (one
table lookup moves a state of every lane and every language); a phrase also
ends where a lane ends, for every language alike (the README has figures
against an uncut parse).  Languages whose automata make a table of more than
TABLE_ENTRIES are parsed in groups, whose tables are filled one after another.

Edge cases: a null text, or one without any letter, is ``und`` with score 0;
so is every text if no labelled row is left to learn from.  Rows without
text or label are not learnt from; repeated rows give repeated results.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import LOWER, fold, held, sample_ids, slices, text_bytes

SAMPLE_ROWS = 256
SAMPLE_BYTES = 24_576
MAX_ROW_BYTES = 256
LANE = 256
SLICE_BYTES = 1 << 19
TABLE_ENTRIES = 1 << 26
UNKNOWN = "und"
RESULT = "struct<lang: string, score: double>"
FLAG, LACKS = np.int32(1 << 30), np.int32(1 << 29)     # a phrase ends (2 half pointers); the byte is no part of the sample (1 more)


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    held_out_fold: int | None = 0, rows: int = SAMPLE_ROWS, total: int = SAMPLE_BYTES,
                    row_bytes: int = MAX_ROW_BYTES) -> dict[str, bytes]:
    """Language -> sample text, from rows outside the held-out fold."""
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang"))
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    if held_out_fold is not None:
        labelled = labelled.where(F.coalesce(fold() != held_out_fold, F.lit(False)))
    labelled = labelled.withColumn("h", F.xxhash64("doc_id", "lang"))
    picked = sample_ids(labelled.select("lang", "h"), ["lang"], rows)
    texts = labelled.join(F.broadcast(picked), ["lang", "h"], "left_semi")     # at most ``rows`` a language
    cut = F.substring(F.regexp_replace("text", r"^\P{L}+", ""), 1, row_bytes)
    texts = texts.withColumn("text", F.when(F.octet_length("text") <= row_bytes, F.col("text")).otherwise(cut))
    texts = texts.select("lang", "h", "text").dropDuplicates(["lang", "h"])
    out: dict[str, bytes] = {}
    for r in sorted(texts.collect(), key=lambda r: (r["lang"], r["h"])):    # bounded by rows * row_bytes a language
        held = out.get(r["lang"], b"")
        if len(held) < total:
            out[r["lang"]] = held + b"\n" * bool(held) + r["text"].encode()[:row_bytes].decode(errors="ignore").encode()
    return out


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions by state; state 0 is the start and every path from it spells a substring."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(step)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = twin
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
        last = new
    return step


class CrossParser:
    """All languages' automata as tables: table[state + code] = next state, plus FLAG and LACKS.

    A table holds a group of languages, of TABLE_ENTRIES or one language at most; only one is filled at a time.
    """

    def __init__(self, sample: dict[str, bytes]):
        self.langs = sorted(sample)
        texts = [LOWER[np.frombuffer(sample[g], np.uint8)].tobytes() for g in self.langs]
        seen = sorted(set().union(*texts)) if texts else []
        self.code = np.zeros(256, np.int32)
        self.code[seen] = np.arange(1, len(seen) + 1)
        self.width = len(seen) + 1
        self.half_pointer = np.log2(max([2, *(len(t) for t in texts)])) / 2
        self.steps, self.groups, size = [], [], 0
        for g, t in enumerate(texts):
            step = suffix_automaton(t)
            moves = np.array([(s, self.code[c], to) for s, nexts in enumerate(step) for c, to in nexts.items()], np.int32)
            self.steps.append((len(step), moves.reshape(-1, 3)))
            entries = (len(step) + 1) * self.width
            del step
            if not self.groups or size + entries > TABLE_ENTRIES:
                self.groups.append([])
                size = 0
            self.groups[-1].append(g)
            size += entries
        self.filled: tuple[int, np.ndarray, list[int]] = (-1, np.empty(0, np.int32), [])

    def fill(self, group: int) -> tuple[np.ndarray, list[int]]:
        """The group's table and where each of its languages starts."""
        if self.filled[0] != group:
            self.filled = (-1, np.empty(0, np.int32), [])
            width, roots, base = self.width, [], 0
            whole = np.empty(sum(self.steps[g][0] + 1 for g in self.groups[group]) * width, np.int32)
            for g in self.groups[group]:
                n, moves = self.steps[g]
                table = np.full((n + 1, width), -1, np.int32)      # the last state: after a byte unseen in the sample
                table[moves[:, 0], moves[:, 1]] = base + moves[:, 2] * width
                fresh = np.where(table[0] < 0, np.int32(base + n * width) + LACKS, table[0])      # restart with this byte
                table = np.where(table < 0, fresh[None, :] + FLAG, table).astype(np.int32, copy=False)
                table[0] = fresh        # the start of a lane ends no phrase
                whole[base:base + table.size] = table.ravel()
                roots.append(base)
                base += table.size
            self.filled = (group, whole, roots)
        return self.filled[1:]

    def half_pointers(self, texts: list[bytes]) -> np.ndarray:
        """Twice the phrases, and the bytes that the sample lacks, of each text by language."""
        out = np.zeros((len(texts), len(self.langs)))
        for group, members in enumerate(self.groups):
            table, roots = self.fill(group)
            for lo, hi in slices(texts, SLICE_BYTES):
                out[lo:hi, members] = self._parse(texts[lo:hi], table, roots)
        return out

    def _parse(self, part: list[bytes], table: np.ndarray, roots: list[int]) -> np.ndarray:
        out = np.zeros((len(part), len(roots)))
        sizes = np.array([len(t) for t in part])
        lanes = -(-sizes // LANE)
        owner = np.repeat(np.arange(len(part)), lanes)
        if not len(owner):
            return out
        first = np.cumsum(lanes) - lanes
        length = np.minimum(LANE, sizes[owner] - (np.arange(len(owner)) - first[owner]) * LANE)
        order = np.argsort(-length, kind="stable")      # lanes still running are a prefix
        grid = np.zeros((len(owner), LANE), np.int32)
        inside = np.arange(LANE) < length[:, None]
        grid[inside] = self.code[LOWER[np.frombuffer(b"".join(part), np.uint8)]]
        grid = np.ascontiguousarray(grid[order].T)
        running = np.searchsorted(-length[order], -np.arange(LANE), "left")
        state = np.repeat(np.array(roots, np.int32)[:, None], len(owner), axis=1)
        count = np.full((len(roots), len(owner)), 2, np.int32)     # the last phrase
        for i in range(LANE):
            n = running[i]
            if not n:
                break
            state[:, :n] += grid[i, :n]
            went = table.take(state[:, :n])
            count[:, :n] += went >> 29
            state[:, :n] = went & (LACKS - 1)
        for g in range(len(roots)):
            out[:, g] = np.bincount(owner[order], weights=count[g], minlength=len(part))
        return out

    def predict(self, texts: list[bytes]) -> tuple[list[str], np.ndarray]:
        cost = self.half_pointers(texts) * self.half_pointer
        best = cost.argmin(axis=1)
        share = 1 / np.exp2(np.clip(cost.min(axis=1, keepdims=True) - cost, -1000, 0)).sum(axis=1)
        return [self.langs[b] for b in best], share


def predictor(spark: SparkSession, sample: dict[str, bytes]):
    """A column function: text -> struct(lang, score). The samples, a few KB a language, are what is broadcast."""
    sent, name = spark.sparkContext.broadcast(sample), uuid.uuid4().hex

    @F.arrow_udf(RESULT)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parser = held("cross parser", name, lambda: CrossParser(sent.value))       # one a worker, not one a task
        for column in batches:
            langs, scores = parser.predict(text_bytes(column))
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"])

    run = run.asNondeterministic()      # else a filter on the result would run it a second time, in workers of its own

    def predict(text: Column) -> Column:
        unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
        if not sample:
            return unknown
        guess = run(F.coalesce(text.cast("string"), F.lit("")))
        return F.when(F.coalesce(text.cast("string").rlike(r"\p{L}"), F.lit(False)), guess).otherwise(unknown)

    return predict


def identify(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             **options: object) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score), one per document row."""
    predict = predictor(spark, training_sample(docs, id_col, text_col, lang_col, **options))
    rows = docs.select(F.col(id_col).alias("doc_id"), predict(F.col(text_col)).alias("p"))
    return rows.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
                       F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def keep_identified(spark: SparkSession, docs: DataFrame, text_col: str = "text", **options: object) -> DataFrame:
    """The rows of ``docs`` whose language can be told, with that language as lang; ``und`` rows go."""
    lang_col = options.get("lang_col", "lang")
    predict = predictor(spark, training_sample(docs, text_col=text_col, **options))
    rows = docs.withColumn("__told", predict(F.col(text_col))["lang"]).where(F.col("__told") != UNKNOWN)
    return rows.select([F.col("__told").alias(c) if c == lang_col else F.col(f"`{c}`") for c in docs.columns])
