"""Toxicity scores from a weighted finite-state pattern grammar.

Words become symbols: insult, threat, target, negation, report, clause
boundary, or other.  Three transducers rewrite the symbol string and are
composed into one machine:

* negation: an insult or threat within SCOPE words after a negation is softened;
* reported speech: after a reporting word, up to the clause's end, it is reported;
* target: within REACH words of a target, before or after, it is directed.

The composed machine's outputs, with the word's weight, are added up by
clause: a clause counts once for each kind of pattern, with its heaviest
match.  A document's score is a logistic function of the log of one plus
these sums and of their density (per DENSITY words), so matched clauses are
scored, not isolated words.

Learning (from labelled rows outside the held-out fold; a bounded sample of
SAMPLE_ROWS rows a label): insult words are those whose document counts differ
by label by a log-odds of at least MIN_ODDS and that stand beside several
different words (a phrase that is only copied does not); insult stems are word
beginnings of STEM lengths with that log-odds and several endings.  The
log-odds is the weight.  The patterns' weights are then fitted by logistic
regression, drawn to default weights that patterns missing from the sample
keep.  Threats, targets, negations and reporting words are short fixed lists.
Without both labels, the seed insults and default pattern weights are used.

Edge cases: null, empty and wordless texts score as a text without matches;
rows without id are not learnt from and count as not held out; a document with
several labels counts as toxic if any label says so; repeated rows give
repeated results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import Rolling, fold, joined, sample_ids, slices, stage, text_bytes, word_spans

SAMPLE_ROWS = 4_000
MIN_ODDS = 3.0
MIN_CONTEXTS = 5
MIN_SHARE = 0.01
LEXICON_ROWS = 2_000
STEM = (4, 5, 6, 7)
DENSITY = 100
SCOPE, REACH = 3, 4
SLICE_BYTES = 1 << 18
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
ROLL = Rolling(0x5851F42D4C957F2D)

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, BOUNDARY = range(7)
NAMES = ("insult", "threat", "directed_insult", "directed_threat", "softened", "reported")
PLAIN_I, PLAIN_T, DIRECT_I, DIRECT_T, SOFT, REPORTED = range(1, 7)
#: Weights by pattern, then of their densities, before any learning, and the constant.
DEFAULT = np.array([1.0, 1.0, 1.5, 1.5, 0.1, 0.1] + [0.0] * 6)
DEFAULT_CONSTANT = -2.0

SEED_INSULTS = "idiot moron stupid loser scum worthless pathetic disgusting"
THREATS = "kill hurt destroy beat burn shoot stab smash punch attack tuer matar morir schlagen"
TARGETS = ("you your yours yourself u he she they them him her his their this these those we us everyone people "
           "du dich dir ihr euch sie er tu toi vous te vos elle il ils ellos ella usted ustedes")
NEGATIONS = "not no never none nor neither without isn aren wasn don doesn didn nicht kein keine nie pas jamais aucun nunca ni sin"
REPORTS = "said says say told wrote writes called calls claimed claims quoted reported alleged accused sagte sagt dit dijo dice"


# ---- transducers ------------------------------------------------------------

class Transducer:
    """A deterministic finite-state transducer: step(state, symbol) -> (state, output), with its reachable states."""

    def __init__(self, start, step, symbols: int):
        self.start, self.step, self.symbols = start, step, symbols

    def compose(self, after: "Transducer") -> "Transducer":
        """Feed this machine's outputs to ``after``."""
        def step(state, symbol):
            a, mid = self.step(state[0], symbol)
            b, out = after.step(state[1], mid)
            return (a, b), out

        return Transducer((self.start, after.start), step, self.symbols)

    def table(self) -> tuple[list[list[int]], list[list[int]]]:
        """Next state and output by state and symbol, states numbered from the start."""
        number, queue, nexts, outs = {self.start: 0}, [self.start], [], []
        for state in queue:
            row_n, row_o = [], []
            for symbol in range(self.symbols):
                to, out = self.step(state, symbol)
                if to not in number:
                    number[to] = len(queue)
                    queue.append(to)
                row_n.append(number[to])
                row_o.append(out)
            nexts.append(row_n)
            outs.append(row_o)
        return nexts, outs


SOFTENED, TOLD = 7, 8      # symbols between the machines


def _negation(left: int, s: int) -> tuple[int, int]:
    if s == BOUNDARY:
        return 0, s
    if s == NEGATION:
        return SCOPE, OTHER
    return max(0, left - 1), (SOFTENED if left and s in (INSULT, THREAT) else s)


def _report(told: bool, s: int) -> tuple[bool, int]:
    if s == BOUNDARY:
        return False, s
    if s == REPORT:
        return True, OTHER
    return told, (TOLD if told and s in (INSULT, THREAT, SOFTENED) else s)


def _target(state: tuple[int, int, int], s: int) -> tuple[tuple[int, int, int], int]:
    """state: words a target still reaches, words an undirected match still waits, and which match that is."""
    reach, wait, kind = state
    reach, wait = max(0, reach - 1), max(0, wait - 1)
    if s == BOUNDARY:
        return (0, 0, 0), 0
    if s == TARGET:
        out = {INSULT: DIRECT_I, THREAT: DIRECT_T}[kind] if wait else 0
        return (REACH, 0, 0), out
    if s in (INSULT, THREAT):
        if reach:
            return (reach, 0, 0), DIRECT_I if s == INSULT else DIRECT_T
        return (0, REACH, s), PLAIN_I if s == INSULT else PLAIN_T
    out = {SOFTENED: SOFT, TOLD: REPORTED}.get(s, 0)
    return (reach, wait, kind if wait else 0), out


def grammar() -> tuple[list[list[int]], list[list[int]]]:
    negation = Transducer(0, _negation, 7)
    report = Transducer(False, _report, 8)
    target = Transducer((0, 0, 0), _target, 9)
    return negation.compose(report).compose(target).table()


# ---- features ---------------------------------------------------------------

BREAK = np.zeros(256, dtype=bool)
BREAK[[ord(c) for c in ".!?;:\n"]] = True


class Matcher:
    """Pattern sums of texts, for a lexicon of insult words and stems (ending in *) and their weights."""

    def __init__(self, insults: dict[str, float]):
        self.nexts, self.outs = grammar()
        words = {w: (k, 1.0) for k, listed in ((THREAT, THREATS), (TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS))
                 for w in listed.split()}
        words |= {w: (INSULT, x) for w, x in insults.items() if not w.endswith("*")}
        self.tables = [(0, *self._table(words))]      # (bytes of a stem or 0 for whole words, hashes, symbols, weights)
        stems: dict[int, dict] = {}
        for w, x in insults.items():
            if w.endswith("*"):
                stems.setdefault(len(w[:-1].encode()), {})[w[:-1]] = (INSULT, x)
        self.tables += [(n, *self._table(t)) for n, t in sorted(stems.items())]

    @staticmethod
    def _table(lexicon: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        words = sorted(lexicon)
        buf, _ = joined([w.encode() for w in words])
        hashes = ROLL.of(ROLL.prefix(buf), *word_spans(buf))
        order = np.argsort(hashes)
        return (hashes[order], np.array([lexicon[words[i]][0] for i in order], np.int8), np.array([lexicon[words[i]][1] for i in order]))

    def read(self, buf: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol and weight of each word; a whole word goes before its stems."""
        symbol, weight, prefix = np.full(len(a), OTHER, np.int8), np.zeros(len(a)), ROLL.prefix(buf)
        for n, hashes, symbols, weights in reversed(self.tables):
            rows = np.flatnonzero(b - a > n) if n else np.arange(len(a))
            h = ROLL.of(prefix, a[rows], a[rows] + n if n else b)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            known = hashes[at] == h
            symbol[rows[known]], weight[rows[known]] = symbols[at[known]], weights[at[known]]
        return symbol, weight

    def sums(self, texts: list[bytes]) -> np.ndarray:
        """By text: the sums by kind, and the number of words."""
        out = np.zeros((len(texts), len(NAMES) + 1))
        for lo, hi in slices(texts, SLICE_BYTES):
            buf, starts = joined(texts[lo:hi])
            a, b = word_spans(buf)
            if not len(a):
                continue
            symbol, weight = self.read(buf, a, b)
            breaks = np.cumsum(BREAK[buf])
            clause = breaks[a] + np.searchsorted(starts, a, "right")      # grows by clause and by text
            hot = np.isin(clause, clause[(symbol == INSULT) | (symbol == THREAT)])
            doc = np.searchsorted(starts, a, "right") - 1
            out[lo:hi, -1] = np.bincount(doc, minlength=hi - lo)
            where = np.flatnonzero(hot)
            cuts = np.flatnonzero(np.diff(clause[where])) + 1
            for words in np.split(where, cuts) if len(where) else ():
                state, best = 0, {}
                heaviest = 0.0
                for w in words:
                    s = int(symbol[w])
                    if s in (INSULT, THREAT):
                        heaviest = max(heaviest, float(weight[w]))
                    kind = self.outs[state][s]
                    state = self.nexts[state][s]
                    if kind:
                        best[kind] = max(best.get(kind, 0.0), heaviest)
                if DIRECT_I in best:
                    best.pop(PLAIN_I, None)
                if DIRECT_T in best:
                    best.pop(PLAIN_T, None)
                for kind, x in best.items():
                    out[lo + doc[words[0]], kind - 1] += x
        return out


def pattern_features(sums: np.ndarray) -> np.ndarray:
    """Logs of one plus the sums, then of one plus their densities."""
    return np.log1p(np.c_[sums[:, :-1], DENSITY * sums[:, :-1] / (sums[:, -1:] + DENSITY / 4)])


def logistic_fit(x: np.ndarray, y: np.ndarray, prior: np.ndarray, penalty: float = 1e-2) -> tuple[np.ndarray, float]:
    """Weights and constant by Newton steps; the penalty, relative to the rows, draws weights to the prior ones, which a
    pattern that the sample lacks keeps."""
    z, prior = np.c_[x, np.ones(len(x))], np.r_[prior, 0.0]
    w, ridge = prior.copy(), penalty * np.r_[np.ones(x.shape[1]), 1e-3] * max(1, len(x)) / 10
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * (w - prior)
        hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w[:-1], float(w[-1])


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic",
                    held_out_fold: int | None = 0, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Rows (doc_id, label, text): at most ``rows`` labelled documents of each label value, outside the held-out fold."""
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    if held_out_fold is not None:
        marks = marks.where(fold() != held_out_fold)
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label")).withColumn("h", F.xxhash64("doc_id"))
    picked = marks.join(F.broadcast(sample_ids(marks, ["label"], rows)), ["label", "h"], "left_semi").select("doc_id", "label")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # The picked rows are at most ``rows`` a label value.
    return texts.join(F.broadcast(picked), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "label", "text")


def learn_insults(sample: DataFrame) -> dict[str, float]:
    """Word -> weight from a bounded sample (doc_id, label, text)."""
    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = sample.select("doc_id", "label", F.regexp_extract_all(low, F.lit(WORDS), 0).alias("w"))
    pairs = words.select("doc_id", "label", F.posexplode("w").alias("i", "word"), "w")
    pairs = pairs.select("doc_id", "label", "word", F.when(F.col("i") > 0, F.element_at("w", F.col("i"))).alias("before"),
                         F.try_element_at("w", F.col("i") + 2).alias("after"))
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return dict.fromkeys(SEED_INSULTS.split(), MIN_ODDS)
    by_doc = pairs.groupBy("word", "doc_id", "label").agg(F.min("before").alias("before"), F.min("after").alias("after"))
    counts = by_doc.groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"),
        F.approx_count_distinct(F.when(F.col("label") == 1, F.col("before"))).alias("before"),
        F.approx_count_distinct(F.when(F.col("label") == 1, F.col("after"))).alias("after"))
    odds = (F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))).alias("odds")
    least = max(MIN_CONTEXTS, MIN_SHARE * n[1])

    def strongest(df: DataFrame, column: str) -> dict[str, float]:
        rows = df.select(column, odds).where(F.col("odds") >= MIN_ODDS).orderBy(F.desc("odds"), column).limit(LEXICON_ROWS)
        return {r[column]: float(r["odds"]) for r in rows.collect()}

    found = strongest(counts.where(F.least("before", "after", "toxic") >= F.lit(least)), "word")
    stems = by_doc.select("doc_id", "label", "word", F.explode(F.array(*(
        F.when(F.length("word") > k, F.substring("word", 1, k)) for k in STEM))).alias("stem")).where("stem is not null")
    stems = stems.groupBy("stem", "doc_id", "label").agg(F.min("word").alias("word")).groupBy("stem").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"),
        F.approx_count_distinct(F.when(F.col("label") == 1, F.col("word"))).alias("endings"))
    best = strongest(stems.where(F.least("endings", "toxic") >= F.lit(least)), "stem")
    # Of stems that extend one another, the longer one stays only where it tells more.
    kept = {w: x for w, x in best.items() if all(best.get(w[:k], 0.0) + 0.5 < x for k in range(1, len(w)))}
    return {w + "*": x for w, x in kept.items()} | found or dict.fromkeys(SEED_INSULTS.split(), MIN_ODDS)


def learn(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options: object) -> tuple[dict[str, float], np.ndarray, float]:
    """Insult lexicon, pattern weights and constant."""
    sample = stage(spark, labelled_sample(docs, labels, **options), "toxic-sample")
    insults = learn_insults(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(insults)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m.sums(text_bytes(b.column(1))).tolist(), pa.list_(pa.float64()))],
                                             ["label", "x"])

    rows = sample.select("label", "text").mapInArrow(run, "label int, x array<double>").collect()   # bounded by the sample
    y = np.array([min(1, max(0, r["label"])) for r in rows], float)
    if len(set(y)) < 2:
        return insults, DEFAULT, DEFAULT_CONSTANT
    return insults, *logistic_fit(pattern_features(np.array([r["x"] for r in rows])), y, DEFAULT)


def score(spark: SparkSession, docs: DataFrame, model: tuple[dict[str, float], np.ndarray, float], id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Rows (doc_id, score, patterns): patterns are the sums by kind, in the order of NAMES."""
    insults, weights, constant = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = Matcher(insults)
        for b in batches:
            sums = m.sums(text_bytes(b.column(1)))
            p = 1 / (1 + np.exp(-np.clip(pattern_features(sums) @ weights + constant, -50, 50)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(p), pa.array(sums[:, :-1].tolist(), pa.list_(pa.float64()))],
                                             ["doc_id", "score", "patterns"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double, patterns array<double>")


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, **options: object) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted, patterns)."""
    rows = score(spark, docs, learn(spark, docs, labels, **options))
    return rows.select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"), "patterns")
