"""Spelling variants: words one edit apart, found by PartEnum signatures of their letter multisets.

Words.  The corpus is cut into words by ``word_counts``; a word's number of
occurrences is counted with partial sums in the tasks that read the texts.

Candidates.  A word is the set of its (letter, k) with k = 1 .. how often it
holds the letter: a binary vector.  One replaced letter changes two of its
dimensions, one inserted or deleted letter changes one, so near words have
vectors of Hamming distance at most two.  Dimensions are dealt into d + 2
parts for distance d; vectors within d agree on at least two parts, and a
signature is a choice of two parts and what the vector holds there:

* words of equal length: d = 2, four parts, six choices;
* words whose lengths differ by one: d = 1, three parts, three choices.

As an edit lies in the first or the second half of a word, the signature also
takes in the half that it leaves alone (one row for either half), which is as
exact and leaves few chance meetings.  Signatures are joined, nothing is
grouped: a hot signature's partition can be split.

Verification.  Each candidate pair is compared by edit distance; equal pairs
from several signatures then become one.

Forms.  A word's form is its most frequent near word (ties: the first by code
point), if that is at least ``ratio`` times as frequent.  Counts grow by that
factor from form to form, so a chain is no longer than log(largest count) and
its end is reached by doubling in a known, small number of joins.

Edge cases: null and empty texts have no words; rows without id count with an
empty id; repeated rows and repeated ids count row by row; texts and words may
be of any length; an empty table gives an empty result; other columns are
ignored.  Equal hashes of different signatures only add candidates.
"""

from __future__ import annotations

from itertools import combinations
from math import ceil, log2

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import stage

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
SLIP_EVERY = 31
LETTERS = "A-Za-z\\u00C0-\\u00FF"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT, slip_every: int | None = SLIP_EVERY) -> DataFrame:
    """Rows (word, n): words of at least min_length code points that stand at least min_count times.

    A word is a maximal run of LETTERS, A-Z in lower case.  With ``slip_every``
    a run loses the code point h % length if h, the crc32 of "id:run", is
    divisible by it.  Shorter runs cannot become words and are not read out.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit("[%s]{%d,}" % (LETTERS, min_length)), 0)).alias("run"))
    run = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    words = runs.select("id", run.alias("word"))
    if slip_every:
        words = words.withColumn("h", F.crc32(F.concat_ws(":", "id", "word").cast("binary")))
        at = (F.col("h") % F.length("word")).cast("int")
        slipped = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
        words = words.select(F.when(F.col("h") % slip_every == 0, slipped).otherwise(F.col("word")).alias("word"))
    words = words.where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _dimensions(word: Column) -> Column:
    """array<struct<letter: code point, k>>: the dimensions that the word's vector holds."""
    def of(letter: Column) -> Column:
        times = (F.length(word) - F.length(F.replace(word, letter, F.lit("")))).cast("int")
        return F.transform(F.sequence(F.lit(1), times), lambda k: F.struct(F.ascii(letter).alias("letter"), k.alias("k")))

    return F.flatten(F.transform(F.array_distinct(F.split(word, "")), of))


def _parts(dims: Column, n: int) -> list[Column]:
    """A hash of what the vector holds in each of n parts; 3 spreads the repeats of one letter over the parts."""
    def part(p: int) -> Column:
        inside = F.filter(dims, lambda d: F.pmod(d["letter"] + d["k"] * 3, F.lit(n)) == p)
        return F.aggregate(inside, F.lit(0).cast("long"), lambda acc, d: acc.bitwiseXOR(F.xxhash64(d["letter"], d["k"])))

    return [part(p) for p in range(n)]


def signatures(words: DataFrame) -> DataFrame:
    """From (word, n): rows (signature, role, word, n); role 0 meets 0 (equal length), 1 (shorter) meets 2 (longer)."""
    w, size = F.col("word"), F.length("word")
    rows = words.select("word", "n", _dimensions(w).alias("dims"))
    rows = rows.select("word", "n", F.array(_parts(F.col("dims"), 4)).alias("p4"), F.array(_parts(F.col("dims"), 3)).alias("p3"))

    def halves(short: Column) -> list[Column]:
        """The first or the second half of the shorter word's length, at the word's begin or end."""
        first = F.floor(short / 2).cast("int")
        return [F.concat(F.lit("<"), F.substring(w, F.lit(1), first)), F.concat(F.lit(">"), F.substring(w, size - (short - first) + 1, short))]

    def of(role: int, short: Column, parts: str, n: int) -> list[Column]:
        return [F.struct(F.xxhash64(F.lit(n), F.lit(i), F.lit(j), F.col(parts)[i], F.col(parts)[j], short, half).alias("signature"),
                         F.lit(role).cast("byte").alias("role"))
                for i, j in combinations(range(n), 2) for half in halves(short)]

    every = of(0, size, "p4", 4) + of(1, size, "p3", 3) + of(2, size - 1, "p3", 3)
    return rows.select("word", "n", F.explode(F.array(every)).alias("s")).select("s.signature", "s.role", "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """From distinct (word, n): rows (a, n_a, b, n_b), one for each two words that are one edit apart."""
    s = signatures(words)
    a, b = s.alias("a"), s.alias("b")
    meet = (F.col("a.signature") == F.col("b.signature")) & F.when(
        F.col("a.role") == 0, (F.col("b.role") == 0) & (F.col("a.word") < F.col("b.word"))).otherwise(
        (F.col("a.role") == 1) & (F.col("b.role") == 2))
    near = a.join(b, meet).where(F.levenshtein("a.word", "b.word", 1) == 1)
    return near.select(F.col("a.word").alias("a"), F.col("a.n").alias("n_a"), F.col("b.word").alias("b"), F.col("b.n").alias("n_b")).distinct()


def _roots(spark: SparkSession, forms: DataFrame, largest: int, ratio: int, min_count: int) -> DataFrame:
    """From (word, form), acyclic as counts grow: rows (word, root), the end of each chain."""
    hops, n = 0, min_count
    while n * ratio <= largest:
        hops, n = hops + 1, n * ratio
    roots = forms.select("word", F.col("form").alias("root"))
    for step in range(ceil(log2(max(1, hops)))):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = roots.join(further, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        roots = stage(spark, roots, f"roots-{step}")
    return roots


def variants(spark: SparkSession, words: DataFrame, ratio: int = RATIO, min_count: int = MIN_COUNT) -> DataFrame:
    """From (word, n) of distinct words: rows (word, n, n_near, form, form_n, root)."""
    words = stage(spark, words, "words")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = near_pairs(words.repartition(n, "word"))      # few bytes, but the dear part: many tasks for the signatures
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("other_n")).union(
        pairs.select("b", "a", "n_a"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    rows = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                                   (-F.col("best.less")).alias("form_n"), F.col("best.other").alias("form"))
    good = F.col("form_n") >= ratio * F.col("n")
    rows = stage(spark, rows.select("word", "n", "n_near", F.when(good, F.col("form")).alias("form"),
                                    F.when(good, F.col("form_n")).alias("form_n")), "forms")
    largest = rows.agg(F.max("form_n")).first()[0]
    if largest is None:
        return rows.withColumn("root", F.col("word"))
    roots = _roots(spark, rows.where("form is not null"), largest, ratio, min_count)
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO,
                      **options: int) -> DataFrame:
    """Rows (word, n, n_near, form, form_n, root), one per word of the corpus."""
    counts = word_counts(docs, id_col, text_col, **options)
    return variants(spark, counts, ratio, options.get("min_count", MIN_COUNT))
