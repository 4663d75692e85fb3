import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product

from tillhouse.llm import spelling as S
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
TO_LOWER = str.maketrans(S.UPPER, S.LOWER)


def brute_counts(docs):
    out = Counter()
    for d, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(TO_LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def brute_near(words):
    """Words one edit apart, by what is left of each when one position is taken out or masked."""
    gaps, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            gaps[w[:i] + "\0" + w[i + 1:]].add(w)
            gaps[w[:i] + w[i + 1:]].add(w) if w[:i] + w[i + 1:] in words else None
    for w in words:
        for i in range(len(w)):
            near[w] |= gaps[w[:i] + "\0" + w[i + 1:]] - {w}
        near[w] |= gaps[w]
    for w in words:
        for other in list(near[w]):
            near[other].add(w)
    return {w: others - {w} for w, others in near.items()}


def brute(counts, ratio=10):
    near, out, form = brute_near(set(counts)), {}, {}
    for w, n in counts.items():
        best = min(near.get(w, ()), key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n, len(near.get(w, ())), form[w], counts[form[w]] if form[w] else None, root)
    return out


def rows(df):
    got = df.collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got}
    assert len(out) == len(got)
    return out


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(brute_counts(docs))
    got = rows(QUERIES["op11_spelling_variants"](spark, SF))
    assert got == want and sum(v[2] is not None for v in want.values()) > 50


def test_chains_ties_and_edges(spark, make_docs):
    text = {"harbour": 5000, "harbourx": 500, "harboury": 500, "harbourxz": 40, "harborxz": 2, "señoría": 30, "senoría": 3, "seoría": 9,
            "abcdefgh": 20, "abcdefgi": 20, "abcdefgj": 2, "x" * 3000: 20, "x" * 3001: 2, "ÀÉ×÷ßÿöä": 4}
    docs = [(None, " ".join([w] * n)) for w, n in text.items()]
    docs += [(1, None), (2, ""), (3, "Short"), (None, "HARBOUR, harbour's"), (7, "Grüße-Straßen 1a2b strassen STRASSEN"), (7, "Grüße-Straßen strassen")]
    want = brute(brute_counts(docs))
    got = rows(S.spelling_variants(spark, make_docs(docs)))
    assert got == want
    plain = rows(S.spelling_variants(spark, make_docs(docs), slip_every=None))
    assert plain["harborxz"][4] == "harbour" and plain["harbourxz"][2] == "harbourx" and plain["abcdefgj"][2] == "abcdefgh"
    assert plain["x" * 3001][2] == "x" * 3000 and plain["abcdefgh"][2] is None and plain["abcdefgh"][1] == 2
    assert S.spelling_variants(spark, make_docs([])).count() == 0
    assert S.spelling_variants(spark, make_docs([(1, "nothing new here"), (2, None)])).count() == 0


def test_pairs_of_dense_words(spark):
    """All words over few letters: every signature is crowded, every pair must be found once."""
    words = ["".join(w) for k in (6, 7) for w in product("aé", repeat=k)] + ["aaaéééb", "baaaééé"]
    df = spark.createDataFrame([(w, i + 1) for i, w in enumerate(words)], "word string, n long")
    got = Counter(frozenset((r["a"], r["b"])) for r in S.near_pairs(df).collect())
    near = brute_near(set(words))
    assert set(got.values()) == {1} and set(got) == {frozenset((a, b)) for a, others in near.items() for b in others}


def test_random_words(spark):
    rng = random.Random(5)
    words = {"".join(rng.choices("abcñ", k=rng.randint(1, 9))) for _ in range(600)}
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = {frozenset((r["a"], r["b"])) for r in S.near_pairs(df).collect()}
    assert got == {frozenset((a, b)) for a, others in brute_near(words).items() for b in others} and len(got) > 100
