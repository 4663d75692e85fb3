import hashlib
import random
from collections import Counter

from tillhouse.llm import substrings as S
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(docs, length=200):
    texts = [(t or "").encode() for _, t in docs]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(docs, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((d, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(map(tuple, df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()), key=str)


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(docs)
    assert result(QUERIES["op5_suffix_array_dedup"](spark, SF)) == want and sum(r[2] for r in want) > 0


def test_random_overlaps_and_edges(spark, make_docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abé ") for _ in range(rng.randint(1, 9)))
    pool = ["".join(word() for _ in range(rng.randint(5, 120))) for _ in range(12)]
    docs = [(i, "".join(rng.choice(pool)[rng.randint(0, 30):][:rng.randint(30, 400)] for _ in range(rng.randint(0, 6)))) for i in range(80)]
    docs += [(100, None), (101, ""), (102, "x" * 199), (103, "x" * 200), (104, "x" * 201), (105, "ab" * 4000), (106, pool[0] * 3),
             (107, "q" * 150 + pool[1]), (107, "q" * 150 + pool[1]), (None, pool[2]), (108, "é" * 99 + "z" * 3), (109, "é" * 99 + "z" * 3)]
    assert result(S.remove_repeats(spark, make_docs(docs))) == brute(docs)
    assert result(S.remove_repeats(spark, make_docs(docs), length=40, q=16)) == brute(docs, 40)
    assert S.remove_repeats(spark, make_docs([])).count() == 0
    cut = make_docs(docs + [(110, "".join(pool) * 2), (111, "x" + "".join(pool))])
    whole = result(S.remove_repeats(spark, cut))
    assert result(S.remove_repeats(spark, cut, stretch=500)) == whole == brute([tuple(r)[:2] for r in cut.select("doc_id", "text").collect()])
