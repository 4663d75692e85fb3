import zlib
from collections import Counter

import numpy as np
from tokenizers import Tokenizer

from tillhouse.llm import packing as P
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def check(pieces, docs, window=2048):
    """Exact round trip: every id of every document in one piece, sequences gapless. Returns the padding share."""
    t = Tokenizer.from_file(P.vocabulary(P.JSON))
    want = sorted((d if d is not None else -1, [*t.encode(x or "", add_special_tokens=False).ids, 1]) for d, x in docs)
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault((p["doc_id"] if p["doc_id"] is not None else -1, p["doc_tokens"]), []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for (d, n) in {(d, len(ids)) for d, ids in want}:
        same = [ids for e, ids in want if (e, len(ids)) == (d, n)]
        got = by_doc.pop((d, n))
        if len(same) > 1:       # a repeated row: as many pieces over each of its ids
            cover = Counter(i for p in got for i in range(p["start"], p["start"] + p["length"]))
            assert len(cover) == n and set(cover.values()) == {len(same)}
            sums = {(p["start"], p["length"], p["ids_crc32"]) for p in got}
            for start, length, crc in sums:
                assert length > 0 and crc in {zlib.crc32(np.array(ids[start:start + length], "<u4").tobytes()) for ids in same}
            continue
        at = 0
        for p in sorted(got, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0
            assert zlib.crc32(np.array(same[0][at:at + p["length"]], "<u4").tobytes()) == p["ids_crc32"]
            at += p["length"]
        assert at == n
    assert not by_doc
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    total = sum(len(ids) for _, ids in want)
    return 1 - total / (len(by_seq) * window) if by_seq else 0


def test_query_round_trip(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    padding = check(QUERIES["op2_packing"](spark, SF).collect(), docs)
    assert padding < 0.01


def test_edges(spark, make_docs):
    docs = [(1, None), (2, ""), (3, "a"), (4, "word " * 9000), (5, "x" * 20000), (6, "<|endoftext|> hi"), (7, "dup row"), (7, "dup row"),
            (None, "no id"), (8, "日本語 ñandú 🙂\r\n\t  tabs  "), (9, " " * 9000), (10, "hello " * 2047), (11, "hello " * 4095)]
    check(P.pack(spark, make_docs(docs)).collect(), docs)
    check(P.pack(spark, make_docs(docs), window=64, step=8).collect(), docs, 64)
    assert P.pack(spark, make_docs([])).count() == 0


def test_nnls_and_plan():
    rng = np.random.default_rng(3)
    a = np.abs(rng.normal(size=(12, 30)))
    x = np.where(rng.random(30) < 0.2, rng.random(30), 0)
    assert np.allclose(a @ P.nnls(a, a @ x), a @ x, atol=1e-6)
    assert sorted(P.combinations(6, 3)) == sorted([(6,), (5, 1), (4, 2), (3, 3), (4, 1, 1), (3, 2, 1), (2, 2, 2)])
    h = np.array([0, 50, 3, 0, 9, 40])
    combos, counts = P.plan(h, 3)
    used = np.zeros_like(h)
    for combo, k in zip(combos, counts):
        assert sum(combo) == 5
        for c in combo:
            used[c] += k
    assert (used <= h).all() and used.sum() > 60


def test_ids_are_those_of_the_unmodified_tokenizer():
    t = Tokenizer.from_file(P.vocabulary(P.JSON))
    encode = P.Encoder(P.vocabulary(P.RANKS), P.vocabulary(P.JSON)).ids
    texts = ["<|endoftext|> hi", "a  <|endoftext|>\n\nb<|endoftext|><|endoftext|>", "<|endoftext| >", "plain", "x" * 5000 + "<|endoftext|> hi"]
    for text in texts:
        assert encode(text).tolist() == [*t.encode(text, add_special_tokens=False).ids, P.END_ID]
    assert encode("<|endoftext|> hi").tolist() == [50256, 23105, P.END_ID]
