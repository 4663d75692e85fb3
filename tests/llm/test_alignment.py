import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillhouse.llm import alignment as A
from tillhouse.llm.common import byte_level
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_group_links"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A.vocabulary(A.JSON))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=A.vocabulary(A.PIECES))


def spans(libraries, text):
    """[(id, bytes)] of both, or none."""
    a, b = libraries
    byte, raw = byte_level(), (" " + (text or "")).encode()
    if not text:
        return [], []
    x = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    y = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        y.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("\u2581", " ").encode()))
    same = b"".join(t for _, t in x) == raw == b"".join(t for _, t in y)
    return (x, y) if same else ([], [])


def brute_one(x, y):
    """Links (a position, b position, shared bytes) and groups ([a ids], [b ids]) by walking the bytes."""
    links, groups = Counter(), []
    i = j = at_a = at_b = 0
    while i < len(x) and j < len(y):
        end_a, end_b = at_a + len(x[i][1]), at_b + len(y[j][1])
        if i == 0 and j == 0 or at_a == at_b:
            groups.append(([], []))
        if not groups[-1][0] or groups[-1][0][-1] != i:
            groups[-1][0].append(i)
        if not groups[-1][1] or groups[-1][1][-1] != j:
            groups[-1][1].append(j)
        links[i, j] += min(end_a, end_b) - max(at_a, at_b)
        if end_a <= end_b:
            i, at_a = i + 1, end_a
        if end_b <= end_a:
            j, at_b = j + 1, end_b
    return links, groups


def brute(libraries, docs):
    done = []
    holds = Counter()
    for d, text in docs:
        x, y = spans(libraries, text)
        links, groups = brute_one(x, y)
        holds.update({(x[i][0], y[j][0]) for i, j in links})
        done.append((d, x, y, links, groups))
    most = defaultdict(int)
    for (a, _), n in holds.items():
        most[a] = max(most[a], n)
    out = []
    for d, x, y, links, groups in done:
        ids = [(x[i][0], y[j][0]) for i, j in links]
        said = ";".join(",".join(str(x[i][0]) for i in g) + "|" + ",".join(str(y[j][0]) for j in h) for g, h in groups)
        out.append((d, len(x), len(y), len(groups), len(links), sum(holds[p] == most[p[0]] for p in ids), sum(holds[p] for p in ids),
                    hashlib.sha256(said.encode()).hexdigest() if said else "", sum(len(g) * len(h) for g, h in groups)))
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_query_matches_brute_force(spark, libraries):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = [tuple(r[c] for c in COLUMNS) for r in QUERIES["op12_cross_tokenizer_alignment"](spark, SF).collect()]
    assert ordered(got) == ordered(brute(libraries, docs))


DOCS = [(1, None), (2, ""), (3, "a"), (4, "the harbour of Ñandú 日本語 \U0001f642\r\n\t tabs  "), (5, "\u2581 already"), (6, "<s> <0x41> <|endoftext|> hi"),
        (7, "x" * 9000), (8, "one text twice"), (8, "one text twice"), (None, "no id"), (9, "word " * 60000), (10, "  two  spaces "),
        (11, "\x00 zero"), (12, "\u0378 new"), (13, "\ufb01 ligature e\u0301")]


def test_edges_and_links(spark, make_docs, libraries, monkeypatch):
    got = [tuple(r[c] for c in COLUMNS) for r in A.align(spark, make_docs(DOCS)).collect()]
    assert ordered(got) == ordered(brute(libraries, DOCS))
    by = {r[0]: r for r in got}
    assert by[5][1:] == (0, 0, 0, 0, 0, 0, "", 0) and by[6][1] > 0 and by[9][3] > 50000
    few = [d for d in DOCS if d[0] in (3, 4, 6, 10)]
    rows = A.token_links(make_docs(few)).collect()
    want = {(d, i, j): n for d, t in few for (i, j), n in brute_one(*spans(libraries, t))[0].items()}
    assert {(r["doc_id"], r["a_at"], r["b_at"]): r["n_bytes"] for r in rows} == want and len(rows) == len(want)
    assert A.align(spark, make_docs([])).count() == 0
    assert [tuple(r) for r in A.align(spark, make_docs([(1, "")])).collect()] == [(1, 0, 0, 0, 0, 0, 0, "", 0)]


def test_blocks_do_not_matter(libraries, monkeypatch):
    pair = A.Pair(*A._paths(None))
    x = A.Aligned(pair, pair.ids([t or "" for _, t in DOCS if t is None or len(t) < 10000]))
    whole = [np.concatenate(c).tolist() for c in zip(*x.overlaps())], [np.concatenate(c).tolist() for c in zip(*x.group_links())]
    assert len(whole[1][0]) == x.group_link_counts().sum()
    for size in (1, 5, 64):
        monkeypatch.setattr(A, "BLOCK_BYTES", size)
        assert ([np.concatenate(c).tolist() for c in zip(*x.overlaps())], [np.concatenate(c).tolist() for c in zip(*x.group_links())]) == whole


def test_products_of_any_matrices():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, m, k = rng.integers(1, 9, 3)
        a, b = rng.random((n, m)) < 0.4, rng.random((m, k)) < 0.4

        def csr(x):
            return A.Csr(np.concatenate([[0], np.cumsum(x.sum(axis=1))]).astype(np.int64), np.nonzero(x)[1], x.shape[1])

        row, column, value = A.product(csr(a), csr(b))
        dense = np.zeros((n, k), int)
        dense[row, column] = value
        assert (dense == a.astype(int) @ b.astype(int)).all() and len(row) == (dense > 0).sum()
        assert A.product_size(csr(a), csr(b)) == dense.sum()
        t = A.transposed(csr(a))
        assert t.starts.tolist() == csr(a.T).starts.tolist() and t.columns.tolist() == csr(a.T).columns.tolist()
