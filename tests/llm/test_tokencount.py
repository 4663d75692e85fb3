import numpy as np
import pytest
import regex
from tokenizers import Tokenizer

from tillhouse.llm import tokencount as C
from tillhouse.llm.common import settled
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(C.vocabulary())


def want(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_query_matches_library(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op13_token_counts"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n = want(library, docs[r["doc_id"]])
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((docs[r["doc_id"]] or "").encode()), n, n > 512)


ODD = ["<|endoftext|>", "a <|endoftext|>\n\nb<|endoftext|><|endoftext|> c", "<|endoftext| >", "it's they'll 'd 'S ''s", "  a  \n\n b\t\t", " ",
       "日本語 ñandú 🙂\r\n\t  tabs  ", "x" * 9000, " " * 9000, "word " * 90000, "͸ new ՘letters⿠", "1234 12a ½²", "\x1c\x85\xa0a b",
       "áé ‍﻿", "\U0010ffff"]


def test_odd_texts(spark, make_docs, library):
    docs = [(i, t) for i, t in enumerate(ODD)] + [(100, None), (101, ""), (102, "dup row"), (102, "dup row"), (None, "no id"), (None, "no id either")]
    got = sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in C.token_counts(spark, make_docs(docs)).collect())
    assert got == sorted((d or -1, len((t or "").encode()), want(library, t)) for d, t in docs)
    none = C.token_counts(spark, make_docs(docs), rows=1, entries=1)       # nearly all by the second tier
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"]) for r in none.collect()) == got
    assert C.token_counts(spark, make_docs([])).count() == 0
    assert C.token_counts(spark, make_docs([(1, None), (2, "")])).count() == 2
    assert [r["over_limit"] for r in C.token_counts(spark, make_docs([(1, "a b c")]), limit=2).collect()] == [True]


def test_cuts_and_cache(library, monkeypatch):
    cutter = C.PreTokens(C.vocabulary())
    text = " ".join(ODD)
    whole = want(library, text)
    for size in (1, 7, 100):
        monkeypatch.setattr(C, "PIECE_CHARS", size)
        pieces, added = cutter.pieces(text)
        assert len(pieces) > 20 and "<|endoftext|>".join(cutter.added.split(text)) == text
        assert C.TwoTier(cutter, {}).count([text]) == [whole]
    monkeypatch.setattr(C, "CACHE_ENTRIES", 5)
    counter = C.TwoTier(cutter, {"word": 1})
    assert counter.count([text, text, "word word"]) == [whole, whole, want(library, "word word")] and len(counter.cache) <= 5 + len(text)


def test_ranks_give_the_librarys_ids(library):
    cutter = C.PreTokens(C.vocabulary())
    whole = [library.decode([i]) for i in range(library.get_vocab_size() - 1)]
    tokens = [t for t in whole if "\ufffd" not in t and cutter.find(t) == [t]] + ["áéáé", "zqxj" * 10, "ß日本", "\u3000", "'s"]
    assert len(tokens) > 45000 and cutter.ranked
    assert [cutter.ranked(t) for t in tokens] == [e.ids for e in library.encode_batch(tokens, add_special_tokens=False)]
    assert cutter.lengths(["x" * 5000]) == [want(library, "x" * 5000)]


def test_table_is_compact():
    lengths = {f" word{i}": i % 5 + 1 for i in range(3000)} | {"é": 1, "": 1}
    table = C.Table(lengths)
    assert table.hashed() == lengths and len(table.keys.encode()) + table.sizes.nbytes + table.lengths.nbytes < 16 * len(lengths)


def test_pattern_agrees_with_the_library(library):
    """Every code point that regex and the library class differently is one that goes to the library."""
    cutter = C.PreTokens(C.vocabulary())
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rng = np.random.default_rng(0)
    pick = {c for c in points if c < 0x3000} | set(rng.choice(points, 20000).tolist())
    for c in pick:
        s = "a{0}1{0}!{0} {0}  {0}".format(chr(c))
        if settled(s):
            assert [s[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(s)] == cutter.find(s), hex(c)
    assert regex.search(r"\p{L}", "é")
