import zlib

import numpy as np

from tillhouse.llm import langid as G
from tillhouse.llm.common import LOWER
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_half_pointers(sample, text):
    """Greedy longest matches, by substring search, two each; a phrase also ends at each lane's end; one more for bytes not in the sample."""
    sample = bytes(LOWER[np.frombuffer(sample, np.uint8)])
    text = bytes(LOWER[np.frombuffer(text, np.uint8)])
    n = 0
    for lane in range(0, len(text), G.LANE):
        part, i = text[lane:lane + G.LANE], 0
        while i < len(part):
            k = 1
            while i + k < len(part) and part[i:i + k + 1] in sample:
                k += 1
            n += 2 + (part[i:i + 1] not in sample)
            i += k
    return n


def test_parser_matches_substring_search(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sample = {k: v[:3000] for k, v in G.training_sample(docs).items()}
    parser = G.CrossParser(sample)
    texts = [r["text"].encode() for r in docs.orderBy("doc_id").limit(25).collect()] + [b"a", b"\xff\x00?", "ñ".encode() * 700]
    got = parser.half_pointers(texts)
    for t, row in zip(texts, got):
        assert [brute_half_pointers(sample[g], t) for g in parser.langs] == row.tolist()


def test_held_out_accuracy(spark):
    rows = QUERIES["op7_language_id"](spark, SF).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert len(rows) == len(lang) and all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_a_tiny_sample_wins_only_its_own_texts(spark, make_docs):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    lang = {d: g for d, _, g in docs}
    ids = [d for d in range(-1, -20, -1) if zlib.crc32(str(d).encode()) % 5]      # not held out
    tiny = list(zip(ids, ["ok", "hello there", "a", "x" * 5000 + " 日本"], ["l1", "l2", "l3", "l4"]))
    got = {r["doc_id"]: r["lang_pred"] for r in G.identify(spark, make_docs(docs + tiny)).collect()}
    held = [d for d in lang if zlib.crc32(str(d).encode()) % 5 == 0]
    assert sum(got[d] == lang[d] for d in held) >= 0.97 * len(held)
    assert not [d for d in held if got[d].startswith("l") and got[d] != lang[d]] and got[tiny[3][0]] == "l4"


def test_short_and_long_texts_are_learnt_from_alike(spark, make_docs):
    rows = [(i, "der hund und die katze und der vogel " * 200, "de") for i in range(40)] + [(50 + i, "ok", "de") for i in range(3)]
    sample = G.training_sample(make_docs(rows))["de"]
    assert b"katze" in sample and b"ok" in sample and len(sample) > 30 * G.MAX_ROW_BYTES


def test_labels_of_the_held_out_fold_are_not_read(spark, make_docs):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    lies = [(d, t, "xx" if zlib.crc32(str(d).encode()) % 5 == 0 else g) for d, t, g in docs]
    assert G.training_sample(make_docs(lies)) == G.training_sample(make_docs(docs))


def test_edges(spark, make_docs):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(20)] + [(20 + i, "der hund und die katze " * 3, "de") for i in range(20)]
    rows += [(50, None, "en"), (51, "", "en"), (52, "123 !?", "en"), (53, "und die katze", None), (53, "und die katze", None),
             (None, "the dog", "en"), (54, "the dog " * 40000, None)]
    got = sorted(((r["doc_id"] or 0, r["lang_pred"]) for r in G.identify(spark, make_docs(rows)).collect() if (r["doc_id"] or 99) >= 50))
    assert [g for g in got if g[0]] == [(50, "und"), (51, "und"), (52, "und"), (53, "de"), (53, "de"), (54, "en")]
    left = G.keep_identified(spark, make_docs(rows))
    assert left.columns == make_docs([]).columns and left.count() == len(rows) - 3
    assert G.identify(spark, make_docs([])).count() == 0
    unlabelled = G.identify(spark, make_docs([(1, "the", None), (2, None, None)])).collect()
    assert {r["lang_pred"] for r in unlabelled} == {"und"}


def test_long_texts_are_cut_for_training(spark, make_docs):
    rows = [(i, "12 " * 3000 + f"日本{i}語の文 " * 40000, "ja") for i in range(40)] + [(100 + i, "the dog and the cat", "en") for i in range(20)]
    sample = G.training_sample(make_docs(rows))
    assert 0 < len(sample["ja"]) <= G.SAMPLE_BYTES + G.MAX_ROW_BYTES + 1
    sample["ja"].decode()
    assert {r["lang_pred"] for r in G.identify(spark, make_docs(rows)).where("doc_id < 40").collect()} == {"ja"}


def test_many_languages_are_parsed_in_groups(monkeypatch):
    rng = np.random.default_rng(5)
    sample = {f"l{k:03}": bytes(rng.choice(list(b"abcdefgh "[k % 4:]), 300).astype(np.uint8)) for k in range(40)}
    texts = [sample[g][20:200] + sample["l000"][:150] for g in list(sample)[:12]] + [b"", b"zz"]
    whole = G.CrossParser(sample)
    monkeypatch.setattr(G, "TABLE_ENTRIES", 20_000)
    parts = G.CrossParser(sample)
    assert len(whole.groups) == 1 and len(parts.groups) > 5
    assert (parts.half_pointers(texts) == whole.half_pointers(texts)).all() and parts.predict(texts)[0] == whole.predict(texts)[0]
