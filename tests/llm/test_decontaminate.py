import hashlib
import re

from tillhouse.llm import decontaminate as D
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    return re.findall(PATTERN, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    wins = {}
    for i, t in items:
        w = words(t)
        if i is not None and w:
            for k in range(max(1, len(w) - window + 1)):
                wins.setdefault(tuple(w[k:k + window]), set()).add(str(i))
    sizes = sorted({len(w) for w in wins})
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (ids := wins.get(tuple(w[k:k + n]))):
                    hit.update(range(k, k + n))
                    found |= ids
        text = ",".join(sorted(found))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(text.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op1_decontamination"](spark, SF).collect()), key=str)
    want = brute(docs, items)
    assert got == want and sum(r[-1] for r in want) > 0


def test_edges_and_packs(spark, make_docs, monkeypatch):
    a = "one two three four five six seven eight nine ten eleven twelve"
    docs = [(1, a), (2, "x " + a.upper() + " " + a), (3, None), (4, ""), (5, "!!"), (6, "short item"), (7, "Short, ITEM. short"),
            (7, "Short, ITEM. short"), (None, a), (8, "one two three four five six seven eight nine"), (9, "ten eleven twelve"),
            (10, "été " * 30000 + a), (11, a.replace(" ", "\n- "))]
    items = [(1, a), (2, "short item"), (3, None), (4, "..."), (None, "x"), (10, a), (10, "eleven"), (9, "ÉTÉ"), (5, "été été")]
    bench = spark.createDataFrame([(i, t, "n") for i, t in items], "item_id long, text string, n string")
    want = brute(docs, items)
    for pack_bytes in (D.PACK_BYTES, 40):       # one pack, several packs
        monkeypatch.setattr(D, "PACK_BYTES", pack_bytes)
        c = D.contamination(spark, make_docs(docs), bench)
        got = sorted(((r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(),
                       r["contaminated"]) for r in c.collect()), key=str)
        assert got == want
    left = D.remove_contaminated(spark, make_docs(docs), bench)
    assert left.columns == make_docs([]).columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted(r[0] for r in want if not r[-1])
    none = D.contamination(spark, make_docs(docs), bench.limit(0))
    assert none.count() == len(docs) and none.where("contaminated").count() == 0
    assert D.contamination(spark, make_docs([]), bench).count() == 0


def test_proximity(spark, make_docs):
    docs = [(1, "alpha x x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha beta"), (4, "alpha " + "z " * 40 + "beta gamma")]
    bench = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    m = D.find_matches(spark, make_docs(docs), bench, slop=6)
    assert {r["doc_id"]: (len(r["spans"]), len(r["near"]) > 0) for r in m.collect()} == \
        {1: (0, True), 2: (0, True), 3: (0, False), 4: (0, False)}


def test_rows_go_by_themselves_not_by_id(spark, make_docs):
    bad = "one two three four five six seven eight nine ten"
    bench = spark.createDataFrame([(1, bad)], "item_id long, text string")
    docs = [(None, bad), (None, "a clean row"), (7, f"x {bad}"), (7, "another clean row"), (8, "clean"), (8, "clean"), (None, None)]
    left = D.remove_contaminated(spark, make_docs(docs), bench)
    assert left.columns == make_docs([]).columns
    want = [(None, "a clean row"), (7, "another clean row"), (8, "clean"), (8, "clean"), (None, None)]
    assert sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str) == sorted(want, key=str)
