import zlib

import numpy as np

from tillhouse.llm import quality as Q
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_three_ordered_grades():
    rng = np.random.default_rng(0)
    docs, grades = [], []
    for _ in range(600):
        g = int(rng.integers(0, 3))
        docs.append([(5, g / 2 + rng.normal() * 0.1), (int(rng.integers(10, 40)), 0.2)])
        grades.append(g)
    pairs = [pair for d in docs for pair in d]
    m = Q.fit(np.array([len(d) for d in docs]), np.array([s for s, _ in pairs]), np.array([v for _, v in pairs]), np.array(grades))
    assert m.grades == [0, 1, 2] and m.thresholds[0] < m.thresholds[1]
    eta = np.array([sum(m.weights[s] * v for s, v in d) for d in docs])
    p = np.diff(np.c_[np.zeros(600), m.below(eta), np.ones(600)], axis=1)
    assert np.allclose(p.sum(axis=1), 1) and (p.argmax(axis=1) == np.array(grades)).mean() > 0.9


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op8_quality_classifier"](spark, SF).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in rows.items())
    marks = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(rows[d], q) for d, q in marks if rows[d]["held_out"]]
    assert np.mean([r["selected"] == (q == 1) for r, q in held]) >= 0.95
    assert all(0 <= r["tail_probability"] <= 1 for r in rows.values())


def test_features_do_not_depend_on_neighbours():
    texts = [b"One two two.", b"", b"ABC!! ABC!!", "é ñ\n\tx".encode(), b" " * 9]
    def summed(ts):
        out = [{} for _ in ts]
        for d, s, v in Q.features(ts):
            for a, b, c in zip(d, s, v):
                out[a][int(b)] = out[a].get(int(b), 0) + float(c)
        return out
    alone = [summed([t])[0] for t in texts]
    for a, b in zip(summed(texts), alone):
        assert a.keys() == b.keys() and all(abs(a[k] - b[k]) < 1e-12 for k in a)


def test_sample_is_bounded_by_pairs(spark, make_docs, monkeypatch):
    docs = [(i, " ".join(f"{'good' if i % 2 else 'bad'}{i}x{k}" for k in range(50))) for i in range(80)]
    lab = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, quality int")
    taken, fit = [], Q.fit
    monkeypatch.setattr(Q, "fit", lambda counts, *rest: taken.append(counts) or fit(counts, *rest))
    Q.learn(spark, make_docs(docs), lab)
    Q.learn(spark, make_docs(docs), lab, pairs=2000)
    Q.learn(spark, make_docs(docs), lab, pairs=1)
    assert len(taken[0]) > 50 and 2 < len(taken[1]) < len(taken[0]) and taken[1].sum() <= 2000 and len(taken[2]) == 2


def test_edges(spark, make_docs):
    docs = [(i, ("good plain words here " if i % 2 else "SPAM!! ### ") * 5) for i in range(60)] + [
        (70, None), (71, ""), (None, "x"), (72, "good plain " * 30000), (72, "good plain " * 30000)]
    lab = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (70, None), (1, 1)], "doc_id long, quality int")
    got = Q.grade(spark, make_docs(docs), lab).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == len(docs) and by[72]["selected"] and by[1]["selected"] and not by[2]["selected"]
    assert 0 <= by[70]["expected_grade"] <= 1
    one = Q.grade(spark, make_docs(docs), lab.where("quality = 1")).collect()
    assert {(r["expected_grade"], r["tail_probability"]) for r in one} == {(1.0, 1.0)}
    none = Q.grade(spark, make_docs(docs), lab.limit(0)).collect()
    assert {r["expected_grade"] for r in none} == {0.0}
    assert Q.grade(spark, make_docs([]), lab).count() == 0
