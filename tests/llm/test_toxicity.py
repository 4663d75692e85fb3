import random
import zlib

import numpy as np

from tillhouse.llm import toxicity as X
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def kinds(text):
    sums = X.Matcher({"idiot": 5.0, "scum": 4.0, "bozo*": 3.0}).sums([text.encode()])[0]
    return {n: v for n, v in zip(X.NAMES, sums) if v}


def test_grammar():
    assert kinds("what an idiot") == {"insult": 5.0}
    assert kinds("you are an idiot") == {"directed_insult": 5.0}
    assert kinds("IDIOT, that is you") == {"directed_insult": 5.0}
    assert kinds("he is not an idiot") == {"softened": 5.0}
    assert kinds("she said the man was a complete idiot") == {"reported": 5.0}
    assert kinds("she said hello. the idiot") == {"insult": 5.0}          # a report ends with its clause
    assert kinds("never in all my long life an idiot") == {"insult": 5.0}  # beyond the negation's scope
    assert kinds("kill you") == {"directed_threat": 1.0}
    assert kinds("an idiot! such scum. idiot idiot") == {"insult": 14.0}  # a clause counts once
    assert kinds("bozoish behaviour") == {"insult": 3.0} and kinds("bozo") == {} and kinds("the weather is fine") == {}


def brute_machine(symbols):
    """The three rewritings one after the other, each over the whole string."""
    left, a = 0, []
    for s in symbols:
        left, out = X._negation(left, s)
        a.append(out)
    told, b = False, []
    for s in a:
        told, out = X._report(told, s)
        b.append(out)
    state, c = (0, 0, 0), []
    for s in b:
        state, out = X._target(state, s)
        c.append(out)
    return c


def test_composition():
    nexts, outs = X.grammar()
    rng = random.Random(2)
    for _ in range(300):
        symbols = [rng.randrange(7) for _ in range(40)]
        state, got = 0, []
        for s in symbols:
            got.append(outs[state][s])
            state = nexts[state][s]
        assert got == brute_machine(symbols)


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in QUERIES["op4_toxicity"](spark, SF).collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5) for d, r in rows.items())
    marks = [(r["doc_id"], r["toxic"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    held = [(rows[d], t) for d, t in marks if rows[d]["held_out"]]
    assert np.mean([r["predicted"] == t for r, t in held]) >= 0.9
    assert np.mean([r["predicted"] for r, t in held if not t]) <= 0.03


def test_edges(spark, make_docs):
    docs = [(i, f"some calm text number {i} about {w} things") for i, w in enumerate("red blue green grey dark pale warm cold".split() * 6)]
    docs += [(100 + i, f"{w} blorg {v} go away") for i, (w, v) in enumerate((a, b) for a in "oh hey well so now ah um ooh".split() for b in
                                                                                   "please just never do always really then".split())]
    docs += [(500, None), (501, ""), (502, "?!"), (None, "blorg you"), (503, "you blorg. " * 20000), (503, "you blorg. " * 20000)]
    labels = [(d, int(d >= 100)) for d, _ in docs if d is not None and d < 500] + [(None, 1), (9999, 1), (3, 0), (500, None)]
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = X.toxicity(spark, make_docs(docs), lab).collect()
    assert len(got) == len(docs) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert by[500] == by[501] == by[502] == by[1] == 0 and by[503] == by[104] == 1
    assert X.toxicity(spark, make_docs([]), lab).count() == 0
    assert X.toxicity(spark, make_docs(docs), lab.limit(0)).count() == len(docs)
