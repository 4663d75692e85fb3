import random
import re
from collections import Counter, defaultdict

from tillhouse.llm import linededup as L
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def mask(line):
    return " ".join("<*>" if re.search("[0-9]", t) else t for t in line.split(" "))


def templates(leaves, where, min_docs, similarity):
    """Members of the templates found in rounds: line -> documents of its template."""
    found, nodes = {}, [(members, False) for members in leaves]
    while nodes:
        following = []
        for members, again in nodes:
            votes = sum(len(where[x]) for x in members)
            if len(members) < 2 or votes < min_docs:
                continue
            have = Counter()
            for x in members:
                for at, token in enumerate(mask(x).split(" ")):
                    have[at, token] += len(where[x])
            open_, group = {}, []
            for x in members:
                tokens = list(enumerate(mask(x).split(" ")))
                able = [p for p in tokens if 2 * have[p] > min_docs]
                if len(able) < similarity * len(tokens):
                    continue
                same = [p for p in able if 2 * have[p] > votes]
                words = [p for p in same if p[1] != "<*>"]
                if (len(same) >= similarity * len(tokens) and len(words) >= 0.5 * len(tokens)
                        and len(words) >= similarity * sum(t != "<*>" for _, t in tokens)):
                    group.append(x)
                open_[x] = max((p for p in able if 2 * have[p] <= votes and have[p] >= min_docs), key=lambda p: (have[p], -p[0]), default=None)
            together = set().union(*(where[x] for x in group)) if group else set()
            left = len(together) >= min_docs
            if left:
                found.update(dict.fromkeys(group, together))
                open_ = {x: p for x, p in open_.items() if x not in group}
            if left and not again:
                following.append((list(open_), True))
                continue
            split = defaultdict(list)
            for x, p in open_.items():
                if p is not None:
                    split[p].append(x)
            following += [(part, False) for part in split.values()]
        nodes = following
    return found


def brute(docs, min_docs=3, similarity=0.8, exact_docs=2):
    """(doc_id, text) -> kept text, by plain loops."""
    where, leaves = defaultdict(set), defaultdict(set)
    for d, t in docs:
        for line in (t or "").split("\n"):
            if x := line.strip(" "):
                where[x].add(d)
                tokens = mask(x).split(" ")
                leaves[len(tokens), tuple(tokens[:3])].add(x)
    first = {}
    low = lambda s: min((x for x in s if x is not None), default=None)
    found = templates([sorted(m) for m in leaves.values()], where, min_docs, similarity)
    for x, own in where.items():
        if x in found or len(own) >= exact_docs:
            first[x] = low(found.get(x, own))
    out = []
    for d, t in docs:
        kept = [x for x in (t or "").split("\n") if (m := x.strip(" ")) not in first or (d is not None and d == first[m])]
        out.append((d, "\n".join(kept)))
    return out


def test_query_matches_brute_force(spark):
    import hashlib

    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {d: hashlib.sha256(t.encode()).hexdigest() for d, t in brute(docs)}
    got = QUERIES["op3_line_dedup"](spark, SF).collect()
    assert {r["doc_id"]: r["kept_sha256"] for r in got} == want and sum(r["n_dropped"] for r in got) > 0


def test_templates_and_edges(spark, make_docs):
    body = [" ".join([w] * 3 + ["goes on here", w]) for w in "alpha beta gamma delta epsilon zeta".split()]
    docs = [(i, f"Page {i} of 90 printed by user{i}\n{b}\nhome about contact") for i, b in enumerate(body)]
    docs += [(20 + i, f"the order was shipped to {c} on a monday morning by boat\nown line {c}{c}") for i, c in enumerate(["rome", "oslo", "bonn", "lima"])]
    docs += [(40, None), (41, ""), (42, "\n\n"), (None, "home about contact"), (43, "home about contact"), (44, "x y\nx y\nx y"),
             (45, "long " * 30000), (43, "home about contact"), (46, "  home about contact  \nrest")]
    df = make_docs(docs)
    rows = L.dedup_lines(spark, df)
    got = Counter((r["doc_id"], r["__kept"] or "") for r in rows.collect())
    assert got == Counter(brute(docs))
    text = dict(brute(docs))
    assert text[1] == body[1] and text[0].startswith("Page 0") and text[21] == "own line oslooslo" and text[44] == "x y\nx y\nx y"
    left = L.remove_recurring(spark, df)
    assert left.columns == df.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert 43 not in ids and None not in ids and {40, 41, 42, 46} <= set(ids)
    assert all(r["n_chars"] == len(r["text"] or "") for r in left.collect())
    assert L.dedup_lines(spark, make_docs([])).count() == 0


def test_tables_of_numbers_stay(spark, make_docs):
    rng = random.Random(3)
    rows = [(d, "\n".join(" ".join(str(rng.randint(1, 999)) for _ in range(rng.choice([3, 5, 8]))) for _ in range(12))) for d in range(30)]
    rows += [(100 + d, f"2024-01-{d + 10} {d * 7}\n12 45 99" if d < 2 else f"2024-02-{d} 5 7 {d} x\nPage {d}") for d in range(8)]
    got = Counter((r["doc_id"], r["__kept"]) for r in L.dedup_lines(spark, make_docs(rows)).collect())
    assert got == Counter(brute(rows))
    kept = dict(got.keys())
    assert all(kept[d] == t for d, t in rows if d < 100)
    assert kept[100] == rows[30][1] and kept[101] == rows[31][1].split("\n")[0]     # equal digit for digit
    assert [kept[100 + d].count("Page") for d in range(2, 8)] == [1, 0, 0, 0, 0, 0]


def test_no_python_in_the_plan(spark, make_docs):
    plan = L.dedup_lines(spark, make_docs([(1, "a\nb")]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_several_templates_behind_one_lead(spark, make_docs):
    cities = [f"{a}{b}" for a in ("ros", "tal", "ven", "mor", "kel") for b in ("ia", "on", "um", "as", "ek", "or", "il", "et")]
    by_boat = [f"the order was shipped to {c} on a monday morning by boat" for c in cities]
    called = [f"the order was cancelled by our client {c}{k} who wanted no tea" for c in cities for k in ("x", "y")][:60]
    even = [[f"in order to {body.replace('_', c)}" for c in cities[:30]] for body in (
        "reach the harbour of _ please follow yellow signs", "pay for _ you need one silver coin each",
        "see what _ looks like open a third window")]
    prose = ["in order to " + " ".join(f"{w}{k}" for w in cities[j:j + 9]) for j, k in enumerate("abcdefghijkl")]
    families = [by_boat, called, *even]
    docs = [(1000 * f + i, line) for f, family in enumerate(families) for i, line in enumerate(family)]
    docs += [(9000 + i, line) for i, line in enumerate(prose)]
    assert len({len(line.split()) for family in families for line in family}) == 1
    got = {r["doc_id"]: r["__kept"] for r in L.dedup_lines(spark, make_docs(docs)).collect()}
    assert {d: t for d, t in got.items() if t} == {d: t for d, t in docs if d % 1000 == 0 or d >= 9000}


def test_exact_lines_of_two_documents(spark, make_docs):
    passage = " ".join(f"word{c}" for c in "abcdefghijklmnopqrstuvwxyz" * 3)
    docs = [(1, f"one own line\n{passage}"), (2, f"{passage}\nanother line of its own"), (3, "short"), (4, "short\nrest"),
            (5, "the cat sat on red mats"), (6, "the cat sat on blue mats")]
    got = {r["doc_id"]: r["__kept"] for r in L.dedup_lines(spark, make_docs(docs)).collect()}
    assert got == dict(docs) | {2: "another line of its own", 4: "rest"}
