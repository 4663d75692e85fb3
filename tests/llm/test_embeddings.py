import numpy as np

from tillhouse.llm import embeddings as E
from tillhouse.llm.queries import QUERIES


def brute(rows, cosine=0.93):
    ok = [i for i, (_, v, lab) in enumerate(rows)
          if lab is not None and v and all(c is not None and np.isfinite(c) for c in v) and any(v)]
    unit = {i: np.array(rows[i][1], float) / np.linalg.norm(np.array(rows[i][1], float)) for i in ok}
    near = {i: [j for j in ok if j != i and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in ok}
    out = []
    for i, (d, _, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        comp = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((d, len(near.get(i, ())), comp, d == comp))
    return sorted(out, key=str)


def test_recall_against_all_pairs(spark):
    """Vectors with planted neighbours around the threshold, in several lengths and groups."""
    rng = np.random.default_rng(7)
    for size in (2, 8, 64, 200):
        rows, k = [], 0
        for g in range(150):
            c = rng.normal(size=size)
            for _ in range(4):
                noise = rng.normal(size=size) * np.linalg.norm(c) / np.sqrt(size)
                rows.append((k, (c + noise * rng.uniform(0, 0.45)).tolist(), g % 2))
                k += 1
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        got = {r["vec_id"]: r for r in E.near_embeddings(spark, df).collect()}
        want = {r[0]: r for r in brute(rows)}
        assert all(got[i]["n_links"] <= want[i][1] for i in want)
        assert sum(r["n_links"] for r in got.values()) >= 0.97 * sum(r[1] for r in want.values())


def test_query_recall(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op9_embedding_near_dedup"](spark, d).collect()), key=str)
    want = brute(rows)
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want) and len(got) == len(want)


def test_split_buckets_and_copies(spark, monkeypatch):
    rng = np.random.default_rng(1)
    c = rng.normal(size=16)
    rows = [(i, (c + 0.02 * rng.normal(size=16)).tolist(), 1) for i in range(120)] + [(200 + i, c.tolist(), 1) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    monkeypatch.setattr(E, "BLOCK", 16)
    assert sorted(map(tuple, E.near_embeddings(spark, df).collect()), key=str) == brute(rows)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [1.0, None], 1),
            (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [1.0, 0.0], None), (11, [1.0, 0.0, 0.0], 1), (12, [1.0], 1), (12, [1.0], 1),
            (None, [1.0, 0.0], 1), (13, [1e200, 1.0], 1), (14, [-1.0, 0.0], 1)]
    df = spark.createDataFrame([(*r, 5, 6) for r in rows], "vec_id long, embedding array<double>, label int, cid int, f int")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in E.near_embeddings(spark, df).collect()}
    assert got[1] == (3, 1, True) and got[2] == (3, 1, False) and got[13] == (3, 1, False) and got[None] == (3, 1, False)
    assert got[3] == (0, 3, True) and got[11] == (0, 11, True) and got[12] == (1, 12, True) and got[14] == (0, 14, True)
    assert all(got[k] == (0, k, True) for k in (4, 5, 6, 7, 8, 9, 10))
    assert E.near_embeddings(spark, df.limit(0)).count() == 0


def test_filters_keep_their_recall_in_large_tables():
    """Pairs at the threshold share a filter, whatever the table's size that the filters were made for."""
    rng = np.random.default_rng(5)
    for size in (64, 768):
        x = rng.normal(size=(400, size))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        z = rng.normal(size=x.shape)
        z -= (z * x).sum(axis=1, keepdims=True) * x
        y = 0.931 * x + np.sqrt(1 - 0.931 ** 2) * z / np.linalg.norm(z, axis=1, keepdims=True)
        for vectors in (10**5, 10**6, 10**8):
            filters = E.Filters(size, vectors)
            a, b = filters.decode(x), filters.decode(y)
            assert np.mean([len(np.intersect1d(p, q)) > 0 for p, q in zip(a, b)]) >= 0.97
            assert all(len(p) >= filters.least and (np.diff(p) > 0).all() for p in a) and np.mean([len(p) for p in a]) < 2 * E.LISTS


def test_smaller_filters():
    rng = np.random.default_rng(3)
    lists = [np.unique(rng.integers(0, 200, 5)) for _ in range(60)] + [np.array([150]), np.array([199])]
    i, j = np.triu_indices(len(lists), 1)
    made = E.SmallerFilters(lists, 120)
    made.at_once = 100
    assert made.shared(i, j).tolist() == [bool({f for f in lists[a] if f < 120} & set(lists[b])) for a, b in zip(i, j)]
