import re

import xxhash

from tillhouse.llm import simhash
from tillhouse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hs = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs)) if hs else 0


def brute_groups(rows):
    fps = [(d, brute_fingerprint(t)) for d, t in rows]
    group = list(range(len(fps)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i][1] ^ fps[j][1]).count("1") <= 3:
                group[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(fps):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, f"{fp:016x}", low.get(root(i))) for i, (d, fp) in enumerate(fps)), key=str)


def test_query_matches_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = sorted(map(tuple, QUERIES["op10_simhash_near_dedup"](spark, SF).collect()), key=str)
    assert got == brute_groups(rows)


def test_edges(spark, make_docs):
    rows = [(1, None), (2, ""), (3, "  \t\n"), (4, "One"), (5, "one"), (6, "a b c"), (7, "A  b\nC"), (7, "A  b\nC"),
            (None, "a b c"), (None, "zz yy"), (8, "x y z w " * 5000), (9, "x Y z w " * 5000), (10, "é ü ñ")]
    df = make_docs(rows)
    g = simhash.simhash_groups(spark, df)
    got = sorted(((r["doc_id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component_id"]) for r in g.collect()), key=str)
    assert got == brute_groups(rows)
    kept = simhash.keep_first(spark, df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == \
        [(False, 1), (False, 4), (False, 6), (False, 8), (False, 10), (True, 0)]
    empty = make_docs([])
    assert simhash.simhash_groups(spark, empty).count() == 0 and simhash.keep_first(spark, empty).count() == 0


def test_links_within_three_bits_are_whole(spark):
    import random

    rng = random.Random(5)
    fps = [rng.getrandbits(64) for _ in range(60)]
    for f in list(fps):
        for _ in range(12):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 4)):
                g ^= 1 << b
            fps.append(g)
    fps = sorted(set(fps))
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    group = {f[0]: f[0] for f in signed}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if bin((a[0] ^ b[0]) & (1 << 64) - 1).count("1") <= 3:
                ra, rb = sorted((root(a[0]), root(b[0])))
                group[rb] = ra
    want = {f[0]: root(f[0]) for f in signed}
    from tillhouse.llm.common import components

    for n in (len(fps), 10 ** 9, 10 ** 12):     # the three depths of the trees
        nodes = {r["node"]: r["root"] for r in components(spark, simhash.links(df, n)).collect()}
        assert {f[0]: nodes.get(f[0], f[0]) for f in signed} == want


def test_full_shards_are_divided(spark):
    """Fingerprints that agree in most bits: shards go down all depths, then to parts; no link is lost, no task is large."""
    import random

    rng = random.Random(11)
    hot, fps = rng.getrandbits(64), set()
    while len(fps) < 700:                       # one half nearly fixed, the other spread over 14 bits
        f = hot
        for b in rng.sample(range(14), rng.randint(0, 9)):
            f ^= 1 << b
        if rng.random() < 0.2:
            f ^= 1 << rng.randint(40, 44)
        fps.add(f)
    fps |= {rng.getrandbits(64) for _ in range(200)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")

    def groups(pairs):
        group = {f: f for f in signed}

        def root(x):
            while group[x] != x:
                x = group[x]
            return x

        for a, b in pairs:
            ra, rb = sorted((root(a), root(b)))
            group[rb] = ra
        return {f: root(f) for f in signed}

    want = groups((a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    for bound in (2000, 300, 40):       # the first depth holds all; the last; parts
        sizes = simhash.tasks(df, len(fps), bound).groupBy("task").count()
        assert sizes.agg({"count": "max"}).first()[0] <= 2 * bound
        assert groups(map(tuple, simhash.links(df, len(fps), shard_rows=bound).collect())) == want
