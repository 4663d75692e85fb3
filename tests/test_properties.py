"""Keyed write semantics against a plain-Python model (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillhouse.operators.keys import assign_surrogate_keys
from tillhouse.operators.upsert import insert_if_absent, upsert_by_key, upsert_scd1

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keys = st.sets(st.integers(min_value=-50, max_value=200), max_size=25)
attrs = st.sampled_from(["a", "b", "c"])


@settings(**SETTINGS)
@given(target_keys=keys, source_keys=keys, data=st.data())
def test_upsert_scd1_model(spark, target_keys, source_keys, data):
    target = [(i + 1, k, data.draw(attrs)) for i, k in enumerate(sorted(target_keys))]
    source = [(k, data.draw(attrs)) for k in sorted(source_keys)]
    t = spark.createDataFrame(target or [(0, 0, "x")], "sk long, k long, v string")
    if not target:
        t = t.limit(0)
    s = spark.createDataFrame(source or [(0, "x")], "k long, v string")
    if not source:
        s = s.limit(0)
    out = {r["k"]: (r["sk"], r["v"]) for r in upsert_scd1(t, s, "k", "sk").collect()}
    # model
    expect_v = {k: v for _, k, v in target}
    expect_v.update(dict(source))
    assert {k: v for k, (_, v) in out.items()} == expect_v
    old_sk = {k: sk for sk, k, _ in target}
    for k, (sk, _) in out.items():
        if k in old_sk:
            assert sk == old_sk[k]
    new = sorted(sk for k, (sk, _) in out.items() if k not in old_sk)
    assert new == list(range(len(target) + 1, len(target) + 1 + len(new)))


@settings(**SETTINGS)
@given(target_keys=keys, source_keys=st.lists(st.integers(min_value=0, max_value=60), max_size=25))
def test_insert_if_absent_model(spark, target_keys, source_keys):
    t = spark.createDataFrame([(k, "old") for k in sorted(target_keys)] or [(0, "x")], "k long, v string")
    if not target_keys:
        t = t.limit(0)
    s = spark.createDataFrame([(k, "new") for k in source_keys] or [(0, "x")], "k long, v string")
    if not source_keys:
        s = s.limit(0)
    out = sorted((r["k"], r["v"]) for r in insert_if_absent(t, s, "k").collect())
    expect = sorted([(k, "old") for k in target_keys] + [(k, "new") for k in set(source_keys) - target_keys])
    assert out == expect


@settings(**SETTINGS)
@given(target_keys=keys, source_keys=keys)
def test_upsert_by_key_model(spark, target_keys, source_keys):
    t = spark.createDataFrame([(k, 1) for k in sorted(target_keys)] or [(0, 0)], "k long, v int")
    if not target_keys:
        t = t.limit(0)
    s = spark.createDataFrame([(k, 2) for k in sorted(source_keys)] or [(0, 0)], "k long, v int")
    if not source_keys:
        s = s.limit(0)
    out = sorted((r["k"], r["v"]) for r in upsert_by_key(t, s, "k").collect())
    expect = {k: 1 for k in target_keys}
    expect.update({k: 2 for k in source_keys})
    assert out == sorted(expect.items())


@settings(**SETTINGS)
@given(ks=keys, base=st.integers(min_value=0, max_value=10_000), buckets=st.integers(min_value=1, max_value=9))
def test_assign_keys_dense_and_stable(spark, ks, base, buckets):
    df = spark.createDataFrame([(k,) for k in sorted(ks)] or [(0,)], "k long")
    if not ks:
        df = df.limit(0)
    a = {r["k"]: r["sk"] for r in assign_surrogate_keys(df, ["k"], "sk", base, buckets=buckets).collect()}
    b = {r["k"]: r["sk"] for r in assign_surrogate_keys(df.repartition(3), ["k"], "sk", base,
                                                           buckets=buckets).collect()}
    assert a == b
    assert sorted(a.values()) == list(range(base + 1, base + 1 + len(ks)))
