"""The pipeline's stages one after the other against the operators' brute-force versions."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from tillhouse.llm import langid
from test_decontaminate import brute as brute_hits
from test_linededup import brute as brute_lines
from test_packing import check as check_pieces
from test_simhash import brute_groups

SF = "/root/testdata/sf0.01"


def test_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    from tillhouse.llm.common import stage

    names = [n for n, _ in P.STAGES]
    assert names == ["language_id", "line_dedup", "simhash_near_dedup", "decontamination", "packing"]
    rows, columns = [(r["doc_id"], r["text"]) for r in docs.collect()], docs.columns
    for name, step in P.STAGES:
        if name == "simhash_near_dedup":     # line dedup may leave no copies here: plant some
            copies = docs.where("length(text) > 200").orderBy("doc_id").limit(5).withColumn("doc_id", F.col("doc_id") + 10**6)
            docs = stage(spark, docs.union(copies), "planted")
            rows += [(r["doc_id"], r["text"]) for r in docs.where(f"doc_id >= {10**6}").collect()]
        out = stage(spark, step(spark, docs, SF), name)
        if name == "packing":
            assert check_pieces(out.collect(), rows) < 0.02
            return
        assert out.columns == columns
        got = sorted((r["doc_id"], r["text"]) for r in out.collect())
        if name == "language_id":
            pred = {r["doc_id"]: r["lang_pred"] for r in langid.identify(spark, docs).collect()}
            want = [r for r in rows if pred[r[0]] != "und"]
        elif name == "line_dedup":
            old = dict(rows)
            want = [(d, t) for d, t in brute_lines(rows) if t.strip() or t == old[d]]
        elif name == "simhash_near_dedup":
            first = {d: c for d, _, c in brute_groups(rows)}
            want = [r for r in rows if first[r[0]] == r[0]]
        else:
            hit = {r[0] for r in brute_hits(rows, items) if r[-1]}
            want = [r for r in rows if r[0] not in hit]
            assert hit
        assert got == sorted(want) and len(want) < len(rows) or name == "language_id"
        docs, rows = out, want


def test_empty_and_null_documents(spark, make_docs, tmp_path):
    spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(1, None), (2, ""), (None, "the words of a text"), (3, "the words of a text"), (3, "the words of a text"), (4, "w " * 9000)]
    for given, kept in (([], [0, 0, 0, 0]), (rows, [4, 3, 2, 2])):
        docs = make_docs(given)
        left = []
        for name, step in P.STAGES:
            columns, docs = docs.columns, step(spark, docs, str(tmp_path))
            if name != "packing":
                assert docs.columns == columns
                left.append(docs.count())
        assert left == kept
        pieces = docs.collect()
        assert sum(p["length"] for p in pieces) == sum(n for _, n in {(p["doc_id"], p["doc_tokens"]) for p in pieces})
