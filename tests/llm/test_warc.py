import hashlib
import io
import random
import zipfile

import pytest

from tillhouse.llm import warc as W


def brute(pages):
    pay = [(i, (h or "").encode()) for i, h in pages]
    first = {}
    for i, p in pay:
        if len(p) >= 100 and i is not None:
            first[p] = min(first.get(p, i), i)
    out = []
    for i, p in pay:
        shared = len(p) >= 100 and p in first and i != first[p]
        out.append((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if shared else "response", first[p] if shared else None))
    return sorted(out, key=str)


PAGES = [(1, "é" * 50), (2, "é" * 50), (3, "x" * 99), (4, "x" * 99), (5, None), (6, ""), (9, "a\r\n\r\nb" * 40), (7, "a\r\n\r\nb" * 40),
         (7, "a\r\n\r\nb" * 40), (None, "é" * 50), (None, "lonely" * 30), (8, "WARC/1.1\r\n" * 50000)] + [(20 + i, "copy " * 60) for i in range(40)]


@pytest.mark.parametrize("options", [{}, {"archive_bytes": 3000}, {"zip64": True}])
def test_round_trip(spark, options):
    df = spark.createDataFrame([(i, "http://x/%s\r\nEvil: 1" % i, h, "n", "digest") for i, h in PAGES],
                               "page_id long, url string, html string, n string, digest string")
    archives = W.write_archives(spark, W.mark_revisits(df), **options)
    rows = W.read_records(spark, archives, payloads=True, read_bytes=2000).collect()
    assert sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=str) == brute(PAGES)
    for r in rows:
        if r["record_type"] == "response":
            assert hashlib.sha256(bytes(r["payload"])).hexdigest() == r["payload_digest"]
    for a in archives.collect():
        with zipfile.ZipFile(a["path"].removeprefix("file://")) as z:       # another reader agrees
            assert z.testzip() is None and set(z.namelist()) == {W.DATA, W.INDEX}
            assert len(z.read(W.INDEX).splitlines()) == a["records"]


def test_empty(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert W.archive_pages(spark, df).count() == 0


def test_members_of_foreign_archives():
    rng = random.Random(1)
    for zip64 in (False, True):
        for comment in (b"", b"PK\x05\x06 not the end"):
            buf = io.BytesIO()
            data = {f"m{k}/é.bin": rng.randbytes(rng.randint(0, 5000)) for k in range(9)}
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_STORED) as z:
                for name, d in data.items():
                    with z.open(name, "w", force_zip64=zip64) as f:
                        f.write(d)
                z.comment = comment
            raw = buf.getvalue()
            reads = []

            def read(offset, n, raw=raw, reads=reads):
                reads.append(n)
                return raw[offset:offset + n]

            got = W.members(read, len(raw))
            assert {n: raw[o:o + s] for n, (o, s) in got.items()} == data
    with pytest.raises(ValueError):
        W.members(lambda o, n: b"", 0)


def test_store_names():
    names = {"/a/b": "file:///a/b", "file:/a/b": "file:///a/b", "file:///a/b": "file:///a/b", "s3a://bucket/a/b": "s3://bucket/a/b",
             "s3n://bucket/a": "s3://bucket/a", "s3://bucket": "s3://bucket", "hdfs://name:8020/a": "hdfs://name:8020/a",
             "abfss://box@account.dfs.core.windows.net/a": "abfss://box@account.dfs.core.windows.net/a",
             "wasbs://box@account.blob.core.windows.net/a/b": "abfss://box@account.dfs.core.windows.net/a/b",
             "wasb://box@account.blob.core.windows.net": "abfs://box@account.dfs.core.windows.net"}
    assert {n: W.store_uri(n) for n in names} == names
