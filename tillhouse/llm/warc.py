"""WARC records in ZIP archives, written and read in place.

Writing.  Pages become WARC/1.1 records; of records with equal payloads of at
least MIN_REVISIT bytes, the one with the smallest id is a response and the
others are revisits that refer to it.  Each task packs its records into
archives of about ARCHIVE_BYTES: a ZIP file with two stored (uncompressed)
members, ``archive/data.warc.gz`` (each record a gzip member of its own, so
that it can be read alone) and ``indexes/index.cdxj``, with ZIP64 fields where
a size needs them (or always, on demand).  Archives are written under an
attempt's own name to the shared folder; the stored list of archives names
those of the attempts that counted, so a retried task leaves nothing behind
that a reader would see.

Reading.  From the archive's end: end-of-central-directory record, ZIP64
locator and record if there are any, central directory, and each member's
local header, all by ranged reads; then the index member, then each record by
its own byte range, in groups of neighbours of about READ_BYTES.  Nothing is
extracted.  A response's payload is checked against its digest.

Archives are opened by pyarrow's file systems; Hadoop's names of the same
stores (s3a, s3n, wasb, wasbs) are put in its terms, and credentials are taken
from the workers' environment.

Edge cases: a null html is an empty payload; a null url an empty target; a
page without id revisits like any other, and is a response where no page of
its payload has an id; rows that repeat the smallest id of a payload are all
responses; an empty table gives no archives and no records; other columns are
ignored.
"""

from __future__ import annotations

import gzip
import hashlib
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillhouse.llm.common import shared_dir, stage

MIN_REVISIT = 100
ARCHIVE_BYTES = 16 << 20
READ_BYTES = 1 << 20
DATE = "2020-01-01T00:00:00Z"       # capture time: the tables have none
DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
LEVEL = 4

LOCAL, CENTRAL, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50
BIG = 0xFFFFFFFF


# ---- ZIP (stored members) -----------------------------------------------------

class ZipWriter:
    """Stored members to a stream; sizes are known when a member is added."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.zip64, self.at, self.central = out, zip64, 0, []

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def add(self, name: str, chunks: list[bytes]) -> None:
        raw, size, crc, start = name.encode(), sum(map(len, chunks)), 0, self.at
        for c in chunks:
            crc = zlib.crc32(c, crc)
        big = self.zip64 or size >= BIG or start >= BIG
        extra = struct.pack("<HHQQ", 1, 16, size, size) if big else b""
        shown = BIG if big else size
        self._write(struct.pack("<IHHHHHIIIHH", LOCAL, 45 if big else 20, 0x800, 0, 0, 0x21, crc, shown, shown, len(raw), len(extra)) + raw + extra)
        for c in chunks:
            self._write(c)
        extra = struct.pack("<HHQQQ", 1, 24, size, size, start) if big else b""
        self.central.append(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45 if big else 20, 0x800, 0, 0, 0x21, crc, shown, shown,
                                        len(raw), len(extra), 0, 0, 0, 0, BIG if big else start) + raw + extra)

    def close(self) -> None:
        start, n = self.at, len(self.central)
        for c in self.central:
            self._write(c)
        size = self.at - start
        if self.zip64 or start >= BIG or size >= BIG or n >= 0xFFFF:
            where = self.at
            self._write(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, start))
            self._write(struct.pack("<IIQI", LOCATOR64, 0, where, 1))
            n, size, start = 0xFFFF, BIG, BIG
        self._write(struct.pack("<IHHHHIIH", END, 0, 0, n, n, size, start, 0))


def members(read, length: int) -> dict[str, tuple[int, int]]:
    """Name -> (offset, size) of the stored members; read(offset, n) is a ranged read of the archive."""
    tail_at = max(0, length - 22 - 0xFFFF)
    tail = read(tail_at, length - tail_at)
    k = tail.rfind(struct.pack("<I", END))
    while k >= 0 and (len(tail) < k + 22 or k + 22 + struct.unpack_from("<H", tail, k + 20)[0] != len(tail)):
        k = tail.rfind(struct.pack("<I", END), 0, k)
    if k < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, n, size, start, _ = struct.unpack_from("<IHHHHIIH", tail, k)
    if n == 0xFFFF or size == BIG or start == BIG:
        sign, _, where, _ = struct.unpack("<IIQI", read(tail_at + k - 20, 20))
        if sign != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        record = struct.unpack("<IQHHIIQQQQ", read(where, 56))
        if record[0] != END64:
            raise ValueError("no ZIP64 end of central directory")
        n, size, start = record[7], record[8], record[9]
    directory, at, out = read(start, size), 0, {}
    for _ in range(n):
        f = struct.unpack_from("<IHHHHHHIIIHHHHHII", directory, at)
        if f[0] != CENTRAL:
            raise ValueError("broken central directory")
        method, packed, size, offset = f[4], f[8], f[9], f[16]
        name = directory[at + 46:at + 46 + f[10]].decode()
        extra = directory[at + 46 + f[10]:at + 46 + f[10] + f[11]]
        at += 46 + f[10] + f[11] + f[12]
        while len(extra) >= 4:
            kind, width = struct.unpack_from("<HH", extra)
            if kind == 1:
                wide = iter(struct.unpack(f"<{width // 8}Q", extra[4:4 + width // 8 * 8]))
                size = next(wide) if size == BIG else size
                packed = next(wide) if packed == BIG else packed
                offset = next(wide) if offset == BIG else offset
            extra = extra[4 + width:]
        if method == 0:     # stored; others can't be read in place
            local = struct.unpack("<IHHHHHIIIHH", read(offset, 30))
            if local[0] != LOCAL:
                raise ValueError(f"no local header for {name}")
            out[name] = (offset + 30 + local[9] + local[10], size)
    return out


# ---- WARC ---------------------------------------------------------------------

def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, digest: str) -> bytes:
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest}")
    block = b"" if kind == "revisit" else b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n" + payload
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", f"WARC-Date: {DATE}",
            f"WARC-Target-URI: {(url or '').replace(chr(13), ' ').replace(chr(10), ' ')}",
            f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}"]
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if kind == "revisit":
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page: {refers_to}")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return ("WARC/1.1\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (lower-case names) and payload of one record."""
    if not raw.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode().split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[:int(fields["content-length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def mark_revisits(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  least: int = MIN_REVISIT) -> DataFrame:
    """Rows (page_id, url, payload, digest, kind, refers_to)."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    large = rows.where(F.octet_length("payload") >= least)
    first = large.groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1")
    marked = rows.join(first.withColumnRenamed("digest", "first_digest"),
                       (F.col("digest") == F.col("first_digest")) & (F.octet_length("payload") >= least), "left")
    revisit = F.col("n").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return marked.select("page_id", "url", "payload", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"),
                         F.when(revisit, F.col("first_id")).alias("refers_to"))


def store_uri(path: str) -> str:
    """The path as pyarrow names it: Hadoop's schemes of object stores mapped, local paths as file URIs."""
    scheme, mark, rest = path.partition("://")
    if not mark:
        return f"file://{path.removeprefix('file:')}"
    if scheme in ("wasb", "wasbs"):
        host, slash, name = rest.partition("/")
        return f"abfs{scheme[4:]}://{host.replace('.blob.', '.dfs.', 1)}{slash}{name}"
    return f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}"


def write_archives(spark: SparkSession, records: DataFrame, archive_bytes: int = ARCHIVE_BYTES, zip64: bool = False) -> DataFrame:
    """The stored list of archives: path, bytes, records."""
    folder = store_uri(shared_dir(spark, "archives"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        held, index, size = [], [], 0

        def flush() -> pa.RecordBatch:
            name = f"{uuid.uuid4().hex}.zip"
            with store.open_output_stream(f"{root}/{name}") as out:
                z = ZipWriter(out, zip64)
                z.add(DATA, held)
                z.add(INDEX, ["".join(index).encode()])
                z.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([z.at]), pa.array([len(index)], pa.int64())],
                                              ["path", "bytes", "records"])

        for b in batches:
            for k in range(b.num_rows):
                page_id, url, payload, digest, kind, refers_to = (c[k].as_py() for c in b.columns)
                raw = gzip.compress(record(page_id, url, payload, kind, refers_to, digest), LEVEL, mtime=0)
                index.append(f"{digest} {kind} {size} {len(raw)}\n")
                held.append(raw)
                size += len(raw)
                if size >= archive_bytes:
                    yield flush()
                    held, index, size = [], [], 0
        if held:
            yield flush()

    return stage(spark, records.select("page_id", "url", "payload", "digest", "kind", "refers_to")
                 .mapInArrow(run, "path string, bytes long, records long"), "archive-list")


def _opened(path: str):
    store, name = fs.FileSystem.from_uri(store_uri(path))
    f = store.open_input_file(name)
    return f, f.size(), lambda offset, n: f.read_at(n, offset)


def list_ranges(archives: DataFrame, read_bytes: int = READ_BYTES) -> DataFrame:
    """Byte ranges of the records by the archives' indexes: neighbours together, one row per range."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                f, length, read = _opened(path)
                with f:
                    found = members(read, length)
                    data, (at, n) = found[DATA][0], found[INDEX]
                    entries = [tuple(map(int, line.split(b" ")[2:])) for line in read(at, n).splitlines()]
                out, k = [], 0
                while k < len(entries):
                    j, size = k, 0
                    while j < len(entries) and (j == k or size + entries[j][1] <= read_bytes):
                        size += entries[j][1]
                        j += 1
                    out.append((path, data + entries[k][0], [n for _, n in entries[k:j]]))
                    k = j
                yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.int64()),
                                                  pa.array([o[2] for o in out], pa.list_(pa.int64()))], ["path", "offset", "lengths"])

    return archives.select("path").mapInArrow(run, "path string, offset long, lengths array<long>")


def read_records(spark: SparkSession, archives: DataFrame, payloads: bool = False, read_bytes: int = READ_BYTES) -> DataFrame:
    """One row per record, read by range: page_id, url, payload_bytes, payload_digest, record_type, refers_to(, payload)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.binary()] * payloads
        names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
        for b in batches:
            for path, offset, lengths in zip(*(c.to_pylist() for c in b.columns)):
                f, _, read = _opened(path)
                with f:
                    raw = read(offset, sum(lengths))
                out, at = [], 0
                for n in lengths:
                    h, payload = parse(gzip.decompress(raw[at:at + n]))
                    at += n
                    kind, digest, size = h["warc-type"], h["warc-payload-digest"].removeprefix("sha256:"), int(h["x-payload-length"])
                    if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"{path}: the payload at {offset + at - n} does not match its digest")
                    number = lambda key: int(h[key]) if key in h else None  # noqa: E731, B023
                    out.append((number("x-page-id"), h["warc-target-uri"], size, digest, kind, number("x-refers-to-page"), payload))
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names)

    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))     # given, so that a few small rows are not drawn into one task
    ranges = list_ranges(archives.repartition(n, "path"), read_bytes)
    return ranges.repartition(n, "path", "offset").mapInArrow(run, schema + ", payload binary" * payloads)


def archive_pages(spark: SparkSession, pages: DataFrame, **options: object) -> DataFrame:
    """Write ``pages`` to archives and read every record back."""
    return read_records(spark, write_archives(spark, mark_revisits(pages), **options))
