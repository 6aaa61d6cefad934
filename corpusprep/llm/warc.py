"""Web archives, index first.

Writing: every task writes its records as gzip members into archives of its own in a shared folder and
returns one index row per record - archive, offset, length, address, digest. Archives bear a name that
no other attempt uses, and only the rows of tasks that finished come into the index, so the archives of
a lost attempt are never read. Of records with equal payloads that with the smallest key is a
``response``; the others are ``revisit`` records, which carry the digest and point to it.

Reading: index rows, selected by any condition, are dealt out by ranges of archive and offset, and
each task turns its rows, in order, into few byte-range reads: neighbouring records are fetched together
unless a gap is larger than ``MAX_GAP`` or the read longer than ``MAX_READ``.

Equal payloads are found by a grouped aggregation over digests (narrow rows, pre-aggregated) and an
equi-join, which adaptive execution can split, so a payload shared by a third of all pages is no bottleneck.

Defined cases: a null payload is empty; null addresses write no target; null keys count as the largest;
rows that share the smallest key of a payload are one page and all responses; an empty table gives no
archive and no rows.
"""
from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusprep.session import shared_path

ARCHIVE_BYTES = 64 << 20
TASK_BYTES = 16 << 20  # compressed bytes of an archive that one task reads in a stretch
MAX_GAP = 64 << 10
MAX_READ = 4 << 20
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str) -> str:
    return quote(url, safe="%/:?#[]@!$&'()*+,;=~-._")


def record(key, url: str | None, payload: bytes, sha: str, first) -> bytes:
    """One record; ``first``: the key whose payload this one repeats, or None."""
    head = [("WARC-Type", "response" if first is None else "revisit"), ("WARC-Record-ID", f"<urn:page:{key}>"), ("WARC-Date", DATE)]
    if url is not None:
        head.append(("WARC-Target-URI", _uri(url)))
    head.append(("WARC-Payload-Digest", f"sha1:{sha}"))
    if first is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<urn:page:{first}>"), ("X-Payload-Length", str(len(payload)))]
    block = HTTP + payload if first is None else HTTP
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not at a record")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block, end = rest[: int(headers["Content-Length"])], rest[int(headers["Content-Length"]):]
    if end != b"\r\n\r\n":
        raise ValueError("record of another length")
    return headers, block.partition(b"\r\n\r\n")[2]


def _member(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


INDEX = "archive string, offset long, length long, record_type string, payload_digest string, payload_bytes long"


def _writer(folder: str, archive_bytes: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for key, url, text, first in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                payload = (text or "").encode("utf-8", "surrogatepass")
                sha = digest(payload)
                data = _member(record(key, url, payload, sha, first))
                if out is None or at + len(data) > archive_bytes and at:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None, buffer_size=1 << 20)
                out.write(data)
                rows.append((name, at, len(data), "response" if first is None else "revisit", sha, len(payload)))
                at += len(data)
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True))],
                                             names=["key", "url", "archive", "offset", "length", "record_type", "payload_digest", "payload_bytes"])
        if out is not None:
            out.close()

    return scan


def write(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", payload: str = "html", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the archives into ``folder`` (a URI all executors reach) and return the index, stored beside them."""
    spark = pages.sparkSession
    kind = pages.schema[key].dataType.simpleString()
    sha = F.sha1(F.coalesce(F.col(payload), F.lit("")).cast("binary"))
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(payload).alias("payload"), sha.alias("sha"))
    firsts = rows.groupBy("sha").agg(F.min("key").alias("first"))
    refers = F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first").cast("string"))
    marked = rows.join(firsts, "sha").select("key", "url", "payload", refers.alias("refers"))
    fs, base = pafs.FileSystem.from_uri(folder)
    fs.create_dir(f"{base}/archives", recursive=True)
    index = marked.mapInArrow(_writer(f"{folder}/archives", archive_bytes), f"key {kind}, url string, {INDEX}")
    index.write.parquet(f"{folder}/index")
    return spark.read.parquet(f"{folder}/index")


def coalesce_reads(spans: list[tuple[int, int]], max_gap: int = MAX_GAP, max_read: int = MAX_READ) -> list[tuple[int, int, int, int]]:
    """Sorted (offset, length) records -> (begin, end, first record, record behind the last) of each read."""
    out: list[tuple[int, int, int, int]] = []
    for i, (at, n) in enumerate(spans):
        if out and at - out[-1][1] <= max_gap and at + n - out[-1][0] <= max_read:
            out[-1] = (out[-1][0], max(out[-1][1], at + n), out[-1][2], i + 1)
        else:
            out.append((at, at + n, i, i + 1))
    return out


def _reader(folder: str, wanted: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = pafs.FileSystem.from_uri(folder)
        name, source = None, None
        for batch in batches:
            archives = batch.column(1).to_pylist()
            spans = list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
            headers, payloads, begin = [], [], 0
            while begin < len(archives):
                end = begin
                while end < len(archives) and archives[end] == archives[begin]:
                    end += 1
                if archives[begin] != name:
                    if source is not None:
                        source.close()
                    name = archives[begin]
                    source = fs.open_input_file(f"{base}/{name}")
                for lo, hi, first, last in coalesce_reads(spans[begin:end]):
                    data = memoryview(source.read_at(hi - lo, lo))
                    for at, n in spans[begin + first: begin + last]:
                        h, p = parse(zlib.decompress(data[at - lo: at - lo + n], 31))
                        headers.append(h)
                        payloads.append(p)
                begin = end
            types = [h["WARC-Type"] for h in headers]
            digests = [h["WARC-Payload-Digest"].partition(":")[2] for h in headers]
            for t, d, p in zip(types, digests, payloads, strict=True):
                if t == "response" and digest(p) != d:
                    raise ValueError(f"a payload differs from its digest {d}")
            columns = [batch.column(0), pa.array(types, pa.string()), pa.array([h.get("WARC-Target-URI") for h in headers], pa.string()), pa.array(digests, pa.string()),
                       pa.array([h["WARC-Refers-To"][10:-1] if "WARC-Refers-To" in h else None for h in headers], pa.string()),
                       pa.array([int(h["X-Payload-Length"]) if "X-Payload-Length" in h else len(p) for h, p in zip(headers, payloads, strict=True)], pa.int64())]
            names = ["key", "record_type", "target", "payload_digest", "refers", "payload_bytes"]
            if wanted:
                columns.append(pa.array([None if t == "revisit" else p for t, p in zip(types, payloads, strict=True)], pa.binary()))
                names.append("payload")
            yield pa.RecordBatch.from_arrays(columns, names=names)
        if source is not None:
            source.close()

    return scan


def read(index: DataFrame, folder: str, payloads: bool = True, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records of the index rows: ``key, record_type, target, payload_digest, refers`` (a key's text),
    ``payload_bytes`` (of the full payload) and, if wanted, ``payload`` (null for revisits). A response whose
    payload does not have its declared digest is an error."""
    kind = index.schema["key"].dataType.simpleString()
    # stretches of TASK_BYTES of an archive are dealt out, as many tasks as their bytes ask for: index rows are narrow and say nothing of the work
    stretch = F.floor(F.col("offset") / task_bytes).alias("stretch")
    total = index.agg(F.sum("length")).first()[0] or 0
    rows = index.select("key", "archive", "offset", "length", stretch)
    dealt = rows.repartition(max(1, -(-total // task_bytes)), "archive", "stretch").sortWithinPartitions("archive", "offset").drop("stretch")
    schema = f"key {kind}, record_type string, target string, payload_digest string, refers string, payload_bytes long"
    return dealt.mapInArrow(_reader(f"{folder}/archives", payloads), schema + ", payload binary" * payloads)


def archive_folder(spark: SparkSession) -> str:
    """A new folder in the shared place, as a URI."""
    path = shared_path(spark, "warc")
    if path.startswith("file:"):
        path = path[5:]
    return "file:///" + path.lstrip("/") if "://" not in path else path
