"""Archives written, indexed and read back."""
import base64
import gzip
import hashlib
from urllib.parse import urlparse

import pytest

from corpusprep.llm import warc
from corpusprep.llm.warc import archive_folder, coalesce_reads, parse, read, record, write


def test_reads_are_coalesced():
    spans = [(0, 10), (10, 5), (100, 10), (1000, 10), (1010, 2000)]
    assert coalesce_reads(spans, 100, 500) == [(0, 110, 0, 3), (1000, 1010, 3, 4), (1010, 3010, 4, 5)]
    assert coalesce_reads([], 1, 1) == []


def test_record_round_trip():
    for url, payload in ((None, b""), ("http://x/é\r\nX: y", "p\r\n\r\né".encode())):
        head, back = parse(record(5, url, payload, warc.digest(payload), None))
        assert back == payload and head["WARC-Type"] == "response" and "X" not in head
    with pytest.raises(ValueError):
        parse(record(5, None, b"abc", "D", None)[:-2])


def test_write_index_read(spark):
    pages = [(i, f"http://h.example.com/{i}", t) for i, t in enumerate(["<p>a</p>", "", None, "<p>a</p>", "é" * 5000, "<p>b</p>", "<p>a</p>"])]
    pages += [(5, "http://h.example.com/5", "<p>b</p>"), (None, None, "<p>a</p>"), (9, "big", "z" * 3_000_000)]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, sha string, nth int").repartition(3)
    folder = archive_folder(spark)
    index = write(df, folder, archive_bytes=20_000)
    rows = read(index, folder).collect()
    want = []
    for text in {p[2] or "" for p in pages}:
        group = sorted((p for p in pages if (p[2] or "") == text), key=lambda p: (p[0] is None, p[0] or 0))
        for i, *_ in group:
            raw = text.encode()
            n = i != group[0][0]
            want.append((str(i), len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if n else "response",
                         str(group[0][0]) if n else None, None if n else raw))
    assert sorted(map(str, want)) == sorted(str((str(r["key"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers"],
                                                 None if r["payload"] is None else bytes(r["payload"]))) for r in rows)
    small = read(index, folder, payloads=False, task_bytes=500)  # tasks by bytes, however few the index rows are
    assert small.rdd.getNumPartitions() == -(-sum(r["length"] for r in index.collect()) // 500) > 4
    assert sorted(r["payload_digest"] for r in small.collect()) == sorted(r["payload_digest"] for r in rows)
    some = read(index.where("record_type = 'revisit'"), folder, payloads=False)
    assert "payload" not in some.columns and some.count() == sum(w[3] == "revisit" for w in want)
    for r in index.collect():  # members stand where the index says, and whole archives are valid gzip
        with open(f"{urlparse(folder).path}/archives/{r['archive']}", "rb") as f:
            whole = f.read()
        head, _ = parse(gzip.decompress(whole[r["offset"]: r["offset"] + r["length"]]))
        assert head["WARC-Payload-Digest"] == f"sha1:{r['payload_digest']}"
        assert gzip.decompress(whole).count(b"WARC/1.1\r\n") >= 1
    empty = archive_folder(spark)
    assert read(write(df.limit(0), empty), empty).collect() == []


def test_damage_is_an_error(spark):
    folder = archive_folder(spark)
    index = write(spark.createDataFrame([(1, "u", "abc" * 100)], "page_id long, url string, html string"), folder)
    r = index.first()
    path = f"{urlparse(folder).path}/archives/{r['archive']}"
    with open(path, "rb") as f:
        good = gzip.decompress(f.read())
    with open(path, "wb") as f:
        f.write(warc._member(good.replace(b"abcabc", b"abcabd", 1))[: r["length"]].ljust(r["length"], b"\0"))
    with pytest.raises(Exception):
        read(index, folder).collect()
