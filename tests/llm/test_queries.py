"""The registered queries on the given tables, against SQL where there is some, else against brute force."""
import base64
import hashlib
import os
import zlib

import duckdb
import pytest

from corpusprep.llm.queries import ORACLE, QUERIES, tokenizer_path
from tests.llm.test_lshforest import brute as similar

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    res = con.execute(ORACLE[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(tuple, df.select(*names).collect()), key=str) == sorted(res.fetchall(), key=str)


def test_packing_query(spark, con):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path())
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    ids = {d: [*lib.encode(t or "", add_special_tokens=False).ids, 0] for d, t in rows}
    got = QUERIES["op2_packing"](spark, SF).collect()
    seen: dict = {}
    for r in got:
        part = ids[r["doc_id"]][r["start"]: r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part)) and r["doc_tokens"] == len(ids[r["doc_id"]])
        seen.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert seen.keys() == ids.keys()
    for d, spans in seen.items():
        assert sum(n for _, n in spans) == len(ids[d]) and len({s for s, _ in spans}) == len(spans)


def test_jaccard_query(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()
    got = QUERIES["op10_jaccard_forest"](spark, SF).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in got) == sorted(similar(rows)[0])


def test_warc_query(spark, con):
    rows = con.execute("SELECT page_id, html FROM pages").fetchall()
    first: dict = {}
    for p, h in rows:
        first[h] = min(first.get(h, p), p)
    want = [(p, len((h or "").encode()), base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(),
             "response" if first[h] == p else "revisit", None if first[h] == p else first[h]) for p, h in rows]
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(tuple(r[n] for n in names) for r in QUERIES["op6_warc_index"](spark, SF).collect()) == sorted(want)


def test_row_per_input_row(spark, con):
    n = dict(con.execute("SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'pages', count(*) FROM pages").fetchall())
    for name, table in (("op1_language_id", "pages"), ("op5_importance_resampling", "documents"), ("op8_html_wrappers", "pages"), ("op9_license_scan", "documents")):
        assert QUERIES[name](spark, SF).count() == n[table], name
    found = QUERIES["op9_license_scan"](spark, SF).where("size(licenses) > 0").count()
    assert found == con.execute("SELECT count(*) FROM documents WHERE regexp_matches(text, 'MIT License|GNU General Public|CC BY-NC|Apache License')").fetchone()[0]


def test_entry_lists_all():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 14))
    assert os.path.exists(tokenizer_path()) and set(entry.oracle_sql()) <= set(names)
