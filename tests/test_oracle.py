"""Every registered query with an oracle equals its DuckDB SQL on sf0.01 (order-insensitive)."""
import math
import os

import pytest

from samples import SF01

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as E  # noqa: E402
from corpusprep.sources.tables import TABLES  # noqa: E402

from corpusprep.plans.queries import ORACLE  # noqa: E402


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return v


def _canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF01):
        pytest.skip("sf0.01 tables not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF01)
    rows, cols = [tuple(r) for r in df.collect()], df.columns
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _canon(rows, cols) == _canon(orows, ocols)


def test_first_merge_of_the_vocabulary_queries(spark, con):
    """Learned merges have no SQL; the first one is the most frequent pair of neighbouring characters."""
    from corpusprep.plans.queries import _CLEAN_SQL
    from corpusprep.plans import oracle_sql as O

    sql = (f"{_CLEAN_SQL}, t AS (SELECT unnest({O.pretokens('src')}) AS w FROM clean UNION ALL SELECT unnest({O.pretokens('tgt')}) FROM clean), "
           "f AS (SELECT w, count(*) AS n FROM t GROUP BY w), p AS (SELECT w, n, unnest(range(1, length(w))) AS i FROM f), "
           "q AS (SELECT substr(w, i, 1) AS l, substr(w, i + 1, 1) AS r, n FROM p) "
           "SELECT l, r, sum(n) AS total FROM q GROUP BY l, r ORDER BY total DESC, unicode(l), unicode(r) LIMIT 1")
    left, right, _ = con.execute(sql).fetchone()
    merges = E.queries()["bpe_learn"](spark, SF01).orderBy("rank").collect()
    assert (merges[0]["left"], merges[0]["right"]) == (left, right)
    tokens = [r["token"] for r in E.queries()["vocab_table"](spark, SF01).orderBy("id").collect()]
    made = list(dict.fromkeys(m["left"] + m["right"] for m in merges))
    assert len(made) > 5000 and tokens[-len(made):] == made  # learnt to the end: no cut in the number of merges


def test_learning_ends_when_no_pair_is_left(spark, con):
    """The merges of the query, applied to the words by SQL's counts, leave no pair that occurs twice."""
    from collections import Counter

    from corpusprep.plans.queries import _CLEAN_SQL
    from corpusprep.plans import oracle_sql as O

    sql = (f"{_CLEAN_SQL}, t AS (SELECT unnest({O.pretokens('src')}) AS w FROM clean UNION ALL SELECT unnest({O.pretokens('tgt')}) FROM clean) "
           "SELECT w, count(*) FROM t GROUP BY w")
    rank: dict = {}
    for r in E.queries()["bpe_learn"](spark, SF01).collect():
        rank.setdefault((r["left"], r["right"]), []).append(r["rank"])
    left = Counter()
    for word, n in con.execute(sql).fetchall():
        sym, done = list(word), -1
        while True:
            found = min(((k, i) for i, p in enumerate(zip(sym, sym[1:])) for k in rank.get(p, ()) if k > done), default=None)
            if found is None:
                break
            done, i = found
            pair, out, j = (sym[i], sym[i + 1]), [], 0
            while j < len(sym):
                both = j + 1 < len(sym) and (sym[j], sym[j + 1]) == pair
                out.append(sym[j] + sym[j + 1] if both else sym[j])
                j += 2 if both else 1
            sym = out
        for p in zip(sym, sym[1:]):
            left[p] += n
    assert max(left.values(), default=0) < 2


def test_entry_smoke(spark):
    df = E.entry(spark)
    r = df.first()
    assert r is not None and r["seen"] >= r["n"]


def test_vocab_job_learns_from_all_valid_pairs(spark):
    job, whole = (E.queries()[q](spark, SF01).orderBy("rank").collect() for q in ("vocab_job", "bpe_learn"))
    assert job == whole
