"""Conversation repair against an enumeration of all edit sequences."""
import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusprep.llm import repair as R

FULL = re.compile("(s?(ua)+)?")
CHAIN = ((), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user"))


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(R.SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, digest): the least of all edit sequences, by cost and then audit."""
    fault = faults(rows)
    best = (0, "", hashlib.sha256().hexdigest()) if not rows else None
    each = []
    for (role, text), f in zip(rows, fault, strict=True):
        own = [("D", 2, None)]
        if f not in ("blank", "duplicate"):
            extra = 5 if f == "truncated" else 0
            own += [("K", extra, (role, text)), ("R", 1 + extra, ("user", text)), ("R", 1 + extra, ("assistant", text))]
        each += [[("I" * len(c), 5 * len(c), [(x, "") for x in c]) for c in CHAIN], [(a, c, [t] if t else []) for a, c, t in own]]
    each.append([("I" * len(c), 5 * len(c), [(x, "") for x in c]) for c in CHAIN])
    for choice in itertools.product(*each):
        said = [t for _, _, ts in choice for t in ts]
        if FULL.fullmatch("".join(r[:1] or "_" for r, _ in said)):
            found = sum(c for _, c, _ in choice), "".join(a for a, _, _ in choice)
            if best is None or found < best[:2]:
                best = (*found, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest())
    return best


def plain(rows):
    """The same by keeping whole strings per state, for conversations of any length."""
    follow = {0: 2, 1: 2, 3: 2, 2: 3}
    name = {2: "user", 3: "assistant"}

    def insert(states):
        for _ in range(3):
            for s in (0, 1, 3, 2):
                if s in states:
                    c, a, t = states[s]
                    new = (c + 5, a + "I", (*t, (name[follow[s]], "")))
                    if follow[s] not in states or new[:2] < states[follow[s]][:2]:
                        states[follow[s]] = new
        return states

    states = insert({0: (0, "", ())})
    for (role, text), f in zip(rows, faults(rows), strict=True):
        nxt = {}
        for s, (c, a, t) in states.items():
            offers = [(s, (c + 2, a + "D", t))]
            if f not in ("blank", "duplicate"):
                e = 5 if f == "truncated" else 0
                to = follow[s]
                if role[:1] == name[to][0]:
                    offers.append((to, (c + e, a + "K", (*t, (role, text)))))
                if s == 0 and role[:1] == "s":
                    offers.append((1, (c + e, a + "K", (*t, (role, text)))))
                offers.append((to, (c + 1 + e, a + "R", (*t, (name[to], text)))))
            for to, new in offers:
                if to not in nxt or new[:2] < nxt[to][:2]:
                    nxt[to] = new
        states = insert(nxt)
    c, a, t = min((states[s] for s in (0, 3) if s in states), key=lambda x: x[:2])
    return c, a, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in t).encode()).hexdigest()


def stream(rows):
    run = R.Repair()
    for (role, text), f in zip(rows, faults(rows), strict=True):
        run.turn(role, text, f in ("blank", "duplicate"), f == "truncated")
    return run.end()


def conversation(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", " ", "sue"]
    return [(rng.choice(roles), rng.choice(["a.", "b!", "a.", "cut", "", " \n", "long one?", "é"])) for _ in range(n)]


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_equals_all_edit_sequences(n):
    rng = random.Random(n)
    for _ in range(60 if n < 3 else 25):
        rows = conversation(rng, n)
        assert stream(rows) == brute(rows) == plain(rows), rows


def test_equals_whole_strings_on_long_conversations():
    rng = random.Random(9)
    for n in (10, 40, 200, 700):
        for _ in range(6):
            rows = [(r, f"{t}{rng.random() if rng.random() < 0.9 else ''}{t[-1:]}") for r, t in conversation(rng, n)]
            assert stream(rows) == plain(rows)


def test_ties_are_decided_far_back():
    """Runs of one role: many audits of one cost, which differ only at their beginning."""
    for rows in ([("user", f"{i}.") for i in range(300)], [("assistant", f"{i}.") for i in range(301)], [("system", f"{i}.") for i in range(50)],
                 [("tool", f"{i}") for i in range(120)], [("user", "x.")] * 500):
        assert stream(rows) == plain(rows)


def test_settled_prefixes(monkeypatch):
    monkeypatch.setattr(R, "SETTLE", 8)
    rng = random.Random(12)
    for _ in range(10):
        rows = [(r, f"{t}{i}{t[-1:]}") for i, (r, t) in enumerate(conversation(rng, 150))]
        run = R.Repair()
        for (role, text), f in zip(rows, faults(rows), strict=True):
            run.turn(role, text, f in ("blank", "duplicate"), f == "truncated")
        assert run.end() == plain(rows)
    rows = [("user" if i % 2 == 0 else "assistant", f"{i}.") for i in range(5000)]
    run = R.Repair()
    for role, text in rows:
        run.turn(role, text, False, False)
    assert run.settled and max(s.node.depth for s in run.states.values()) < 200 and run.end()[1] == "K" * 5000


def test_colliding_hashes_are_verified(monkeypatch):
    """With a modulus of 3 most hashes are equal; every comparison still holds."""
    monkeypatch.setattr(R, "PRIME", 3)
    rng = random.Random(1)
    made = []
    for _ in range(60):
        node = R.Node()
        for c in (rng.choice("DIKR") for _ in range(rng.randint(1, 12))):
            node = R.Node(c, node)
        made.append(node)
    assert all(R.less(a, b) == (a.letters() < b.letters()) for a in made for b in made)
    for _ in range(20):
        rows = conversation(rng, 30)
        assert stream(rows) == plain(rows)


def test_lifting():
    node = R.Node()
    for i in range(1000):
        node = R.Node("KD"[i % 2], node)
    assert all(node.at(d).depth == d for d in range(1001)) and len(node.up) <= 10 and node.letters() == "KD" * 500


@pytest.fixture(scope="module")
def table(spark):
    rng = random.Random(5)
    rows = [(c, t, r, x) for c in range(40) for t, (r, x) in enumerate(conversation(rng, rng.randint(1, 9)))]
    rows += [(50, None, "user", "a."), (50, None, "assistant", None), (50, 3, None, "b."), (None, 1, "user", "hi."), (None, None, None, None),
             (51, 7, "user", "q?"), (51, 7, "user", "q?"), (51, 7, "assistant", "a."), (52, 1, "user", "w " * 20000), (52, -4, "assistant", "漢🎉"), (53, 0, "tool", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").select("*", *(F.lit(1).alias(c) for c in ("id", "nth", "cost", "last", "kind")))
    return rows, df.repartition(5)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))


def summary(rows):
    """The figures of one conversation by definition."""
    rows = order([(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows])
    turns = [t for t, _, _ in rows if t is not None]
    said = [(r, x) for _, r, x in rows]
    f = faults(said)
    illegal = sum((a[0][:1] + b[0][:1]) not in ("su", "ua", "au") for a, b in zip(said, said[1:], strict=False))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(f.count(k) for k in ("blank", "duplicate", "truncated")), illegal, *plain(said))


def test_tables(spark, table, none):
    rows, df = table
    got = {r["conv_id"]: tuple(r)[1:] for r in R.repair(df).collect()}
    want = {c: summary([(t, r, x) for k, t, r, x in rows if k == c]) for c in {r[0] for r in rows}}
    assert got == want
    lost = {r["conv_id"]: tuple(r)[1:] for r in R.repair(df, gone=F.expr("conv_id < 5 OR turn = 7")).collect()}
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert lost.keys() == want.keys() and all(lost[c] == (empty if c in (0, 1, 2, 3, 4, 51) else summary([(t, r, x) for k, t, r, x in rows if k == c and t != 7]))
                                              for c in want)
    assert R.repair(df.limit(0)).collect() == [] and R.repaired_turns(df.limit(0), R.repair(df.limit(0))).collect() == []


def test_repaired_turns_have_the_digest(spark, table):
    _, df = table
    for gone in (None, F.expr("turn = 2")):
        audits = R.repair(df, gone=gone)
        said: dict = {r["conv_id"]: [] for r in audits.collect()}
        for r in sorted(R.repaired_turns(df, audits, gone=gone).collect(), key=lambda r: (str(r["conv_id"]), r["place"])):
            said[r["conv_id"]].append(r)
        for r in audits.collect():
            turns = said[r["conv_id"]]
            assert [t["place"] for t in turns] == list(range(1, len(turns) + 1))
            assert "".join(t["edit"] for t in turns) == r["audit"].replace("D", "")
            assert FULL.fullmatch("".join(t["role"][:1] for t in turns))
            assert hashlib.sha256("\n".join(f"{t['role']}:{t['text']}" for t in turns).encode()).hexdigest() == r["repaired_sha256"]


def test_damage(spark, table):
    import zlib

    rows, df = table
    want = []
    for c, t, r, x in rows:
        told = [" " if v is None else str(v) for v in (c, t, r, x)]
        h = zlib.crc32(f"{told[0]}:{told[1]}".encode()) % 20
        text = "" if h == 1 else re.sub("[.!?]", "", told[3]) if h == 2 else told[3]
        want += [(c, t, "user" if h == 4 else told[2], text, h == 0)] * (2 if h == 3 else 1)
    assert sorted(map(str, (tuple(r) for r in R.damage(df).collect()))) == sorted(map(str, want))
