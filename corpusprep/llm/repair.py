"""Conversation structure repair: the cheapest edits that give turns of the form (system? (user assistant)+)?.

A dynamic program walks over the turns of a conversation with four states (nothing yet, after the system turn, after
a user, after an assistant). Per state it keeps the cheapest edits so far, and of equally cheap ones those whose
audit, the string of their initials, is least. Audits are persistent: a node is one more edit behind a shared prefix,
with its ancestors at all powers of two and a rolling hash of the whole prefix. Two audits are compared by searching
their longest common prefix over the hashes, from the greatest power down; that the prefixes are equal, and not only
their hashes, is then verified on the nodes. Audits that reach one state after the same turn at the same cost never
begin with each other, so the least one stays least whatever follows.

Each state also carries a SHA-256 of its repaired turns, copied and fed as the state is, so texts are used as they
stream by and never kept. States that cannot lead to the cheapest edits any more are dropped, and nodes below the last
common ancestor of the others are written out from time to time: a task holds the undecided part and one letter per
decided edit.

Plan: one shuffle by conversation. Earlier copies of a turn are found by a window over (conversation, role, text) in
that same partitioning; a second sort puts turns in order, and a stream follows. Both sorts spill. The digest of a
conversation is one sequential hash over all of it, so its turns pass through one task, but only pass: nothing
is collected, and the work is linear in the turns.

Defined cases: a null role or text is one space; null turns come first; turns of equal number go by role and
text; repeated rows are duplicates; a null key is a conversation like others; a conversation without rows
(``gone``) has an empty audit; an empty table gives no rows; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, OPEN = 2, 5, 1, 5  # costs; OPEN: a truncated turn that stays
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}
NAME = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
PRIME, BASE = (1 << 61) - 1, 1_000_003
SETTLE = 4096


class Node:
    """An audit: the last edit and the shared audit before it."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, letter: str = "", before: Node | None = None):
        self.letter = letter
        if before is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * BASE + ord(letter)) % PRIME
        up, k = [before], 0
        while k < len(up[k].up):  # the ancestor 2^(k+1) up is 2^k above that 2^k up
            up.append(up[k].up[k])
            k += 1
        self.up = tuple(up)

    def at(self, depth: int) -> Node:
        """The ancestor of that depth."""
        node, k = self, 0
        rise = self.depth - depth
        while rise:
            if rise & 1:
                node = node.up[k]
            rise >>= 1
            k += 1
        return node

    def letters(self) -> str:
        out, node = [], self
        while node.depth:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def _same(a: Node, b: Node) -> bool:
    """Whether two audits of one length are equal, letter by letter up to a shared node."""
    while a is not b and a.depth:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(x: Node, y: Node) -> bool:
    """Whether the audit of ``x`` is less than that of ``y``."""
    depth = min(x.depth, y.depth)
    a, b = x.at(depth), y.at(depth)
    if a.hash == b.hash:
        if _same(a, b):
            return x.depth < y.depth
        return x.letters() < y.letters()  # equal hashes of different audits
    for k in reversed(range(len(a.up))):
        if k < len(a.up) and a.up[k].hash != b.up[k].hash:
            a, b = a.up[k], b.up[k]
    if _same(a.up[0], b.up[0]):
        return a.letter < b.letter
    return x.letters() < y.letters()


class State:
    __slots__ = ("cost", "node", "digest", "empty")

    def __init__(self, cost: int, node: Node, digest, empty: bool):
        self.cost, self.node, self.digest, self.empty = cost, node, digest, empty

    def beats(self, other: State | None) -> bool:
        return other is None or self.cost < other.cost or (self.cost == other.cost and less(self.node, other.node))

    def then(self, letter: str, cost: int) -> State:
        """With one more edit; the digest is still that of the state before."""
        return State(self.cost + cost, Node(letter, self.node), self.digest, self.empty)

    def said(self, role: str, text: str) -> None:
        """Append a turn to the repaired ones."""
        self.digest = self.digest.copy()
        self.digest.update((role + ":" + text if self.empty else "\n" + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.empty = False


class Repair:
    """The program over one conversation; ``turn`` for each turn in order, then ``end``."""

    def __init__(self):
        self.states: dict[int, State] = {START: State(0, Node(), hashlib.sha256(), True)}
        self.settled: list[str] = []
        self.limit = SETTLE
        self._insert()

    def _insert(self) -> None:
        """Inserted turns behind what is there; two in a row at most pay."""
        changed = True
        while changed:
            changed = False
            for at in (START, SYSTEM, ASSISTANT, USER):
                if at in self.states:
                    new = self.states[at].then("I", INSERT)
                    to = FOLLOWS[at]
                    if new.beats(self.states.get(to)):
                        new.said(NAME[to], "")
                        self.states[to] = new
                        changed = True
        # what follows the first two states can also follow an assistant, but that a system turn is deleted there
        limit = self.states[ASSISTANT].cost
        for at, more in ((START, DELETE), (SYSTEM, 0)):
            if at in self.states and self.states[at].cost > limit + more:
                del self.states[at]

    def turn(self, role: str, text: str, removed: bool, truncated: bool) -> None:
        best: dict[int, tuple[State, str | None]] = {}

        def offer(to: int, new: State, as_role: str | None) -> None:
            if to not in best or new.beats(best[to][0]):
                best[to] = new, as_role

        extra = OPEN if truncated else 0
        for at, state in self.states.items():
            offer(at, state.then("D", DELETE), None)
            if removed:
                continue
            to = FOLLOWS[at]
            if role[:1] == NAME[to][0]:
                offer(to, state.then("K", extra), role)
            elif at == START and role[:1] == "s":
                offer(SYSTEM, state.then("K", extra), role)
            offer(to, state.then("R", REROLE + extra), NAME[to])
        for new, as_role in best.values():
            if as_role is not None:
                new.said(as_role, text)
        self.states = {to: new for to, (new, _) in best.items()}
        self._insert()
        if max(s.node.depth for s in self.states.values()) > self.limit:
            self._settle()

    def _settle(self) -> None:
        """Write out the edits that all states share, and begin the audits behind them anew."""
        nodes = [s.node for s in self.states.values()]
        common = nodes[0]
        for node in nodes[1:]:
            depth = min(common.depth, node.depth)
            a, b = common.at(depth), node.at(depth)
            for k in reversed(range(len(a.up))):
                if k < len(a.up) and a.up[k] is not b.up[k]:
                    a, b = a.up[k], b.up[k]
            common = a if a is b else a.up[0]
        self.settled.append(common.letters())
        anew: dict[int, Node] = {id(common): Node()}
        for state in self.states.values():
            path, node = [], state.node
            while id(node) not in anew:
                path.append(node)
                node = node.up[0]
            for old in reversed(path):
                anew[id(old)] = Node(old.letter, anew[id(old.up[0])])
        for state in self.states.values():
            state.node = anew[id(state.node)]
        self.limit = SETTLE + 2 * max(s.node.depth for s in self.states.values())

    def end(self) -> tuple[int, str, str]:
        """(cost, audit, SHA-256 of the repaired turns)."""
        best = self.states[START] if START in self.states else None
        if best is None or self.states[ASSISTANT].beats(best):
            best = self.states[ASSISTANT]
        return best.cost, "".join(self.settled) + best.node.letters(), best.digest.hexdigest()


# ---- Spark ---------------------------------------------------------------------------------------------------

COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _ordered(df: DataFrame, key: str, turn: str, role: str, text: str, gone: Column) -> DataFrame:
    """``id, gone, turn, nth, role, text, last``, by conversation, in order. ``nth``: how often the role and text have
    come so far; ``last``: the last character that is no space."""
    rows = df.select(F.col(key).alias("id"), F.coalesce(gone, F.lit(False)).alias("gone"), F.col(turn).alias("turn"),
                     F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    rows = rows.withColumn("last", F.expr(f"right(rtrim('{SPACE}', text), 1)")).repartition("id")
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("id", "gone", "role", "text").orderBy("turn")))
    order = ["id", F.col("gone").desc(), F.col("turn").asc_nulls_first(), "role", "text", "nth"]
    return rows.select("id", "gone", "turn", "nth", "role", "text", "last").sortWithinPartitions(*order)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _conversations(schema: pa.Schema, write: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        current: list = []  # id, program, figures of the conversation at hand

        def ended() -> None:
            key, program, n, low, high, turns, _ = current
            cost, audit, digest = program.end()
            out.append((key, 0 if low is None else high - low + 1 - turns, n["blank"], n["duplicate"], n["truncated"], n["illegal"], cost, audit, digest))

        def flush() -> pa.RecordBatch:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for key, gone, turn, nth, role, text, last in _rows(batches):
            if not current or current[0] != key:
                if current:
                    ended()
                if len(out) >= write:
                    yield flush()
                current = [key, Repair(), dict.fromkeys(COLUMNS, 0), None, None, 0, None]
            if gone:
                continue
            if turn is not None:
                if turn != current[4]:
                    current[5] += 1
                if current[3] is None:
                    current[3] = turn
                current[4] = turn
            fault = "blank" if not last else "duplicate" if nth > 1 else "truncated" if last not in ".!?" else None
            if fault:
                current[2][fault] += 1
            if current[6] is not None and current[6] + role[:1] not in LEGAL:
                current[2]["illegal"] += 1
            current[6] = role[:1]
            current[1].turn(role, text, fault in ("blank", "duplicate"), fault == "truncated")
        if current:
            ended()
        if out:
            yield flush()

    return scan


def repair(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: Column | None = None) -> DataFrame:
    """One row per conversation: ``key``, gaps in the turn numbers, faulty turns by kind, illegal neighbours, the cost and
    audit of the cheapest edits, and the SHA-256 of the repaired turns. Rows where ``gone`` holds only name their conversation."""
    kind = df.schema[key].dataType.simpleString()
    none = F.lit(False) if gone is None else gone
    arrow = df.select(F.col(key).alias(key)).limit(0).toArrow().schema.field(0)
    schema = pa.schema([pa.field(key, arrow.type), *(pa.field(c, pa.int64()) for c in COLUMNS), pa.field("audit", pa.string()), pa.field("repaired_sha256", pa.string())])
    figures = ", ".join(f"{c} long" for c in COLUMNS)
    return _ordered(df, key, turn, role, text, none).mapInArrow(
        _conversations(schema, 10_000), f"`{key}` {kind}, {figures}, audit string, repaired_sha256 string")


def repaired_turns(df: DataFrame, audits: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", gone: Column | None = None) -> DataFrame:
    """The turns after the edits of ``audits`` (the result of ``repair``): ``key, place, edit, role, text``."""
    kind = df.schema[key].dataType.simpleString()
    rows = _ordered(df, key, turn, role, text, F.lit(False) if gone is None else gone)
    both = rows.select("id", F.lit(1).alias("kind"), "gone", "turn", "nth", "role", "text").unionByName(
        audits.select(F.col(key).alias("id"), F.lit(0).alias("kind"), F.lit(False).alias("gone"), F.lit(None).cast(df.schema[turn].dataType).alias("turn"),
                      F.lit(0).alias("nth"), F.lit("").alias("role"), F.col("audit").alias("text")))
    both = both.repartition("id").sortWithinPartitions("id", "kind", F.col("gone").desc(), F.col("turn").asc_nulls_first(), "role", "text", "nth")

    def edits(stream: Iterator[tuple]) -> Iterator[tuple]:
        key, audit, at, place, state = None, "", 0, 0, START

        def turn_as(role: str, text: str, letter: str) -> tuple:
            nonlocal place, state
            state = SYSTEM if state == START and letter == "K" and role[:1] == "s" else FOLLOWS[state]
            place += 1
            return key, place, letter, NAME[state] if letter != "K" else role, text

        def inserted() -> Iterator[tuple]:
            nonlocal at
            while at < len(audit) and audit[at] == "I":
                at += 1
                yield turn_as("", "", "I")

        for id_, is_row, gone_, _, _, role_, text_ in stream:
            if not is_row:
                yield from inserted()
                key, audit, at, place, state = id_, text_, 0, 0, START
            elif not gone_:
                yield from inserted()
                letter, at = audit[at], at + 1
                if letter != "D":
                    yield turn_as(role_, text_, letter)
        yield from inserted()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for row in edits(_rows(batches)):
            out.append(row)
            size += len(row[4])
            if size > 1 << 22 or len(out) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["id", "place", "edit", "role", "text"])
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names=["id", "place", "edit", "role", "text"])

    return both.mapInArrow(scan, f"id {kind}, place long, edit string, role string, text string").withColumnRenamed("id", key)


def damage(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", every: int = 20) -> DataFrame:
    """Rows damaged by the crc32 of ``<key>:<turn>`` modulo ``every`` (nulls: one space): 0 marks a row ``gone``, 1 empties
    its text, 2 takes away its sentence ends, 3 doubles it, 4 makes it the user's. ``key, turn, role, text, gone``."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = df.select(F.col(key).alias("id"), F.col(turn).alias("turn"), told(role).alias("role"), told(text).alias("text"),
                     (F.crc32(F.concat(told(key), F.lit(":"), told(turn)).cast("binary")) % every).alias("h"))
    hurt = rows.select(
        "id", "turn", F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        (F.col("h") == 0).alias("gone"), F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    return hurt.select(F.col("id").alias(key), F.col("turn").alias(turn), F.col("role").alias(role), F.col("text").alias(text), "gone")
