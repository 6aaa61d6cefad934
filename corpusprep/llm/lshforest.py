"""N-gram Jaccard self-join with a MinHash LSH forest.

Texts are sets of word 5-grams. Equal sets form a class and are worked on once. Every class gets a
MinHash signature, cut into ``trees`` sequences; each sequence is the path of the class in one prefix trie:

1. *Sorted tries.* A trie is the table of its paths in sorted order: (hash of the shortest prefix, the next values),
   so the classes that share a prefix of any of the ``depths`` are neighbours. Only prefixes that several classes share go on.
2. *Adaptive descent.* Two sets of similarity s share a prefix of length d in a tree with probability s^d, so a class that looks at
   prefixes of length d_t in tree t misses a partner at the threshold with probability prod(1 - s^d_t). Every class begins
   with the longest prefix in every tree and shortens them one by one, that with the fewest other classes below it first, until this
   probability is at most 1 - ``recall``. A class alone below its short prefixes shortens all of them, at no cost; one that stands in crowded
   branches (shared boilerplate) stays deep there and makes up for it in its other trees. So the lengths follow from the data,
   and the recall holds for each class whatever they are.
3. *Candidates.* In every tree a class meets all that share its chosen prefix: a range of the sorted trie, however long the prefixes
   that those chose. Signatures are compared, and classes whose estimate comes near the threshold are linked. Ranges
   only yield links to a first member, never pairs. Large ranges compare with leaders: a class
   close to a leader is covered by it, and every class is linked to all leaders within the reach that
   the triangle inequality of the Jaccard distance leaves for a partner of a covered class.
4. *Exact verification.* The linked classes form candidate components. The real 5-gram sets of each
   component are compared exactly in tiles of bounded size, which yield for each class the
   number of its links and one link per class to join the components - again no list of pairs.

Cost follows the number of classes and, in a component, the square of its *different* texts, which is
the number of links asked for. Copies cost nothing after the first step.

Defined cases: a text of one to four words has one gram, all of it; a null text or one without words has
no gram, is alike to nothing and forms a class of its own; rows that share a key count as rows; an empty
table gives no rows.
"""
from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.components import components
from corpusprep.llm.sortedgroups import bounds, groups
from corpusprep.llm.textbuf import BY_SPACE, U64, Words, mix, prefix_hash, runs, span_hash, text_bytes
from corpusprep.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class Forest:
    """``depths``: short, middle and long prefixes of a trie; ``slack``: how far below the threshold an estimate may lie;
    ``all_pairs``: largest range compared in full; ``cover``/``reach``: estimates for leaders; ``group_rows``: largest part of a
    short prefix's classes in a task; ``tile_rows``/``tile_grams``: bounds of an exact tile's side."""

    words: int = 5
    similarity: float = 0.8
    recall: float = 0.9999
    trees: int = 24
    depths: tuple[int, int, int] = (4, 5, 7)
    slack: float = 0.15
    all_pairs: int = 512
    cover: float = 0.85
    reach: float = 0.45
    group_rows: int = 4096
    tile_rows: int = 1000
    tile_grams: int = 1_000_000
    seed: int = 11

    def __post_init__(self):
        if not 0 < self.depths[0] < self.depths[1] < self.depths[2]:
            raise ValueError("depths must rise")
        if self.trees * self.evidence(self.depths[0]) < self.wanted:
            raise ValueError("more trees or shorter prefixes are needed for this recall")

    def evidence(self, depth: int) -> float:
        """What a tree adds to -ln(probability to miss a partner at the threshold) with prefixes of this length."""
        return -math.log1p(-self.similarity ** depth)

    @property
    def wanted(self) -> float:
        return -math.log1p(-self.recall)

    def permutations(self) -> np.ndarray:
        rng = np.random.default_rng(self.seed)
        return rng.integers(0, 1 << 32, (2, self.trees * self.depths[2]), dtype=np.uint32) | np.array([[1], [0]], np.uint32)

    def chosen(self, sizes: np.ndarray) -> np.ndarray:
        """Which of the three lengths each class takes in each tree (0: short).

        ``sizes``: classes x trees x (classes below the short prefix, below the middle one). A step to a shorter prefix costs the
        classes then met; steps are taken from the cheapest on until the recall is reached.
        """
        n = len(sizes)
        short, middle, long = (self.evidence(d) for d in self.depths)
        cost = sizes.reshape(n, -1).astype(np.int64) * 2  # of equal cost, the longer prefix first
        cost[:, 0::2] += 1
        gain = np.tile([short - middle, middle - long], self.trees)
        order = np.argsort(cost, axis=1, kind="stable")
        reached = self.trees * long + np.cumsum(gain[order], axis=1)
        before = np.concatenate((np.full((n, 1), self.trees * long), reached[:, :-1]), axis=1)
        free = np.take_along_axis(cost, order, axis=1) <= 3  # nobody else is there
        taken = np.zeros(cost.shape, bool)
        np.put_along_axis(taken, order, (before < self.wanted) | free, axis=1)
        return 2 - taken[:, 1::2].astype(np.int8) - taken[:, 0::2].astype(np.int8)


def grams(texts: list[bytes], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of every text, text by text, and where each text's begin."""
    w = Words(texts, BY_SPACE)
    pre = prefix_hash(w.hashes())
    count = np.diff(w.first)
    at = np.arange(len(w.doc))
    ends = w.first[1:][w.doc] if len(at) else at
    start = at[(at + n <= ends) | ((at == w.first[w.doc]) & (count[w.doc] < n))] if len(at) else at
    doc = w.doc[start]
    key = span_hash(pre, start, np.minimum(start + n, ends[start]))
    order = np.lexsort((key, doc)) if len(texts) < 2 else np.argsort((doc.astype(U64) << U64(44)) | (key >> U64(20)), kind="stable")
    key, doc = key[order], doc[order]
    # texts are contiguous now; equal grams of a text are neighbours but for a shared 44-bit prefix, which a second look mends
    same = np.zeros(len(key), bool)
    same[1:] = (key[1:] >> U64(20) == key[:-1] >> U64(20)) & (doc[1:] == doc[:-1])
    if same.any():
        run = np.flatnonzero(same)
        exact = (key[run] == key[run - 1])
        if not exact.all():
            order = np.lexsort((key, doc))
            key, doc = key[order], doc[order]
            same[1:] = (key[1:] == key[:-1]) & (doc[1:] == doc[:-1])
    key, doc = key[~same], doc[~same]
    return key, np.searchsorted(doc, np.arange(len(texts) + 1))


def sketch(key: np.ndarray, first: np.ndarray, forest: Forest, perms: np.ndarray) -> tuple[np.ndarray, ...]:
    """(set hash, signature, short prefixes, next values) of every text that has grams; rows follow those texts.

    A path's next values are two halves of a number: a hash up to the middle prefix, then one of the rest.
    """
    full = np.flatnonzero(np.diff(first))
    at = first[full]
    h = (key >> U64(32)).astype(np.uint32)
    low = np.empty((perms.shape[1], len(full)), np.uint32)
    for p in range(perms.shape[1]):
        v = h * perms[0, p]
        v += perms[1, p]
        v ^= v >> np.uint32(15)
        v *= np.uint32(0x2C1B3C6D)
        low[p] = np.minimum.reduceat(v, at)
    sets = mix(np.add.reduceat(mix(key), at) + (np.diff(first)[full]).astype(U64) * U64(0x9E3779B97F4A7C15))
    labels, tails = np.empty((len(full), forest.trees), U64), np.empty((len(full), forest.trees), U64)
    short, middle, long = forest.depths

    def hashed(x: np.ndarray, values: np.ndarray) -> np.ndarray:
        for row in values:
            x = mix(x * U64(0xC2B2AE3D27D4EB4F) + row)
        return x

    for t in range(forest.trees):
        path, start = low[t * long: (t + 1) * long], np.full(len(full), t + 1, U64)
        labels[:, t] = hashed(start, path[:short])
        tails[:, t] = ((hashed(start, path[short:middle]) >> U64(32)) << U64(32)) | (hashed(start, path[middle:]) >> U64(32))
    return sets, low.T.astype(np.uint16), labels, tails


def _sketches(forest: Forest):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        perms = forest.permutations()
        lists = lambda x: pa.FixedSizeListArray.from_arrays(pa.array(x.view(np.int64).ravel()), forest.trees).cast(pa.list_(pa.int64()))
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = text_bytes(batch.column(2))
                for a, b in runs(texts, 1 << 18):
                    key, first = grams(texts[a:b], forest.words)
                    n = np.diff(first)
                    full = np.flatnonzero(n)
                    if not len(full):
                        continue
                    sets, signature, labels, tails = sketch(key, first, forest, perms)
                    take = pa.array(full + a)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(take), batch.column(1).take(take), pa.array(sets.view(np.int64)), pa.array(n[full]),
                         pa.array([s.tobytes() for s in signature], pa.binary()), lists(labels), lists(tails)],
                        names=["doc", "row", "class", "n", "signature", "labels", "tails"])

    return scan


def _descend(forest: Forest):
    """Rows ``class, paths`` (tree, label, tail, parts, sizes of the shared prefixes) -> the same paths with the chosen length."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(1)
            n = np.asarray(paths.value_lengths())
            row = np.repeat(np.arange(len(n)), n)
            flat = paths.flatten()
            tree, short, middle = (flat.field(k).to_numpy(zero_copy_only=False) for k in ("tree", "short", "middle"))
            for lo in range(0, len(n), 4096):
                own = np.flatnonzero((row >= lo) & (row < lo + 4096))
                sizes = np.ones((min(4096, len(n) - lo), forest.trees, 2), np.int64)
                sizes[row[own] - lo, tree[own], 0] = short[own]
                sizes[row[own] - lo, tree[own], 1] = middle[own]
                level = forest.chosen(sizes)[row[own] - lo, tree[own]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row[own])), *(flat.field(k).take(pa.array(own)) for k in ("label", "tail", "parts")),
                     pa.array(level.astype(np.int32))], names=["class", "label", "tail", "parts", "level"])

    return scan


def _link(signature: np.ndarray, asks: np.ndarray, forest: Forest) -> np.ndarray:
    """The first member each member of a range is linked with, directly or by way of others; ``asks``: whose partners are sought."""
    root = np.arange(len(signature))
    if len(signature) <= forest.all_pairs:
        for i in np.flatnonzero(asks).tolist():
            near = np.flatnonzero((signature == signature[i]).mean(axis=1) >= forest.similarity - forest.slack)
            if len(near) > 1:
                _join(root, near)
        return root
    open_ = asks.copy()
    while open_.any():
        i = int(np.argmax(open_))
        alike = (signature == signature[i]).mean(axis=1)
        _join(root, np.flatnonzero(alike >= forest.reach))
        open_ &= alike < forest.cover
        open_[i] = False
    return root


def _ranges(label: np.ndarray, tail: np.ndarray, level: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length of prefix: its number, begins and ends of the ranges of a sorted trie where some class asks with that length."""
    fresh = np.append(True, label[1:] != label[:-1])
    for number in range(3):
        if number:
            shift = U64(64 - 32 * number)
            fresh[1:] |= (tail[1:] >> shift) != (tail[:-1] >> shift)
        at = np.append(np.flatnonzero(fresh), len(label))
        some = np.logical_or.reduceat(level == number, at[:-1]) & (np.diff(at) > 1)
        yield number, at[:-1][some], at[1:][some]


def _candidates(forest: Forest):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            label, tail, nodes, level = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
            signature = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint16).reshape(len(nodes), -1)
            a, b = [], []
            for number, begin, end in _ranges(label, tail.view(U64), level):
                two = begin[end - begin == 2]
                good = (signature[two] == signature[two + 1]).mean(axis=1) >= forest.similarity - forest.slack
                a.append(np.maximum(nodes[two[good]], nodes[two[good] + 1]))
                b.append(np.minimum(nodes[two[good]], nodes[two[good] + 1]))
                more = end - begin > 2
                for lo, hi in zip(begin[more].tolist(), end[more].tolist(), strict=True):
                    own = lo + np.argsort(nodes[lo:hi])  # links go to the smallest member, so those of all trees are much the same
                    root = _link(signature[own], level[own] == number, forest)
                    moved = np.flatnonzero(root != np.arange(hi - lo))
                    a.append(nodes[own[moved]])
                    b.append(nodes[own[root[moved]]])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    return scan


def exact_links(left: list[np.ndarray], right: list[np.ndarray] | None, similarity: float) -> Iterator[tuple[int, np.ndarray]]:
    """(i, places in ``right`` similar to left[i]); with ``right`` None, ``left`` against itself (each pair from both sides)."""
    other = left if right is None else right
    if len(left) * len(other) <= 64:
        for i, x in enumerate(left):
            hits = []
            for j, y in enumerate(other):
                if (right is not None or i != j) and min(len(x), len(y)) >= similarity * max(len(x), len(y)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both >= similarity * (len(x) + len(y) - both) - 1e-9:
                        hits.append(j)
            yield i, np.array(hits, np.int64)
        return
    every = left if right is None else left + right
    flat = np.concatenate(every)
    _, gram, df = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(every)), [len(x) for x in every])
    shared = df[gram] > 1
    gram, owner = gram[shared], owner[shared]
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], owner[order]
    new = np.cumsum(np.append(True, gram[1:] != gram[:-1])) - 1 if len(gram) else gram
    n, width = len(left), 4096
    both = np.zeros((n, len(other)), np.float32)
    edge = np.searchsorted(new, np.arange(0, (int(new[-1]) + 1 if len(new) else 0) + width, width))
    for k, (lo, hi) in enumerate(zip(edge[:-1], edge[1:], strict=True)):
        if lo < hi:
            x = np.zeros((len(every), width), np.float32)
            x[owner[lo:hi], new[lo:hi] - k * width] = 1
            both += x[:n] @ (x[:n] if right is None else x[n:]).T
    size = np.array([len(x) for x in other], np.float64)
    for i, x in enumerate(left):
        good = both[i] >= similarity * (len(x) + size - both[i]) - 1e-9
        if right is None:
            good[i] = False
        yield i, np.flatnonzero(good)


def _join(root: np.ndarray, members: np.ndarray) -> None:
    """All members, and what they are joined with, get one root: the first."""
    roots = np.unique(root[members])
    if len(roots) > 1:
        root[np.isin(root, roots[1:])] = roots[0]


def _tiles(similarity: float):
    """Rows ``tile, side, class, rows, grams`` sorted by tile -> ``class, links, other``: linked rows, and the first
    class it is linked with in this tile, by way of others too.

    Side 2 is compared with itself, side 0 with side 1.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in groups(batches):
            tile = batch.column(0).to_numpy(zero_copy_only=False)
            side = batch.column(1).to_numpy(zero_copy_only=False)
            nodes = batch.column(2).to_numpy(zero_copy_only=False)
            rows = batch.column(3).to_numpy(zero_copy_only=False)
            sets = [np.frombuffer(x, U64) for x in batch.column(4).to_pylist()]
            at, links = bounds(tile), np.zeros(len(nodes), np.int64)
            first = np.arange(len(nodes))
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                zero, one, own = (lo + np.flatnonzero(side[lo:hi] == k) for k in range(3))
                root = first[lo:hi]
                if len(zero) and len(one):
                    for i, hits in exact_links([sets[k] for k in zero], [sets[k] for k in one], similarity):
                        links[zero[i]] += rows[one[hits]].sum()
                        links[one[hits]] += rows[zero[i]]
                        _join(root, np.append(one[hits], zero[i]) - lo)
                for i, hits in exact_links([sets[k] for k in own], None, similarity) if len(own) else ():
                    links[own[i]] += rows[own[hits]].sum()
                    _join(root, np.append(own[hits], own[i]) - lo)
            some = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays([pa.array(nodes[some]), pa.array(links[some]), pa.array(nodes[first[some]])],
                                             names=["class", "links", "other"])

    return scan


def _grams(words: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                texts = text_bytes(batch.column(batch.num_columns - 1))
                for a, b in runs(texts):
                    key, first = grams(texts[a:b], words)
                    sets = [key[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns[:-1], pa.array(sets, pa.binary())],
                                                     names=[*batch.schema.names[:-1], "grams"])

    return scan


def _linked(df: DataFrame, key: str, text: str, forest: Forest) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows ``doc, row, class``; classes ``class, doc, row, rows``; links ``class, links, other``)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    kind = df.schema[key].dataType.simpleString()
    plain = df.select(F.col(key).alias("doc"), F.xxhash64(df[key], df[text]).alias("row"), F.col(text).alias("text"))
    sketched = plain.mapInArrow(_sketches(forest), f"doc {kind}, row long, class long, n long, signature binary, labels array<long>, tails array<long>").checkpoint()
    rows = sketched.select("doc", "row", "class")
    own = F.min(F.struct("doc", "row"))
    classes = sketched.groupBy("class").agg(own.alias("own"), F.count(F.lit(1)).alias("rows"), F.max("n").alias("n")).select(
        "class", "own.doc", "own.row", "rows", "n")
    first = sketched.groupBy("class").agg(F.any_value(F.struct("labels", "tails")).alias("trie")).select("class", F.arrays_zip("trie.labels", "trie.tails").alias("paths"))
    paths = first.select("class", F.posexplode("paths").alias("tree", "path")).select("class", "tree", F.col("path.labels").alias("label"), F.col("path.tails").alias("tail"))
    middle = F.shiftrightunsigned("tail", 32)
    shared = paths.groupBy("label").agg(F.count(F.lit(1)).alias("short"), F.min(middle).alias("lo"), F.max(middle).alias("hi")).where("short > 1")
    paths = paths.join(shared, "label").withColumn("parts", F.ceil(F.col("short") / forest.group_rows).cast("int"))
    even = (F.col("short") == 2) | (F.col("lo") == F.col("hi"))  # two classes, or one middle prefix: nothing to count
    same = paths.where(even).withColumn("middle", F.when(F.col("lo") == F.col("hi"), F.col("short")).otherwise(1))
    mixed = paths.where(~even).withColumn("mid", middle)
    mixed = mixed.join(mixed.groupBy("label", "mid").agg(F.count(F.lit(1)).alias("middle")), ["label", "mid"]).select(same.columns)
    paths = same.union(mixed)
    sized = paths.groupBy("class").agg(F.collect_list(F.struct(
        "tree", "label", "tail", "parts", "short", "middle")).alias("paths"))
    members = sized.mapInArrow(_descend(forest), "class long, label long, tail long, parts int, level int")
    part = F.pmod(F.xxhash64(F.lit(5), "class"), F.col("parts")).cast("int")  # a large group is dealt out as pairs of its parts
    members = (members.withColumn("part", part).withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
               .select("class", "tail", "level", F.when(F.col("parts") == 1, F.col("label")).otherwise(
                   F.xxhash64("label", F.least("part", "mate"), F.greatest("part", "mate"))).alias("label")))
    signed = members.join(sketched.select("class", "signature").groupBy("class").agg(F.any_value("signature").alias("signature")), "class")
    near = (signed.select("label", "tail", "class", "level", "signature").repartition("label").sortWithinPartitions("label", "tail", "class")
            .mapInArrow(_candidates(forest), "a long, b long").distinct())
    linked = components(near)
    # exact verification inside the candidate components
    classes = classes.checkpoint()
    parts = linked.join(classes, linked["node"] == classes["class"]).select("class", "row", "rows", "n", "root")
    width = parts.groupBy("root").agg(F.greatest(F.ceil(F.count(F.lit(1)) / forest.tile_rows), F.ceil(F.sum("n") / forest.tile_grams)).cast("int").alias("sides"))
    parts = parts.join(width, "root")
    texts = plain.select("row", "text").join(parts, "row").dropDuplicates(["row"])
    sets = texts.select("root", "class", "rows", "sides", "text").mapInArrow(_grams(forest.words), "root long, class long, rows long, sides int, grams binary")
    block = F.pmod(F.xxhash64(F.lit(7), "class"), F.col("sides")).cast("int")
    tiled = (sets.withColumn("block", block).withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
             .select(F.xxhash64("root", F.least("block", "mate"), F.greatest("block", "mate")).alias("tile"),
                     F.when(F.col("block") == F.col("mate"), 2).otherwise((F.col("block") > F.col("mate")).cast("int")).alias("side"), "class", "rows", "grams"))
    links = (tiled.repartition("tile").sortWithinPartitions("tile")
             .mapInArrow(_tiles(forest.similarity), "class long, links long, other long").checkpoint())
    return rows, classes, links


def join(df: DataFrame, key: str = "doc_id", text: str = "text", forest: Forest | None = None) -> DataFrame:
    """One row per input row: ``key``, ``class_id`` (the smallest key of all texts linked with it, by way of others
    too) and ``n_links``, the number of other rows of at least the similarity."""
    forest = forest or Forest()
    rows, classes, links = _linked(df, key, text, forest)
    found = _grouped(classes, links)
    out = rows.join(found, "class").select(F.col("doc").alias(key), "class_id", "n_links")
    alone = df.where(~F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    return out.union(alone.select(key, F.col(key).alias("class_id"), F.lit(0).cast("long").alias("n_links")))


def _grouped(classes: DataFrame, links: DataFrame) -> DataFrame:
    """``class, class_id, class_row, n_links``."""
    n = links.groupBy("class").agg(F.sum("links").alias("links"))
    root = components(links.select(F.col("class").alias("a"), F.col("other").alias("b")))
    tied = (classes.join(n, "class", "left").join(root.withColumnRenamed("node", "class"), "class", "left")
            .withColumn("root", F.coalesce("root", "class")))
    heads = tied.groupBy("root").agg(F.min(F.struct("doc", "row")).alias("head"))
    return tied.join(heads, "root").select("class", F.col("head.doc").alias("class_id"), F.col("head.row").alias("class_row"),
                                           (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))


def deduplicate(df: DataFrame, key: str = "doc_id", text: str = "text", forest: Forest | None = None) -> DataFrame:
    """``df``, all its columns, with one row of each group of linked texts: that with the smallest key."""
    forest = forest or Forest()
    _, classes, links = _linked(df, key, text, forest)
    kept = _grouped(classes, links).select(F.col("class_row").alias("kept_row")).distinct()
    names = df.columns
    plain = df.withColumn("__row", F.xxhash64(df[key], df[text])).toDF(*(f"c{i}" for i in range(len(names))), "own_row")
    some = F.coalesce(F.col(f"c{names.index(text)}").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    chosen = plain.where(some).join(kept, plain["own_row"] == kept["kept_row"], "left_semi").dropDuplicates(["own_row"])
    return chosen.union(plain.where(~some)).drop("own_row").toDF(*names)
