"""Decision trees and forests on exact cuts, grown until every leaf is pure.

No bins and no depth limit: a cut may lie between any two neighbouring distinct values. Nodes of more than ``local_rows`` rows
are split by Spark, one level of all trees at a time; smaller ones are grown to the end in one task each.

**Large nodes.** A pass over the written rows deals, for each attribute that an open node tries, the rows' values into quantile buckets; a
value travels once for all trees, with its label and a small number a tree for its node and weight. What many rows of a batch repeat is
summed by (value, tree, node) where it is read, so a value that a third of the rows has is a few numbers a batch. Each bucket is sorted in a task of its
own: first it answers with each node's row and class counts and lowest value, then, told what lies below it, with the bucket's best cut of each node. The
driver holds a few numbers a (node, attribute, bucket), of at most about ``ENTRIES`` of them at once; rows are never rewritten.

**Small nodes.** Rows go to the task of their (tree, node), at most ``local_rows`` each, where NumPy cuts all nodes of a level at once. The
packed subtree is one row of the model's table, so a model may be larger than any one machine. Scoring broadcasts the
subtrees up to ``BROADCAST`` bytes; beyond that chunks of rows meet groups of subtrees in a cogroup, each answering by one sum a row.

**Forests.** Each tree weights each row by a Poisson(1) draw from the hash of (row key, tree, seed) (Oza & Russell 2001), and looks for each node's cut among
``subset`` attributes ranked by the hash of (seed, tree, node); where none of them can cut, the others follow. Weights, attributes and class
counts are integers or hashes, so the same trees come out whatever the partitions and whatever ``local_rows``.

Cuts maximise the decrease of the Gini impurity. Of equally good cuts the one of the earliest attribute wins, then the lowest. Rows with equal
attributes and unlike labels stay together in a leaf with the share of label 1.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .sums import grouped_parts, matrix

LOCAL_ROWS = 1 << 19
#: Rows of a bucket of values, about, and buckets an attribute at most.
BUCKET_ROWS, BUCKETS = 1 << 15, 256
#: Rows of a batch beyond which their common value is summed where it is read.
HEAVY = 64
#: (node, attribute, bucket) of the open nodes that are cut in one pass.
ENTRIES = 1 << 18
#: Bytes of packed subtrees that are broadcast for scoring, and that meet a chunk of rows in one task beyond that.
BROADCAST = 1 << 25
#: Rows of a chunk, about.
CHUNK = 1 << 18
LEAF, OPEN, SMALL = 0, 1, 2


def mix(x: np.ndarray) -> np.ndarray:
    """A hash of each 64-bit number (the finaliser of SplitMix64, Steele et al. 2014)."""
    x = np.asarray(x, dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(*parts: int) -> int:
    h = np.zeros(1, dtype=np.uint64)
    for p in parts:
        h = mix(h ^ np.uint64(p & 0xFFFFFFFFFFFFFFFF))
    return int(h[0])


#: Poisson(1): the draw is the number of these bounds that a uniform number reaches.
_POISSON = np.cumsum([np.exp(-1.0) / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880)])


def bootstrap(rid: np.ndarray, tree: int, seed: int) -> np.ndarray:
    u = (mix(rid.astype(np.uint64) ^ np.uint64(seeded(seed, tree))) >> np.uint64(11)) / 2.0**53
    return np.searchsorted(_POISSON, u, side="right").astype(np.float64)


def ranked(dim: int, subset: int, seed: int, tree: int, path: int) -> np.ndarray:
    """Attributes in the order in which a node tries them; all of them, in their own order, without a subset."""
    if subset >= dim:
        return np.arange(dim)
    return np.argsort(mix(np.arange(dim).astype(np.uint64) ^ np.uint64(seeded(seed + 1, tree, path))), kind="stable")


def child_path(path: int, right: int) -> int:
    return seeded(path, right)


@dataclass
class Nodes:
    """Arrays of a tree: ``feature`` -1 and ``value`` (share of label 1) at a leaf; else rows with ``x <= threshold`` go left."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def walk(self, x: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while True:
            f = self.feature[node]
            inner = f >= 0
            if not inner.any():
                return node
            goes = x[rows, np.maximum(f, 0)] <= self.threshold[node]
            node = np.where(inner, np.where(goes, self.left[node], self.right[node]), node)

    def packed(self) -> bytes:
        return np.column_stack([self.feature, self.threshold, self.left, self.right, self.value]).astype(np.float64).tobytes()

    @classmethod
    def unpacked(cls, data: bytes) -> Nodes:
        a = np.frombuffer(data, dtype=np.float64).reshape(-1, 5)
        whole = lambda k: a[:, k].astype(np.int64)
        return cls(whole(0), a[:, 1], whole(2), whole(3), a[:, 4])


def middle(a, b):
    """The cut between neighbouring values a < b."""
    m = a + (b - a) / 2.0
    return np.where(m < b, m, a)


def _ranked_all(dim: int, subset: int, seed: int, tree: int, paths: np.ndarray) -> np.ndarray:
    """``ranked`` of every path, a row each."""
    if subset >= dim:
        return np.tile(np.arange(dim), (len(paths), 1))
    at = mix(np.uint64(seeded(seed + 1, tree)) ^ paths)
    return np.argsort(mix(np.arange(dim).astype(np.uint64)[None] ^ at[:, None]), axis=1, kind="stable")


#: Bits of a row's weight (a Poisson draw is at most the number of its bounds) and label in a sort key.
_LABELLED = len(_POISSON).bit_length() + 1


@dataclass
class Ranks:
    """Attributes as ranks of their distinct values, so that a node's values sort as whole numbers that carry weight and label."""

    rank: np.ndarray  # (rows, columns)
    values: np.ndarray  # distinct values, column after column
    begin: np.ndarray
    bits: int

    @classmethod
    def of(cls, x: np.ndarray) -> Ranks:
        rank, values = np.empty(x.shape, dtype=np.int32), []
        for f in range(x.shape[1]):
            distinct, inverse = np.unique(x[:, f], return_inverse=True)
            rank[:, f] = inverse
            values.append(distinct)
        begin = np.cumsum([0, *map(len, values)])[:-1]
        return cls(rank, np.concatenate(values), begin, max(map(len, values)).bit_length())


def _cuts(x: Ranks, labelled: np.ndarray, rows: np.ndarray, first: np.ndarray, columns: np.ndarray):
    """For each node, whose ``rows`` begin at ``first`` (none is empty): (gain, column, threshold) of the best cut on its own
    ``columns``; the gain is -inf where none of them has two values. ``labelled``: 2 x weight + label of every row."""
    many = len(first)
    node = np.repeat(np.arange(many), np.diff(np.append(first, len(rows))))
    last = np.append(first[1:], len(rows)) - 1
    best, feature, threshold = np.full(many, -np.inf), np.full(many, -1), np.zeros(many)
    same = node[:-1] == node[1:]
    carried = (node << (x.bits + _LABELLED)) | labelled[rows]
    for j in range(columns.shape[1]):
        key = carried | (x.rank[rows, columns[node, j]].astype(np.int64) << _LABELLED)
        key.sort()  # nodes stay where they are
        w, rank = (key & ((1 << _LABELLED) - 1)) >> 1, key >> _LABELLED
        wt = w * (key & 1)
        n, p = np.cumsum(w), np.cumsum(wt)  # integers: exact
        n0, p0 = n[first] - w[first], p[first] - wt[first]
        i = np.flatnonzero((rank[:-1] != rank[1:]) & same)
        if not len(i):
            continue
        of = node[i]
        ln, lp = n[i] - n0[of], p[i] - p0[of]
        rn, rp = n[last][of] - n[i], p[last][of] - p[i]
        gain = lp * lp / ln + rp * rp / rn
        start = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        top = np.maximum.reduceat(gain, start)
        where = np.flatnonzero(gain == np.repeat(top, np.diff(np.append(start, len(i)))))
        where = where[np.append(True, of[where[1:]] != of[where[:-1]])]  # the lowest of equally good cuts
        better = top > best[of[start]]
        where, k = where[better], of[start][better]
        best[k], feature[k] = gain[where], columns[k, j]
        value = lambda at, k=k: x.values[x.begin[feature[k]] + (rank[at] & ((1 << x.bits) - 1))]
        threshold[k] = middle(value(i[where]), value(i[where] + 1))
    return best, feature, threshold


def grow(x: np.ndarray, t: np.ndarray, w: np.ndarray, subset: int, seed: int, tree: int, path: int) -> Nodes:
    """The whole tree over these rows, pure or uncuttable at every leaf: all nodes of a level together. Weights are small whole numbers."""
    dim, wt = x.shape[1], w * t
    ranks, labelled = Ranks.of(x), 2 * w.astype(np.int64) + t.astype(np.int64)
    levels: list[tuple[np.ndarray, ...]] = []
    rows, first, paths, size = np.arange(len(x)), np.zeros(1, dtype=np.int64), np.array([path], dtype=np.uint64), 1
    while len(first):
        many = len(first)
        n, p = np.add.reduceat(w[rows], first), np.add.reduceat(wt[rows], first)
        feature, threshold = np.full(many, -1), np.zeros(many)
        left, right = np.full(many, -1), np.full(many, -1)
        counts = np.diff(np.append(first, len(rows)))
        # rows of the nodes that are still looking for a cut, and where each node's begin
        asked = np.flatnonzero((p > 0) & (p < n))
        tried = _ranked_all(dim, subset, seed, tree, paths[asked])
        for k in range(0, dim, subset):
            if not len(asked):
                break
            here = np.zeros(many, dtype=bool)
            here[asked] = True
            begin = np.append(0, np.cumsum(counts[asked])[:-1])
            gain, f, cut = _cuts(ranks, labelled, rows[np.repeat(here, counts)], begin, np.sort(tried[:, k : k + subset], axis=1))
            found = gain > -np.inf
            feature[asked[found]], threshold[asked[found]] = f[found], cut[found]
            asked, tried = asked[~found], tried[~found]
        cutting = np.flatnonzero(feature >= 0)
        left[cutting] = size + 2 * np.arange(len(cutting))
        right[cutting] = left[cutting] + 1
        levels.append((feature, threshold, left, right, p / n))
        size += 2 * len(cutting)
        node = np.repeat(np.arange(many), counts)
        inner = feature[node] >= 0
        rows, node = rows[inner], node[inner]
        goes = x[rows, feature[node]] > threshold[node]
        child = left[node] + goes
        order = np.argsort(child, kind="stable")
        rows, child = rows[order], child[order]
        first = np.flatnonzero(np.append(True, child[1:] != child[:-1])) if len(rows) else np.zeros(0, dtype=np.int64)
        base = mix(paths[cutting])
        paths = np.column_stack([mix(base), mix(base ^ np.uint64(1))]).ravel()
    return Nodes(*(np.concatenate(a) for a in zip(*levels, strict=True)))


@dataclass
class Top:
    """The part of one tree that Spark split: nodes with a state, the path's hash and how many attributes were tried in vain."""

    feature: list[int]
    threshold: list[float]
    left: list[int]
    right: list[int]
    value: list[float]
    state: list[int]
    path: list[int]
    tried: list[int]

    @classmethod
    def root(cls, path: int, state: int) -> Top:
        return cls([-1], [0.0], [-1], [-1], [0.0], [state], [path], [0])

    def add(self, path: int, state: int, value: float) -> int:
        for a, v in zip(
            (self.feature, self.threshold, self.left, self.right, self.value, self.state, self.path, self.tried),
            (-1, 0.0, -1, -1, value, state, path, 0), strict=True,
        ):
            a.append(v)
        return len(self.feature) - 1

    def nodes(self) -> Nodes:
        return Nodes(*(np.array(a) for a in (self.feature, self.threshold, self.left, self.right, self.value)))


@dataclass
class Trees:
    """Fitted trees: their tops on the driver (a row a split of a large node), their subtrees in a table."""

    tops: list[Top]
    subtrees: DataFrame
    dim: int

    def probability(self, rows: DataFrame, keys: Sequence[str], features: Sequence[str]) -> DataFrame:
        """``keys`` and ``p1``, the mean share of label 1 over the trees; ``keys`` must be unique."""
        spark, dim = rows.sparkSession, self.dim
        tops = spark.sparkContext.broadcast([(t.nodes(), np.array(t.state)) for t in self.tops])
        asked = rows.select(*keys, F.array(*[F.col(c).cast("double") for c in features]).alias("_x"))
        key_fields = [asked.schema[k] for k in keys]
        size = self.subtrees.agg(F.sum(F.octet_length("nodes"))).first()[0] or 0
        if size <= BROADCAST:
            packed = {(r["tree"], r["node"]): bytes(r["nodes"]) for r in self.subtrees.collect()}
            sent = spark.sparkContext.broadcast(packed)

            def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                small = {k: Nodes.unpacked(v) for k, v in sent.value.items()}
                for b in batches:
                    x = matrix(b.column(len(keys)), dim)
                    total = np.zeros(len(x))
                    for k, (nodes, state) in enumerate(tops.value):
                        at = nodes.walk(x)
                        p = nodes.value[at]
                        for node in np.unique(at[state[at] == SMALL]).tolist():
                            mine = np.flatnonzero(at == node)
                            sub = small.get((k, node))  # none where no row was drawn for the tree
                            p[mine] = sub.value[sub.walk(x[mine])] if sub is not None else 0.0
                        total += p
                    yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(total / len(tops.value))], [*keys, "p1"])

            return asked.mapInArrow(whole, T.StructType([*key_fields, T.StructField("p1", T.DoubleType())]))

        # rows in chunks meet the subtrees in groups of about BROADCAST bytes: a row travels once a group, not once a tree
        sizes = self.subtrees.select("tree", "node", F.octet_length("nodes").alias("bytes")).orderBy("tree", "node").collect()  # one row a subtree
        ends = np.cumsum([r["bytes"] for r in sizes])
        numbers = np.unique((ends - 1) // max(1, BROADCAST), return_inverse=True)[1].tolist()
        groups = max(numbers) + 1
        member = spark.createDataFrame([(r["tree"], r["node"], g) for r, g in zip(sizes, numbers, strict=True)], "tree int, node int, group int")
        mine: list[list[tuple[int, int]]] = [[] for _ in range(groups)]
        for r, g in zip(sizes, numbers, strict=True):
            mine[g].append((r["tree"], r["node"]))
        mine_sent = spark.sparkContext.broadcast(mine)
        asked = materialize(asked, "tree-asked")
        chunks = max(1, -(-asked.count() // CHUNK))
        every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
        ask = asked.withColumn("chunk", F.pmod(F.xxhash64(*keys), F.lit(chunks)).cast("int")).withColumn("group", every(groups))
        have = self.subtrees.join(F.broadcast(member), ["tree", "node"]).withColumn("chunk", every(chunks))

        def answer(qs: pa.Table, subs: pa.Table) -> pa.Table:
            """The sum over the group's subtrees of what the rows that reach them get; the first group adds the leaves above all subtrees."""
            x = matrix(qs.column("_x").combine_chunks(), dim)
            total = np.zeros(len(x))
            if len(x):
                group = qs.column("group")[0].as_py()
                where = {k: i for i, k in enumerate(zip(subs.column("tree").to_pylist(), subs.column("node").to_pylist(), strict=True))}
                by_tree: dict[int, list[int]] = {}
                for k, node in mine_sent.value[group]:
                    by_tree.setdefault(k, []).append(node)
                for k, (nodes, state) in enumerate(tops.value):
                    if group and k not in by_tree:
                        continue
                    at = nodes.walk(x)
                    if not group:
                        total += np.where(state[at] == SMALL, 0.0, nodes.value[at])
                    for node in by_tree.get(k, ()):
                        rows = np.flatnonzero(at == node)
                        sub = Nodes.unpacked(subs.column("nodes")[where[k, node]].as_buffer())
                        total[rows] += sub.value[sub.walk(x[rows])]
            return pa.table([*(qs.column(k) for k in keys), pa.array(total)], [*keys, "p"])

        meet = ["group", "chunk"]
        found = ask.groupBy(*meet).cogroup(have.groupBy(*meet)).applyInArrow(answer, T.StructType([*key_fields, T.StructField("p", T.DoubleType())]))
        return found.groupBy(*keys).agg((F.sum("p") / F.lit(len(self.tops))).alias("p1"))


@dataclass
class Asked:
    """An open node and the attributes that it tries now, in their own order."""

    tree: int
    node: int
    columns: np.ndarray


def reached(top: Nodes, slots: dict[int, int], x: np.ndarray) -> np.ndarray:
    """The number in ``slots`` of the node that each row comes to, -1 elsewhere; ``x`` has a row an attribute."""
    leads = np.zeros(len(top.feature), dtype=bool)
    for i in range(len(leads) - 1, -1, -1):  # children stand behind their parents
        leads[i] = i in slots or (top.feature[i] >= 0 and (leads[top.left[i]] or leads[top.right[i]]))
    out = np.full(x.shape[1], -1)
    stack = [(0, np.arange(x.shape[1]))]
    while stack:
        node, rows = stack.pop()
        if node in slots:
            out[rows] = slots[node]
        elif leads[node]:
            goes = x[top.feature[node], rows] <= top.threshold[node]
            stack += [(child, rows[side]) for child, side in ((top.left[node], goes), (top.right[node], ~goes)) if leads[child]]
    return out


#: A weight's bits beside the number of its node.
_WEIGHT = len(_POISSON).bit_length()


def _by_bucket(f: int, bound: np.ndarray, v: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[tuple[int, int], tuple[np.ndarray, ...]]]:
    """((f, bucket), its part of ``columns``), for sorted values."""
    if not len(v):
        return
    bucket = np.searchsorted(bound, v, side="left")
    starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    for a, b in zip(starts, np.append(starts[1:], len(v)), strict=True):
        yield (f, int(bucket[a])), tuple(c[a:b] for c in columns)


def _sides(v: np.ndarray, y: np.ndarray, codes: np.ndarray, sums: np.ndarray, j: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(slot, distinct values, their row and class counts) of the j-th tree's nodes in a bucket."""
    mine, own = np.flatnonzero(codes[:, j]), sums[sums[:, 1] == j]
    code = codes[mine, j].astype(np.int64)
    w = code & ((1 << _WEIGHT) - 1)
    v, slot = np.append(v[mine], own[:, 0]), np.append(code >> _WEIGHT, own[:, 2].astype(np.int64))
    n, p = np.append(w, own[:, 3]), np.append(w * y[mine], own[:, 4])
    if len(own):
        order = np.argsort(v, kind="stable")
        v, slot, n, p = v[order], slot[order], n[order], p[order]
    for s in np.unique(slot).tolist():
        here = slot == s
        vs = v[here]
        first = np.flatnonzero(np.append(True, vs[1:] != vs[:-1]))
        yield s, vs[first], np.add.reduceat(n[here], first), np.add.reduceat(p[here], first)


def best_splits(rows: DataFrame, tops: list[Top], asked: list[Asked], dim: int, bounds: list[np.ndarray], weigh) -> list[dict]:
    """tree, node, n, p, and f, threshold, n and p of the left side (f is None without a cut) of each node asked for. ``rows``: rid, x, t."""
    slots: dict[int, dict[int, int]] = {}
    number: dict[tuple[int, int], int] = {}
    for i, a in enumerate(asked):
        at = slots.setdefault(a.tree, {})
        number[a.tree, len(at)] = i
        at[a.node] = len(at)
    most = max(map(len, slots.values()))
    kind = np.uint8 if most << _WEIGHT <= 1 << 8 else np.uint16 if most << _WEIGHT <= 1 << 16 else np.int64
    trying = {f: [] for f in range(dim)}  # (tree, whether the node of each slot tries the attribute)
    for k, at in slots.items():
        tries = np.array([[f in asked[number[k, s]].columns for s in range(len(at))] for f in range(dim)])
        for f in range(dim):
            if tries[f].any():
                trying[f].append((k, tries[f]))
    context = rows.sparkSession.sparkContext
    sent = context.broadcast(({k: (tops[k].nodes(), at) for k, at in slots.items()}, trying, bounds))

    def values(b: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], tuple[np.ndarray, ...]]]:
        plan, trying, bounds = sent.value
        rid, x = b.column(0).to_numpy(zero_copy_only=False), np.ascontiguousarray(matrix(b.column(1), dim).T)
        t, codes = b.column(2).to_numpy(zero_copy_only=False).astype(np.uint8), {}
        for k, (top, at) in plan.items():
            slot, w = reached(top, at, x), weigh(rid, k).astype(np.int64)
            codes[k] = np.where((slot >= 0) & (w > 0), (slot << _WEIGHT) | w, 0).astype(kind)
        for f, trees in trying.items():
            if not trees:
                continue
            code = np.column_stack([np.where(tries[codes[k] >> _WEIGHT], codes[k], 0).astype(kind) for k, tries in trees])
            order = np.flatnonzero(code.any(axis=1))
            order = order[np.argsort(x[f, order])]
            v, y, code = x[f, order], t[order], code[order]
            first = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, dtype=int)
            length = np.diff(np.append(first, len(v)))
            often = length > HEAVY
            heavy = np.repeat(often, length)
            if often.any():
                which, out = np.repeat(np.cumsum(often) - 1, length)[heavy], []
                for j in range(len(trees)):
                    c = code[heavy, j].astype(np.int64)
                    w = c & ((1 << _WEIGHT) - 1)
                    key, size = which * most + (c >> _WEIGHT), int(often.sum()) * most
                    n, p = np.bincount(key, w, size), np.bincount(key, w * y[heavy], size)
                    hit = np.flatnonzero(n)
                    out.append(np.column_stack([v[first[often]][hit // most], np.full(len(hit), j), hit % most, n[hit], p[hit]]))
                sums = np.concatenate(out)
                sums = sums[np.argsort(sums[:, 0], kind="stable")]
                yield from _by_bucket(f, bounds[f], sums[:, 0], sums)
            yield from _by_bucket(f, bounds[f], v[~heavy], v[~heavy], y[~heavy], code[~heavy])

    def together(at: tuple[int, int], parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        single, trees = [p for p in parts if len(p) == 3], len(trying[at[0]])
        v, y = (np.concatenate([np.zeros(0, dtype=d), *(p[i] for p in single)]) for i, d in ((0, np.float64), (1, np.uint8)))
        code = np.concatenate([np.zeros((0, trees), dtype=kind), *(p[2] for p in single)])
        order = np.argsort(v)
        return v[order], y[order], code[order], np.concatenate([np.zeros((0, 5)), *(p[0] for p in parts if len(p) == 1)])

    def nodes(f: int, data: tuple[np.ndarray, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        for j, (k, _) in enumerate(trying[f]):
            for s, v, n, p in _sides(*data, j):
                yield number[k, s], v, n, p

    def counted(x) -> bytes:
        (f, bucket), data = x
        return np.array([(i, f, bucket, n.sum(), p.sum(), v[0]) for i, v, n, p in nodes(f, data)], dtype=np.float64).tobytes()

    held = grouped_parts(rows, values).map(lambda x: (x[0], together(*x))).persist(StorageLevel.DISK_ONLY)
    try:
        seen = np.concatenate([np.zeros((0, 6)), *(np.frombuffer(c).reshape(-1, 6) for c in held.map(counted).collect())])
        width = max(map(len, bounds)) + 1
        many, tried = len(asked), max(len(a.columns) for a in asked)
        n, p, low = np.zeros((many, tried, width)), np.zeros((many, tried, width)), np.full((many, tried, width), np.inf)
        place = np.full((many, dim), -1)
        for i, a in enumerate(asked):
            place[i, a.columns] = np.arange(len(a.columns))
        at = seen[:, 0].astype(int), place[seen[:, 0].astype(int), seen[:, 1].astype(int)], seen[:, 2].astype(int)
        n[at], p[at], low[at] = seen[:, 3], seen[:, 4], seen[:, 5]
        none = np.full((many, tried, 1), np.inf)
        later = np.concatenate([np.minimum.accumulate(low[:, :, ::-1], axis=2)[:, :, ::-1][:, :, 1:], none], axis=2)
        total = n[:, 0].sum(axis=1), p[:, 0].sum(axis=1)
        known = context.broadcast((np.cumsum(n, axis=2) - n, np.cumsum(p, axis=2) - p, later, total, place))

        def best(x) -> bytes:
            (f, bucket), data = x
            n0, p0, later, (tn, tp), place = known.value
            out = []
            for i, v, n, p in nodes(f, data):
                j = place[i, f]
                ln, lp = n0[i, j, bucket] + np.cumsum(n), p0[i, j, bucket] + np.cumsum(p)
                rn, rp = tn[i] - ln, tp[i] - lp
                gain = np.where(rn > 0, lp * lp / ln + rp * rp / np.where(rn > 0, rn, 1.0), -np.inf)
                top = int(gain.argmax())  # the lowest of equally good cuts
                if gain[top] > -np.inf:
                    out.append((i, gain[top], f, v[top], v[top + 1] if top + 1 < len(v) else later[i, j, bucket], ln[top], lp[top]))
            return np.array(out, dtype=np.float64).tobytes()

        cuts = np.concatenate([np.zeros((0, 7)), *(np.frombuffer(c).reshape(-1, 7) for c in held.map(best).collect())])
    finally:
        held.unpersist()
    out = [{"tree": a.tree, "node": a.node, "n": float(total[0][i]), "p": float(total[1][i]), "f": None} for i, a in enumerate(asked)]
    for i, _, f, v, above, ln, lp in sorted(map(tuple, cuts), key=lambda c: (c[1], -c[2], -c[3])):  # the best comes last
        out[int(i)] |= {"f": int(f), "threshold": float(middle(v, above)), "ln": ln, "lp": lp}
    return out


def fit_trees(
    rows: DataFrame,
    dim: int,
    trees: int = 1,
    subset: int | None = None,
    resample: bool = False,
    seed: int = 1,
    local_rows: int = LOCAL_ROWS,
) -> Trees:
    """``rows``: ``rid`` long (a hash of the row's key), ``x`` array<double> of ``dim``, ``t`` in {0, 1}; a written table."""
    subset = dim if subset is None else max(1, min(dim, subset))
    spark = rows.sparkSession

    def weigh(rid: np.ndarray, tree: int) -> np.ndarray:
        return bootstrap(rid, tree, seed) if resample else np.ones(len(rid))

    n = rows.count()
    tops = [Top.root(seeded(7, k), OPEN if n > local_rows else SMALL) for k in range(trees)]
    if n > local_rows:
        # quantiles of the whole table: they only bound the buckets, any values give the same cuts
        share = [k / many for k in range(1, many)] if (many := min(BUCKETS, max(1, n // BUCKET_ROWS))) > 1 else []
        q = rows.agg(*[F.percentile_approx(F.col("x")[i], share, 1000).alias(str(i)) for i in range(dim)]).first() if share else [[]] * dim
        bounds = [np.unique(np.array(q[i], dtype=np.float64)) for i in range(dim)]
        table = rows.select("rid", "x", "t")
        while opened := [(k, node) for k, top in enumerate(tops) for node, state in enumerate(top.state) if state == OPEN]:
            some = opened[: max(1, ENTRIES // (subset * many))]
            asked = []
            for k, node in some:
                order, tried = ranked(dim, subset, seed, k, tops[k].path[node]), tops[k].tried[node]
                asked.append(Asked(k, node, np.sort(order[tried : tried + subset])))
            for r in best_splits(table, tops, asked, dim, bounds, weigh):
                top, node = tops[r["tree"]], r["node"]
                top.value[node] = r["p"] / max(1.0, r["n"])
                if r["p"] <= 0 or r["p"] >= r["n"]:
                    top.state[node] = LEAF
                elif r["f"] is None:
                    top.tried[node] += subset
                    top.state[node] = OPEN if top.tried[node] < dim else LEAF
                else:
                    sides = ((r["ln"], r["lp"]), (r["n"] - r["ln"], r["p"] - r["lp"]))
                    paths = (child_path(top.path[node], 0), child_path(top.path[node], 1))
                    kids = []
                    for (m, p), path in zip(sides, paths, strict=True):
                        state = LEAF if p <= 0 or p >= m else OPEN if m > local_rows else SMALL
                        kids.append(top.add(path, state, p / m))
                    top.feature[node], top.threshold[node], top.state[node] = int(r["f"]), float(r["threshold"]), LEAF
                    top.left[node], top.right[node] = kids
    sent = spark.sparkContext.broadcast([(t.nodes(), np.array(t.state)) for t in tops])
    paths = spark.sparkContext.broadcast([t.path for t in tops])

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, rid = matrix(b.column(1), dim), b.column(0).to_numpy(zero_copy_only=False)
            for k, (nodes, state) in enumerate(sent.value):
                w, at = weigh(rid, k), nodes.walk(x)
                mine = np.flatnonzero((state[at] == SMALL) & (w > 0))
                if len(mine):
                    place = [pa.array(np.full(len(mine), k, dtype=np.int32)), pa.array(at[mine].astype(np.int32)), pa.array(w[mine])]
                    yield pa.RecordBatch.from_arrays([*b.take(pa.array(mine)).columns, *place], ["rid", "x", "t", "tree", "node", "w"])

    def subtree(key: tuple, part: pa.Table) -> pa.Table:
        """At most about ``local_rows`` rows. Sorted, so that equal sums are equal to the last bit."""
        tree, node = key[0].as_py(), key[1].as_py()
        part = part.take(pa.array(np.argsort(part.column("rid").to_numpy(), kind="stable"))).combine_chunks()
        x = matrix(part.column("x").chunk(0), dim)
        grown = grow(x, part.column("t").to_numpy(), part.column("w").to_numpy(), subset, seed, tree, paths.value[tree][node])
        return pa.table([pa.array([tree], pa.int32()), pa.array([node], pa.int32()), pa.array([grown.packed()], pa.binary())], ["tree", "node", "nodes"])

    small = rows.select("rid", "x", "t").mapInArrow(dealt, "rid long, x array<double>, t double, tree int, node int, w double")
    # a task a node, about, so that no task gets many of them by chance
    small = small.repartition(max(1, min(1 << 10, sum(state == SMALL for top in tops for state in top.state))), "tree", "node")
    subtrees = small.groupBy("tree", "node").applyInArrow(subtree, "tree int, node int, nodes binary")
    return Trees(tops, materialize(subtrees, "subtrees"), dim)
