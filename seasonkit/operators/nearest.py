"""Exact 1-nearest-neighbour join (Euclidean) without a cross join, best bound first.

1. Identical training vectors are collapsed (the lowest training key answers): a partial aggregate, so a
   vector that a third of the rows repeat costs one row a task.
2. The points are turned to their principal axes. A turn changes no distance, but boxes along the axes of the data
   are far smaller than boxes along correlated columns, so they rule out more. Axes and the median splits of a
   tree of at most ``2**MAX_DEPTH`` cells come from a bounded sample; any axes and any splits give the same answers.
3. Every point is labelled with its cell in **one** pass. Cells are boxed tightly by one aggregate. A cell of more
   than ``block_points`` points is dealt into blocks by hash, so a task's share is bounded at any size.
4. Each query is answered in its own cell. That distance is its bound: a descent of the tree keeps the
   other cells whose box lies no farther, and only these are searched in a second round, from that bound on.
5. Inside a block the points are cut into balanced leaves of ``leaf_size``; leaves are visited by their distance
   from the query until the next one lies beyond the best distance found (NumPy, all queries of a chunk together).

Queries of one cell are dealt into chunks of at most about ``query_chunk``; no pair becomes a row. The best candidate of a
query is a ``min_by`` aggregate. Ties on distance go to the lowest training key. A missing feature (null or NaN)
on either side fails with the row's keys, since it has no distance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import required
from ..session import materialize

#: The tree has at most 2**MAX_DEPTH cells: their boxes (two corners each) are what the driver and the tasks hold of it.
MAX_DEPTH = 12
#: Points of the sample that places axes and splits, about.
SAMPLE = 1 << 15
#: Doubles of a NumPy work array, about (8 MB).
BLOCK_CELLS = 1 << 20
#: (query, cell) pairs that a task makes at once.
PAIRS = 1 << 17
#: Turned coordinates are rounded: boxes are compared with this much room, so no leaf is left out wrongly.
ROOM = 1e-9


class Tree(NamedTuple):
    """Axes and median splits. Cell c of depth k is the leaf 2**k + c of a heap; node i splits at ``split[i]`` along ``axis[i]``."""

    mean: np.ndarray
    axes: np.ndarray
    depth: int
    axis: np.ndarray
    split: np.ndarray

    def turned(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.axes

    def cell(self, z: np.ndarray) -> np.ndarray:
        node = np.ones(len(z), dtype=np.int64)
        for _ in range(self.depth):
            node = 2 * node + (z[np.arange(len(z)), self.axis[node]] > self.split[node])
        return node - (1 << self.depth)


class Boxes(NamedTuple):
    """Tight corners of all tree nodes, in heap order; nodes without points have an inverted box."""

    low: np.ndarray
    high: np.ndarray


def _vec(features: Sequence[str], keys: Sequence[str]):
    return F.array(*[required(c, keys) for c in features])


def _matrix(column: pd.Series, dim: int) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, dim))


def grow_tree(points: DataFrame, dim: int, n: int, cell_points: int) -> Tree:
    """Axes and splits from about ``SAMPLE`` points, chosen by the hash of the vector."""
    every = max(1, n // SAMPLE)
    rows = points.filter(F.pmod(F.xxhash64("x"), F.lit(every)) == 0).select("x").toPandas()  # about SAMPLE rows
    x = _matrix(rows["x"], dim)
    mean = x.mean(axis=0) if len(x) else np.zeros(dim)
    axes = np.linalg.eigh((x - mean).T @ (x - mean))[1][:, ::-1] if len(x) else np.eye(dim)
    wanted = math.ceil(math.log2(max(1.0, n / cell_points)))
    depth = int(min(MAX_DEPTH, wanted, max(0, math.floor(math.log2(max(1, len(x)))))))
    axis, split = np.zeros(1 << depth, dtype=np.int64), np.zeros(1 << depth)
    parts = {1: (x - mean) @ axes}
    for node in range(1, 1 << depth):
        z = parts.pop(node)
        if len(z):
            axis[node] = int(np.argmax(z.max(axis=0) - z.min(axis=0)))
            split[node] = np.median(z[:, axis[node]])
        right = z[:, axis[node]] > split[node]
        parts[2 * node], parts[2 * node + 1] = z[~right], z[right]
    return Tree(mean, axes, depth, axis, split)


def label_points(points: DataFrame, tree: Tree, dim: int) -> tuple[DataFrame, dict[int, int], Boxes]:
    """(points with ``cell``, written; points of each cell; boxes of all nodes)."""
    sent = points.sparkSession.sparkContext.broadcast(tree)

    def label(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(cell=sent.value.cell(sent.value.turned(_matrix(b["x"], dim))))

    def corners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            z = pd.DataFrame(sent.value.turned(_matrix(b["x"], dim))).groupby(b["cell"].to_numpy())
            low, high, n = z.min(), z.max(), z.size()
            yield pd.DataFrame({"cell": low.index, "n": n.to_numpy(), "low": list(low.to_numpy()), "high": list(high.to_numpy())})

    labelled = materialize(points.mapInPandas(label, T.StructType([*points.schema.fields, T.StructField("cell", T.LongType())])), "nn-points")
    parts = labelled.select("cell", "x").mapInPandas(corners, "cell long, n long, low array<double>, high array<double>")
    ends = [F.min(F.col("low")[i]).alias(f"l{i}") for i in range(dim)] + [F.max(F.col("high")[i]).alias(f"h{i}") for i in range(dim)]
    low = np.full((2 << tree.depth, dim), np.inf)
    high = np.full((2 << tree.depth, dim), -np.inf)
    sizes: dict[int, int] = {}
    for r in parts.groupBy("cell").agg(F.sum("n").alias("n"), *ends).collect():  # one row a cell
        at = (1 << tree.depth) + r["cell"]
        low[at], high[at] = [r[f"l{i}"] for i in range(dim)], [r[f"h{i}"] for i in range(dim)]
        sizes[r["cell"]] = r["n"]
    for node in range((1 << tree.depth) - 1, 0, -1):
        low[node] = np.minimum(low[2 * node], low[2 * node + 1])
        high[node] = np.maximum(high[2 * node], high[2 * node + 1])
    return labelled, sizes, Boxes(low, high)


def _mindist(z: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point of ``z`` (q, d) to each box (l, d), a dimension at a time: what is held is q x l."""
    out = np.zeros((len(z), len(low)))
    for at, lowest, highest in zip(z.T, low.T, high.T, strict=True):
        gap = np.maximum(lowest[None] - at[:, None], at[:, None] - highest[None])
        np.maximum(gap, 0.0, out=gap)
        gap *= gap
        out += gap
    return out


def _room(best: np.ndarray, scale: float) -> np.ndarray:
    return best * (1.0 + ROOM) + (ROOM * scale) ** 2


def near_cells(z: np.ndarray, own: np.ndarray, bound: np.ndarray, tree: Tree, boxes: Boxes) -> tuple[np.ndarray, np.ndarray]:
    """(query, cell) of all cells but the query's own whose box lies within its bound: a descent of the tree."""
    scale = float(np.abs(z).max(initial=0.0) + np.abs(boxes.high[1]).max() + np.abs(boxes.low[1]).max())
    queries, cells = [], []
    stack = [(1, np.arange(len(z)))]
    while stack:
        node, asked = stack.pop()
        gap = np.maximum(np.maximum(boxes.low[node] - z[asked], z[asked] - boxes.high[node]), 0.0)
        asked = asked[(gap * gap).sum(-1) <= _room(bound[asked], scale)]
        if not len(asked):
            continue
        if node >> tree.depth:
            cell = node - (1 << tree.depth)
            asked = asked[own[asked] != cell]
            queries.append(asked)
            cells.append(np.full(len(asked), cell, dtype=np.int64))
        else:
            stack += [(2 * node, asked), (2 * node + 1, asked)]
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *queries]), np.concatenate([none, *cells])


def search_block(x: np.ndarray, z: np.ndarray, q: np.ndarray, zq: np.ndarray, bound: np.ndarray, leaf_size: int):
    """For each query: (row of the nearest point or -1 where none is within ``bound``, squared distance, distances computed).

    ``x`` and ``q`` are points and queries, ``z`` and ``zq`` the same, turned. Of equally near points the first row wins.
    """
    n, dim = x.shape
    height = max(0, math.ceil(math.log2(max(1.0, n / leaf_size))))
    parts = [np.arange(n)]
    for _ in range(height):
        halves = []
        for p in parts:
            k = int(np.argmax(z[p].max(axis=0) - z[p].min(axis=0))) if len(p) else 0
            order = p[np.argpartition(z[p, k], len(p) // 2)] if len(p) > 1 else p
            halves += [order[: len(p) // 2], order[len(p) // 2 :]]
        parts = [p for p in halves if len(p)]
    width = max(map(len, parts))
    rows = np.full((len(parts), width), -1, dtype=np.int64)
    for i, p in enumerate(parts):
        rows[i, : len(p)] = np.sort(p)
    low, high = np.stack([z[p].min(axis=0) for p in parts]), np.stack([z[p].max(axis=0) for p in parts])
    scale = float(np.abs(z).max(initial=0.0) + np.abs(zq).max(initial=0.0))
    best, at, checked = bound.copy(), np.full(len(q), -1, dtype=np.int64), np.zeros(len(q), dtype=np.int64)
    step = max(1, BLOCK_CELLS // max(len(parts), width * dim))
    for s in range(0, len(q), step):
        block = np.arange(s, min(s + step, len(q)))
        far = _mindist(zq[block], low, high)
        order = np.argsort(far, axis=1)
        for rank in range(len(parts)):
            leaf = order[:, rank]
            live = far[np.arange(len(block)), leaf] <= _room(best[block], scale)
            if not live.any():
                break
            who, cand = block[live], rows[leaf[live]]
            diff = q[who][:, None, :] - x[cand]
            d2 = np.where(cand >= 0, (diff * diff).sum(-1), np.inf)
            j = d2.argmin(-1)
            d, r = d2[np.arange(len(who)), j], cand[np.arange(len(who)), j]
            checked[who] += (cand >= 0).sum(-1)
            better = (d < best[who]) | ((d == best[who]) & ((at[who] < 0) | (r < at[who])))
            best[who[better]], at[who[better]] = d[better], r[better]
    return at, best, checked


def _answer(tree_sent, tk_names: Sequence[str], key_names: Sequence[str], dim: int, leaf_size: int):
    def fn(qs: pd.DataFrame, ps: pd.DataFrame) -> pd.DataFrame:
        columns = [*key_names, "q", "own", "d2", *tk_names, "y", "checked"]
        if qs.empty or ps.empty:
            return pd.DataFrame({c: [] for c in columns})
        tree = tree_sent.value
        ps = ps.sort_values(list(tk_names), kind="mergesort").reset_index(drop=True)
        x, q = _matrix(ps["x"], dim), _matrix(qs["q"], dim)
        at, best, checked = search_block(x, tree.turned(x), q, tree.turned(q), qs["bound"].to_numpy(dtype=np.float64), leaf_size)
        found = at >= 0
        out = qs[[*key_names, "q", "own"]].reset_index(drop=True)
        out["d2"], out["checked"] = np.where(found, best, np.inf), checked
        for c in (*tk_names, "y"):
            out[c] = ps[c].to_numpy()[np.maximum(at, 0)]
        return out[columns]

    return fn


def search_cells(
    asked: DataFrame,
    points: DataFrame,
    blocks: DataFrame,
    tree_sent,
    tk_names: Sequence[str],
    key_names: Sequence[str],
    dim: int,
    leaf_size: int,
    query_chunk: int,
    few: bool = True,
) -> DataFrame:
    """The best point of every block of its cell for each row of ``asked`` (keys, q, own, bound, cell).

    ``blocks`` (cell, blocks) says how many blocks a cell's points are dealt into; the queries of a cell are dealt into chunks.
    A cell that no query asks is not searched. ``few``: the cells are few enough to be broadcast; points and queries never are.
    """
    chunks = asked.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(query_chunk))).cast("int").alias("chunks"))
    plan = F.broadcast(chunks.join(F.broadcast(blocks), "cell")) if few else chunks.join(blocks.hint("merge"), "cell").hint("merge")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.col(count) - 1))
    chunk = F.pmod(F.xxhash64(*[F.col(k) for k in key_names]), F.col("chunks")).cast("int")
    ask = asked.join(plan, "cell").select("cell", chunk.alias("chunk"), every("blocks").alias("block"), *key_names, "q", "own", "bound")
    block = F.pmod(F.xxhash64("x", F.lit(7)), F.col("blocks")).cast("int")
    have = points.join(plan, "cell").select("cell", every("chunks").alias("chunk"), block.alias("block"), "x", *tk_names, "y")
    fields = [
        *[asked.schema[k] for k in key_names], asked.schema["q"], T.StructField("own", T.LongType()), T.StructField("d2", T.DoubleType()),
        *[points.schema[t] for t in tk_names], T.StructField("y", T.DoubleType()), T.StructField("checked", T.LongType()),
    ]
    groups = ["cell", "chunk", "block"]
    return ask.groupBy(*groups).cogroup(have.groupBy(*groups)).applyInPandas(
        _answer(tree_sent, tk_names, key_names, dim, leaf_size), T.StructType(fields)
    )


def best_found(found: DataFrame, tk_names: Sequence[str], key_names: Sequence[str]) -> DataFrame:
    order = F.struct("d2", *tk_names)
    return found.groupBy(*key_names).agg(
        F.min_by(F.struct("q", "own", "y", "d2", *tk_names), order).alias("b"), F.sum("checked").alias("checked")
    ).select(*key_names, "b.*", "checked")


def distinct_points(train: DataFrame, features: Sequence[str], label: str, train_keys: Sequence[str], tk_names: Sequence[str]) -> DataFrame:
    """(x, tk..., y): identical vectors collapsed to the one of the lowest key; written."""
    pts = train.select(
        _vec(features, train_keys).alias("x"),
        F.struct(*[F.col(k).alias(t) for k, t in zip(train_keys, tk_names)]).alias("tk"),
        F.col(label).cast("double").alias("y"),
    )
    pts = pts.groupBy("x").agg(F.min_by(F.struct("tk", "y"), F.col("tk")).alias("b")).select("x", "b.tk.*", "b.y")
    return materialize(pts, "nn-distinct")


def nearest_neighbour(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str = "label",
    train_keys: Sequence[str] = ("year", "posteam"),
    test_keys: Sequence[str] = ("year", "posteam"),
    leaf_size: int = 32,
    query_chunk: int = 4096,
    cell_points: int = 1 << 14,
    block_points: int = 1 << 16,
    counts: bool = False,
) -> DataFrame:
    """For each test row (unique ``test_keys``): the nearest training row's label ``nn_label`` and distance ``nn_dist``.

    With ``counts`` also ``nn_checked``: the distances computed for the row.
    """
    spark = train.sparkSession
    dim = len(features)
    tk_names = [f"tk{i}" for i in range(len(train_keys))]
    key_names = list(test_keys)

    pts = distinct_points(train, features, label, train_keys, tk_names)
    n = pts.count()
    tree = grow_tree(pts, dim, n, cell_points)
    if tree.depth:
        pts, sizes, boxes = label_points(pts, tree, dim)
    else:
        # 0 for every row, but no literal: the planner would drop the join's key and plan a nested loop
        pts, sizes, boxes = pts.withColumn("cell", F.pmod(F.xxhash64("x"), F.lit(1).cast("long"))), {0: n}, None
    tree_sent = spark.sparkContext.broadcast(tree)

    q = test.select(*key_names, _vec(features, key_names).alias("q"))
    key_fields = [q.schema[k] for k in key_names]
    vector = T.StructField("q", T.ArrayType(T.DoubleType()))
    asked_fields = [*key_fields, vector, T.StructField("own", T.LongType()), T.StructField("bound", T.DoubleType()), T.StructField("cell", T.LongType())]
    # one row a cell, at most 2**MAX_DEPTH: broadcast
    blocks = spark.createDataFrame([(c, math.ceil(m / block_points)) for c, m in sizes.items() if m], "cell long, blocks int")

    def searched(asked: DataFrame) -> DataFrame:
        return search_cells(asked, pts, blocks, tree_sent, tk_names, key_names, dim, leaf_size, query_chunk)

    def best_of(found: DataFrame) -> DataFrame:
        return best_found(found, tk_names, key_names)

    if not tree.depth:
        zero = F.lit(0).cast("long")
        cell = F.pmod(F.xxhash64("q"), F.lit(1).cast("long"))
        result = best_of(searched(q.withColumns({"own": zero, "bound": F.lit(float("inf")), "cell": cell})))
    else:
        boxes_sent = spark.sparkContext.broadcast((boxes, frozenset(sizes)))

        def own_cell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            boxes, full = boxes_sent.value
            for b in batches:
                if len(b):
                    z = tree_sent.value.turned(_matrix(b["q"], dim))
                    cell = tree_sent.value.cell(z)
                    for i in np.flatnonzero([c not in full for c in cell]):  # an empty cell answers nothing: the nearest box does
                        low, high = (side[1 << tree_sent.value.depth :] for side in boxes)
                        cell[i] = int(np.argmin(_mindist(z[i : i + 1], low, high)[0]))
                    yield b.assign(own=cell, bound=np.inf, cell=cell)

        def others(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            step = max(1, PAIRS >> tree_sent.value.depth)
            for b in (whole.iloc[at : at + step] for whole in batches for at in range(0, len(whole), step)):
                z, bound = tree_sent.value.turned(_matrix(b["q"], dim)), b["d2"].to_numpy()
                who, cell = near_cells(z, b["own"].to_numpy(), bound, tree_sent.value, boxes_sent.value[0])
                out = b.iloc[who][[*key_names, "q", "own"]].reset_index(drop=True)
                yield out.assign(bound=bound[who], cell=cell)

        schema = T.StructType(asked_fields)
        # each written once: it feeds the counts of the chunks as well as the search
        first = materialize(best_of(searched(materialize(q.mapInPandas(own_cell, schema), "nn-asked"))), "nn-first")
        more = materialize(first.select(*key_names, "q", "own", "d2").mapInPandas(others, schema), "nn-more")
        result = best_of(first.unionByName(searched(more)))
    extra = [F.col("checked").alias("nn_checked")] if counts else []
    return result.select(*key_names, F.col("y").alias("nn_label"), F.sqrt("d2").alias("nn_dist"), *extra)
