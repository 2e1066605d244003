"""Gradient boosting for the log loss, with leaves re-estimated by a Newton step (Friedman 2001).

Each round fits a small regression tree to the residuals ``t - p`` and then gives every leaf the value
``sum of residuals / sum of p (1 - p)``, the Newton step of the log loss in that leaf, and not the mean of its residuals.

One aggregate a tree level: every task adds rows, residuals and ``p (1 - p)`` by (node, feature, bin), and the tables of the tasks
are added in a tree (``tree_sum``). The last level's table already holds the sums of the leaves, so re-estimation costs no pass of its own.
What travels is nodes x features x bins, whatever the number of rows. Rows are read as bin numbers with the score of
the rounds so far; they are rewritten every ``REWRITE`` rounds, and a task adds the rounds since.

Cuts lie midway between neighbouring distinct values where a feature has at most ``bins`` of them, else between quantiles. Of
equally good cuts the first feature's lowest wins (gains are compared to twelve digits), so the result depends neither on
partitions nor on a seed.

**As many bins as rows** (more than ``NARROW``): such a table would grow with the rows, at the driver as in every task, so rows keep their
values. The level's table then has quantile buckets instead of bins. A second pass sends each bucket's values, summed by (value, node) where they
are read, to a task of their own, which has what lies below its bucket from the first pass and returns the bucket's best cuts of each
node: the cuts are the same midpoints, and the driver holds a few rows a bucket.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .perceptron import sigmoid
from .sums import grouped_answers, matrix, merged, tree_sum

#: Rounds whose trees a task still applies itself before the rows are rewritten with their scores.
REWRITE = 25
DIGITS = 12
#: Cuts of a tree that are all tried on all rows, as that is faster than to follow each row.
FEW = 15
#: Bins a feature up to which all tasks add tables of them.
NARROW = 1 << 11
#: Rows of a bucket of values, about, and buckets a feature at most.
BUCKET_ROWS, BUCKETS = 1 << 15, 1 << 10


@dataclass
class Tree:
    """Node i has the children 2i + 1 and 2i + 2; ``feature`` is -1 at a leaf. Rows go right where their bin (or their value, in a model
    without ``edges``) exceeds ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def leaf(self, bins: np.ndarray) -> np.ndarray:
        if (self.feature >= 0).sum() <= FEW:
            return np.broadcast_to(self._under(0, bins), len(bins)).astype(np.int64)
        node = np.zeros(len(bins), dtype=np.int64)
        rows = np.arange(len(bins))
        while True:
            inner = self.feature[node] >= 0
            if not inner.any():
                return node
            right = bins[rows, np.maximum(self.feature[node], 0)] > self.cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)

    def _under(self, node: int, bins: np.ndarray) -> np.ndarray | int:
        """The leaf of every row, were ``node`` the root: each cut is one comparison of a column."""
        if self.feature[node] < 0:
            return node
        return np.where(bins[:, self.feature[node]] > self.cut[node], self._under(2 * node + 2, bins), self._under(2 * node + 1, bins))


@dataclass
class BoostedTrees:
    prior: float
    rate: float
    edges: list[np.ndarray] | None  # none: trees cut values, not bins
    trees: list[Tree] = field(default_factory=list)
    deviance: list[float] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        bins = x if self.edges is None else binned(x, self.edges)
        return self.prior + sum((self.rate * t.value[t.leaf(bins)] for t in self.trees), np.zeros(len(x)))

    def margin(self, spark, features: Sequence[str]) -> Column:
        sent, dim = spark.sparkContext.broadcast(self), len(features)

        def margins(x: pa.Array) -> pa.Array:
            return pa.array(sent.value.score(matrix(x, dim)))

        return F.arrow_udf(margins, "double")(F.array(*[F.col(c).cast("double") for c in features]))


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each value: how many cuts lie below it."""
    return np.column_stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)]) if len(edges) else np.zeros((len(x), 0), dtype=int)


def cut_points(rows: DataFrame, dim: int, bins: int) -> list[np.ndarray]:
    """At most ``bins`` - 1 cuts a feature: all midpoints where the distinct values are few, else at quantiles."""
    x = F.col("x")
    few = rows.agg(*[F.approx_count_distinct(x[i]).alias(str(i)) for i in range(dim)]).first()
    exact = [i for i in range(dim) if few[i] <= 2 * bins]
    values: dict[int, np.ndarray] = {}
    if exact:
        pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("f"), x[i].alias("v")) for i in exact]))
        # one row a feature with at most about 2 * bins values: the approximate count was checked
        for r in rows.select(pairs.alias("p")).groupBy("p.f").agg(F.collect_set("p.v").alias("v")).collect():
            values[r["f"]] = np.sort(np.array(r["v"]))
    wide = [i for i in range(dim) if len(values.get(i, ())) > bins or i not in values]
    if wide:
        share = [k / bins for k in range(1, bins)]
        q = rows.agg(*[F.percentile_approx(x[i], share, 20 * bins).alias(str(i)) for i in wide]).first()
        for k, i in enumerate(wide):
            values[i] = np.unique(np.array(q[k] if q[k] is not None else [], dtype=np.float64))
    out = []
    for i in range(dim):
        v = values.get(i, np.zeros(0))
        middle = v[:-1] + (v[1:] - v[:-1]) / 2
        out.append(np.where(middle >= v[1:], v[:-1], middle) if i not in wide else v[:-1] if len(v) > 1 else v)
    return out


def best_cuts(table: np.ndarray, bins: int) -> list[tuple[int, int, np.ndarray, np.ndarray] | None]:
    """For each node of ``table`` (node, 3, feature, bin): (feature, cut, sums left, sums right), None where no cut gains."""
    out: list[tuple[int, int, np.ndarray, np.ndarray] | None] = []
    for node in table:
        left = np.cumsum(node, axis=2)
        total = left[:, :, -1:]
        right = total - left
        ok = (left[0] > 0.5) & (right[0] > 0.5)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - total[1] ** 2 / total[0]
        gain = np.where(ok, gain, -np.inf)
        top = gain.max(initial=-np.inf)
        if not top > 1e-12:
            out.append(None)
            continue
        f, cut = (int(v[0]) for v in np.nonzero(gain >= top - abs(top) * 10.0**-DIGITS))
        out.append((f, cut, left[:, f, cut], right[:, f, cut]))
    return out


def bucket_bounds(rows: DataFrame, dim: int, n: int) -> list[np.ndarray]:
    """Values that part each feature into buckets of about ``BUCKET_ROWS`` rows; any values give the same cuts."""
    many = min(BUCKETS, max(1, n // BUCKET_ROWS))
    if many == 1:
        return [np.zeros(0)] * dim
    share = [k / many for k in range(1, many)]
    q = rows.agg(*[F.percentile_approx(F.col("x")[i], share, 10 * many).alias(str(i)) for i in range(dim)]).first()
    return [np.unique(np.array(q[i], dtype=np.float64)) for i in range(dim)]


def summed_values(x: np.ndarray, node: np.ndarray, stats: Sequence[np.ndarray], bounds: list[np.ndarray]) -> Iterator[tuple[tuple[int, int], bytes]]:
    """((feature, bucket), rows of value, node and the sums of ``stats``), a row for each value and node."""
    for f, bound in enumerate(bounds):
        order = np.lexsort((node, x[:, f]))
        v, k = x[order, f], node[order]
        first = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (k[1:] != k[:-1])))
        out = np.column_stack([v[first], k[first], *(np.add.reduceat(s[order], first) for s in stats)])
        bucket = np.searchsorted(bound, out[:, 0], side="left")
        starts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for a, b in zip(starts, np.append(starts[1:], len(out)), strict=True):
            yield (f, int(bucket[a])), out[a:b].tobytes()


def bucket_cuts(values: np.ndarray, feature: int, below: np.ndarray, total: np.ndarray, later: float) -> np.ndarray:
    """Rows of (node, feature, cut, gain, sums left, sums right): in each node the cuts that may prove the lowest of the best. ``values`` as
    ``summed_values`` gives them, all of a bucket; ``below``, ``total``: each node's sums (3) under the bucket and in all; ``later``: the
    lowest value above the bucket."""
    distinct = np.unique(values[:, 0])
    following = np.append(distinct[1:], later)
    out = [np.zeros((0, 10))]
    for k in range(len(total)):
        mine = values[values[:, 1] == k]
        if not len(mine):
            continue
        v, inverse = np.unique(mine[:, 0], return_inverse=True)
        left = below[k] + np.cumsum(np.column_stack([np.bincount(inverse, mine[:, 2 + j]) for j in range(3)]), axis=0)
        right = total[k] - left
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = left[:, 1] ** 2 / left[:, 0] + right[:, 1] ** 2 / right[:, 0] - total[k, 1] ** 2 / total[k, 0]
        gain = np.where((left[:, 0] > 0.5) & (right[:, 0] > 0.5), gain, -np.inf)
        top = gain.max()
        if not top > 1e-12:
            continue
        # of the cuts near the top, those better than every lower one: whatever the top of all buckets, the lowest that reaches it is among them
        best = (gain > np.append(-np.inf, np.maximum.accumulate(gain)[:-1])) & (gain >= top - 2 * abs(top) * 10.0**-DIGITS)
        low, high = v[best], following[np.searchsorted(distinct, v[best])]
        middle = low + (high - low) / 2
        cut = np.where(middle >= high, low, middle)
        out.append(np.column_stack([np.full(len(cut), k), np.full(len(cut), feature), cut, gain[best], left[best], right[best]]))
    return np.concatenate(out)


def lowest_of_best(cuts: np.ndarray, many: int) -> list[tuple[int, float, np.ndarray, np.ndarray] | None]:
    """``best_cuts`` from the rows of ``bucket_cuts`` of all buckets."""
    out: list[tuple[int, float, np.ndarray, np.ndarray] | None] = []
    for k in range(many):
        mine = cuts[cuts[:, 0] == k]
        top = mine[:, 3].max(initial=-np.inf)
        near = mine[mine[:, 3] >= top - abs(top) * 10.0**-DIGITS] if len(mine) else mine
        first = near[np.lexsort((near[:, 2], near[:, 1]))[0]] if len(near) else None
        out.append(None if first is None else (int(first[1]), float(first[2]), first[4:7], first[7:10]))
    return out


def fit_boosted_trees(
    rows: DataFrame, dim: int, rounds: int = 100, depth: int = 3, rate: float = 0.1, bins: int = 512, narrow: int = NARROW
) -> BoostedTrees:
    """``rows``: ``x`` array<double> of ``dim`` and ``t`` in {0, 1}; a written table."""
    spark = rows.sparkSession
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.sum("t").alias("p")).first()
    wide = bins > narrow and bins >= counts["n"]  # no feature has more distinct values than bins
    edges = None if wide else cut_points(rows, dim, bins)
    bounds = bucket_bounds(rows, dim, counts["n"]) if wide else edges
    width = max([len(e) for e in bounds], default=0) + 1
    share = min(max((counts["p"] or 0.0) / max(1, counts["n"]), 1e-12), 1 - 1e-12)
    model = BoostedTrees(float(np.log(share / (1 - share))), rate, edges)
    if not counts["n"] or not 0 < counts["p"] < counts["n"]:
        return model  # one class: the prior alone
    sent = spark.sparkContext.broadcast(bounds)

    def to_bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            score = pa.array(np.full(b.num_rows, model.prior))
            if wide:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), score], ["b", "t", "score"])
                continue
            codes = binned(matrix(b.column(0), dim), sent.value).astype(np.int32)
            ends = pa.array(np.arange(0, codes.size + 1, dim, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(codes.ravel())), b.column(1), score], ["b", "t", "score"])

    schema = f"b array<{'double' if wide else 'int'}>, t double, score double"
    data = materialize(rows.select("x", "t").mapInArrow(to_bins, schema), "boost-bins")
    fresh: list[Tree] = []

    def lowest(b: pa.RecordBatch) -> np.ndarray:
        """The lowest value of each feature's buckets."""
        x, out = matrix(b.column(0), dim), np.full((dim, width), np.inf)
        for f, bucket in enumerate(binned(x, sent.value).T):
            np.minimum.at(out[f], bucket, x[:, f])
        return out.ravel()

    if wide:
        lows = merged(data, lowest, np.minimum, np.full(dim * width, np.inf)).reshape(dim, width)
        # the lowest value above each bucket
        later = np.column_stack([np.minimum.accumulate(lows[:, ::-1], axis=1)[:, ::-1][:, 1:], np.full(dim, np.inf)])

    def scored(b: pa.RecordBatch, trees: list[Tree]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes = np.asfortranarray(b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim))  # read column by column
        score = b.column(2).to_numpy(zero_copy_only=False) + sum((rate * t.value[t.leaf(codes)] for t in trees), np.zeros(b.num_rows))
        return codes, b.column(1).to_numpy(zero_copy_only=False), score

    def rewritten(batches: Iterator[pa.RecordBatch], trees: list[Tree]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scored(b, trees)[2])], ["b", "t", "score"])

    for _ in range(rounds):
        size = (2 << depth) - 1
        tree = Tree(np.full(size, -1, dtype=np.int64), np.zeros(size, dtype=np.float64 if wide else np.int64), np.zeros(size))
        sums: dict[int, np.ndarray] = {}
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level

            def own(b: pa.RecordBatch, tree=tree, trees=tuple(fresh), first=first, many=many) -> np.ndarray:
                codes, t, score = scored(b, list(trees))
                p = sigmoid(score)
                node = tree.leaf(codes) - first
                here = (node >= 0) & (node < many)
                codes, node = codes[here], node[here]
                if wide:
                    codes = binned(codes, sent.value)
                stats = (None, (t - p)[here], (p * (1 - p))[here])
                out = np.zeros((many, 3, dim, width))
                for f in range(dim):
                    at = node * width + codes[:, f]
                    for k, v in enumerate(stats):
                        out[:, k, f] = np.bincount(at, v, many * width).reshape(many, width)
                loss = float((np.logaddexp(0.0, score) - t * score).sum()) if first == 0 else 0.0
                return np.append(out.ravel(), loss)

            got = tree_sum(data, own, many * 3 * dim * width + 1)
            if level == 0:
                model.deviance.append(2 * float(got[-1]) / counts["n"])
            table = got[:-1].reshape(many, 3, dim, width)

            def values(b: pa.RecordBatch, tree=tree, trees=tuple(fresh), first=first, many=many) -> Iterator[tuple[tuple[int, int], bytes]]:
                x, t, score = scored(b, list(trees))
                p, node = sigmoid(score), tree.leaf(x) - first
                # rows that are in no node of the level still say which value comes next
                node = np.where((node >= 0) & (node < many), node, -1)
                return summed_values(x, node, (np.ones(len(x)), t - p, p * (1 - p)), sent.value)

            def cuts(at: tuple[int, int], parts: Iterable[bytes], table=table) -> bytes:
                f, bucket = at
                both = np.concatenate([np.frombuffer(part).reshape(-1, 5) for part in parts])
                return bucket_cuts(both, f, table[:, :, f, :bucket].sum(axis=2), table[:, :, f].sum(axis=2), later[f, bucket]).tobytes()

            if wide:
                answers = [np.frombuffer(a).reshape(-1, 10) for a in grouped_answers(data, values, cuts)]
                chosen = lowest_of_best(np.concatenate([np.zeros((0, 10)), *answers]), many)
            else:
                chosen = best_cuts(table, width)
            for k, found in enumerate(chosen):
                node = first + k
                if found is None:
                    continue
                tree.feature[node], tree.cut[node] = found[0], found[1]
                sums[2 * node + 1], sums[2 * node + 2] = found[2], found[3]
                sums.pop(node, None)
        if not sums:
            break  # no cut gains anything: later rounds would not either
        for node, (_, residual, curvature) in sums.items():
            tree.value[node] = residual / curvature if curvature > 1e-150 else 0.0
        model.trees.append(tree)
        fresh.append(tree)
        if len(fresh) == REWRITE:
            done = tuple(fresh)
            data = materialize(data.mapInArrow(lambda it, done=done: rewritten(it, list(done)), schema), "boost-scores")
            fresh = []
    last = tree_sum(data, lambda b, trees=tuple(fresh): np.array([(np.logaddexp(0.0, (s := scored(b, list(trees)))[2]) - s[1] * s[2]).sum()]), 1)
    model.deviance.append(2 * float(last[0]) / counts["n"])
    return model
