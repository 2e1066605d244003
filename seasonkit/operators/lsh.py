"""Approximate 1-nearest neighbour by locality-sensitive probing, for tables where the exact search visits too much.

Random projections cut into steps hash near vectors to equal keys (Datar, Immorlica, Indyk & Mirrokni 2004). Everything that sets
them comes from a bounded sample: the step width from the distance within which most sampled vectors have a neighbour, the number
of projections of a key from the share of all pairs that a table may bring together, and the number of tables from the
probability ``miss`` that a pair at that distance meets in none.

A key's points and queries meet in a cogroup; its points are dealt into blocks and its queries into chunks, so a hot
key is many bounded tasks, and inside a block the search visits leaves by distance as the exact one does. One table is searched
first; what it finds bounds the search of the others. No pair becomes a row: a block sends one row a query. Queries that
meet no point at all are answered by the exact search. A cluster far tighter than the step width is met in every
table: there probing saves nothing over the exact search, which suits it better.

Recall, the share of rows whose distance is the exact one's, is for the caller to test; on the season table it is above 0.9.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.sums import matrix
from ..session import materialize
from .nearest import Tree, _matrix, _vec, best_found, distinct_points, nearest_neighbour, search_cells

#: Points of the sample, about; pairs of them stand for all pairs.
SAMPLE = 1 << 11
#: Points that a key should bring together with a query, about, all tables taken together.
MEET = 512
MOST_TABLES = 64
#: Rows whose keys in all tables are computed at once.
PIECE = 256


def collision(distance: np.ndarray | float, width: float) -> np.ndarray:
    """Probability that one projection cut at ``width`` hashes two vectors at ``distance`` alike."""
    ratio = width / np.maximum(np.asarray(distance, dtype=np.float64), 1e-300)
    tail = np.array([math.erfc(r / math.sqrt(2.0)) for r in np.ravel(ratio)]).reshape(ratio.shape)
    return 1.0 - tail - 2.0 / (math.sqrt(2.0 * math.pi) * ratio) * (1.0 - np.exp(-ratio * ratio / 2.0))


def choose_tables(x: np.ndarray, n: int, miss: float) -> tuple[float, int, int]:
    """(step width, projections a key, tables) for ``n`` points like the sample ``x``."""
    d2 = (x * x).sum(1)[:, None] + (x * x).sum(1)[None] - 2.0 * (x @ x.T)
    d = np.sqrt(np.maximum(d2, 0.0))
    np.fill_diagonal(d, np.inf)
    near = float(np.quantile(d.min(axis=1), 0.9)) if len(x) > 1 else 1.0  # a sample's neighbours lie farther than all points'
    every = d[np.triu_indices(len(x), 1)]
    every = every[: 1 << 18] if len(every) else np.array([1.0])
    width = 3.0 * near if near > 0 else 1.0
    best = None
    for k in range(1, 25):
        p = float(collision(near, width)) ** k
        tables = max(1, math.ceil(math.log(miss) / math.log(max(1e-12, 1.0 - p)))) if p < 1 else 1
        if tables > MOST_TABLES:
            break
        met = n * tables * float((collision(every, width) ** k).mean())
        cost = met + 20.0 * tables  # a table's exchange weighs as some distances do
        if best is None or cost < best[0]:
            best = (cost, k, tables)
        if met <= MEET:
            break
    return width, best[1], best[2]


def approximate_neighbour(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    label: str = "label",
    train_keys: Sequence[str] = ("year", "posteam"),
    test_keys: Sequence[str] = ("year", "posteam"),
    miss: float = 0.03,
    seed: int = 1,
    leaf_size: int = 32,
    query_chunk: int = 4096,
    block_points: int = 1 << 14,
    counts: bool = False,
) -> DataFrame:
    """``nn_label`` and ``nn_dist`` of every test row (unique ``test_keys``); with ``counts`` also ``nn_checked``."""
    spark, dim = train.sparkSession, len(features)
    tk_names, key_names = [f"tk{i}" for i in range(len(train_keys))], list(test_keys)
    pts = distinct_points(train, features, label, train_keys, tk_names)
    n = pts.count()
    q = test.select(*key_names, _vec(features, key_names).alias("q"))
    every = max(1, n // SAMPLE)
    sample = pts.filter(F.pmod(F.xxhash64("x"), F.lit(every)) == 0).select("x").toPandas()  # about SAMPLE rows
    x = _matrix(sample["x"], dim)
    mean = x.mean(axis=0) if len(x) else np.zeros(dim)
    width, k, tables = choose_tables(x - mean, n, miss)
    rng = np.random.default_rng(seed)
    lines, shifts = rng.normal(size=(dim, tables * k)), rng.uniform(0, width, size=tables * k)
    odd = rng.integers(1, 1 << 62, size=(tables, k), dtype=np.int64).astype(np.uint64) | np.uint64(1)
    sent = spark.sparkContext.broadcast((mean, lines, shifts, odd, width))

    def keys(v: np.ndarray) -> np.ndarray:
        """(rows, tables): the key of each vector in each table."""
        mean, lines, shifts, odd, width = sent.value
        steps = np.floor(((v - mean) @ lines + shifts) / width).astype(np.int64).astype(np.uint64).reshape(len(v), *odd.shape)
        mixed = (steps * odd[None]).sum(axis=2, dtype=np.uint64) + np.arange(1, len(odd) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed ^ (mixed >> np.uint64(31))).view(np.int64)

    def dealt(at: int):
        def fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                # a batch's keys and copies are many times the batch: a piece of it at a time
                for start in range(0, whole.num_rows, PIECE):
                    b = whole.slice(start, PIECE)
                    cell = keys(matrix(b.column(at), dim))
                    out = b.take(pa.array(np.repeat(np.arange(b.num_rows), cell.shape[1])))
                    first = np.tile(np.arange(cell.shape[1]) == 0, b.num_rows)
                    yield pa.RecordBatch.from_arrays([*out.columns, pa.array(cell.ravel()), pa.array(first)], [*b.schema.names, "cell", "first"])

        return fn

    placed = [T.StructField("cell", T.LongType()), T.StructField("first", T.BooleanType())]
    points = materialize(pts.mapInArrow(dealt(pts.columns.index("x")), T.StructType([*pts.schema.fields, *placed])), "lsh-points").drop("first")
    asked = materialize(q.mapInArrow(dealt(q.columns.index("q")), T.StructType([*q.schema.fields, *placed])), "lsh-queries")
    asked = asked.withColumn("own", F.lit(0).cast("long"))
    blocks = points.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / F.lit(float(block_points))).cast("int").alias("blocks"))
    axes = np.linalg.eigh((x - mean).T @ (x - mean))[1] if len(x) else np.eye(dim)
    tree = spark.sparkContext.broadcast(Tree(mean, axes, 0, np.zeros(1, dtype=np.int64), np.zeros(1)))
    search = lambda a: search_cells(a, points, blocks, tree, tk_names, key_names, dim, leaf_size, query_chunk, few=False)
    inf = F.lit(float("inf"))
    once = materialize(best_found(search(asked.filter("first").withColumn("bound", inf)), tk_names, key_names), "lsh-first")
    bound = once.select(*key_names, F.col("d2").alias("bound"))
    again = asked.filter("NOT first").join(bound.hint("merge"), key_names, "left").withColumn("bound", F.coalesce("bound", inf))
    found = best_found(once.unionByName(search(again)), tk_names, key_names)
    found = materialize(found.filter("d2 < double('infinity')"), "lsh-found")
    result = found.select(*key_names, F.col("y").alias("nn_label"), F.sqrt("d2").alias("nn_dist"), F.col("checked").alias("nn_checked"))
    lost = test.join(found.select(*key_names).hint("merge"), key_names, "left_anti")
    exact = nearest_neighbour(train, lost, features, label, train_keys, key_names, leaf_size, query_chunk, counts=True)
    both = result.unionByName(exact)
    return both if counts else both.drop("nn_checked")
