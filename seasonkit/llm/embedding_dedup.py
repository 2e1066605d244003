"""Near-duplicate vectors: iterative quantisation, multi-index Hamming tables, rerank by cosine.

1. Equal vectors of a label are one vector from here on, with its number of copies.
2. On a bounded sample (``MAX_TRAIN_ROWS`` vectors, chosen by the hash of the id) principal
   directions and a rotation are learned so that the signs of the rotated values are balanced
   codes; ``ROTATIONS`` starts give as many codes, joined.
3. The code is cut into substrings of about log2(vectors) bits, each an exact-match index on
   (label, table, substring). The longer the substring, the more tables there are: as many as
   let a pair at the bound share none with probability ``MISS`` (``table_count``). They are searched
   ``PASS_TABLES`` at a time, so that the shuffled vectors don't grow with their number.
4. Vectors that share a bucket are compared by cosine of the original values in double
   precision. A bucket beyond ``BLOCK`` rows is split into pairs of blocks, so no task holds a whole
   bucket. A pair counts in the first table that holds it, so nothing is counted twice
   and no list of pairs leaves a task: each vector sends its number of links and the least
   vector it is connected to inside the task.
5. Components are those of the whole link graph.

Every vector is indexed. A bit of two vectors at cosine c differs with probability acos(c)/pi, so at
any number of vectors a pair at the bound is missed 3 times in 1,000 at most if bits are
independent, and closer pairs less often. Recall against brute force is measured in the tests (1.0
on the given tables; also with the key length of 10 million vectors).

Defined cases: a null label, and a vector that is null, empty, zero, or holds a null or a
non-finite value, link with nothing; vectors of unlike length never link; repeated rows count
as copies; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import written
from .components import connected_components

COSINE = 0.93
MAX_TRAIN_ROWS = 20_000
#: Probability that a pair at the bound shares no table.
MISS = 0.003
LEAST_TABLES, PASS_TABLES = 24, 24
BITS_LOW, BITS_HIGH = 6, 30
ITERATIONS = 30
BLOCK = 1024
GROUP_ROWS = 20_000
SEED = 11


def table_count(bits: int, cosine: float) -> int:
    """Tables of ``bits`` bits after which a pair at ``cosine`` shares none with probability ``MISS`` at most."""
    shared = (1 - math.acos(cosine) / math.pi) ** bits
    return max(LEAST_TABLES, math.ceil(math.log(MISS) / math.log1p(-shared))) if shared < 1 else LEAST_TABLES


def usable(vector: str = "embedding") -> F.Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    nonzero = F.exists(vector, lambda x: x != 0)
    return F.coalesce(finite & nonzero, F.lit(False))


def learn_rotations(x: np.ndarray, count: int, seed: int = SEED) -> np.ndarray:
    """``count`` matrices (d x d) whose signs code a row; each is principal directions times a learned rotation."""
    d = x.shape[1]
    rng = np.random.default_rng(seed)
    _, axes = np.linalg.eigh(x.T @ x) if len(x) else (None, np.eye(d))
    y = x @ axes
    out = []
    for _ in range(count):
        r = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for _ in range(ITERATIONS if len(x) > d else 0):
            b = np.sign(y @ r)
            u, _, vt = np.linalg.svd(y.T @ b)
            r = u @ vt
        out.append(axes @ r)
    return np.concatenate(out, axis=1)


def _unit(rows: pd.Series) -> np.ndarray:
    x = np.stack(rows.to_numpy()).astype(np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def train(vectors: DataFrame, bits: int, total: int) -> dict[int, np.ndarray]:
    """The coding matrix of each vector length in the sample, with ``bits`` columns at least."""
    share = MAX_TRAIN_ROWS / max(total, 1)
    u = F.pmod(F.xxhash64("rep", F.lit(SEED).cast("long")), F.lit(1_000_000)) / 1_000_000.0
    sample = vectors.filter(u < share).select("rep", "embedding").toPandas().sort_values("rep")
    out = {}
    for d, rows in sample.groupby(sample["embedding"].map(len)):
        out[int(d)] = learn_rotations(_unit(rows["embedding"]), math.ceil(bits / d))[:, :bits]
    return out


def _keys(vectors: DataFrame, coding, bits: int, tables: int) -> DataFrame:
    """(rep, label, copies, vector bytes, dim, keys): the substring of each table as int."""

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = dict(coding.value)
        weights = (1 << np.arange(bits)).astype(np.int64)
        for pdf in parts:
            for d, rows in pdf.groupby(pdf["embedding"].map(len)):
                if d not in own:  # a length too rare for the sample: plain rotations
                    own[d] = learn_rotations(np.zeros((0, d)), math.ceil(bits * tables / d))[:, : bits * tables]
                x = _unit(rows["embedding"])
                code = (x @ own[d] > 0).reshape(len(x), tables, bits)
                yield pd.DataFrame({
                    "rep": rows["rep"], "label": rows["label"], "copies": rows["copies"], "dim": d,
                    "vector": [v.tobytes() for v in x], "keys": list((code * weights).sum(axis=2).astype(np.int32)),
                })

    return vectors.mapInPandas(work, "rep long, label string, copies long, dim int, vector binary, keys array<int>")


def _link_cells(pdf: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """Links among the rows of each cell: (rep, links, root).

    A cell is one bucket or one pair of blocks of it; across a pair only pairs of unlike blocks count.
    """
    pdf = pdf.sort_values(["cell", "rep"], kind="stable")
    cell, table = pdf["cell"].to_numpy(), pdf["table"].to_numpy()
    cross, block = pdf["cross"].to_numpy(), pdf["block"].to_numpy()
    dim = pdf["dim"].to_numpy()
    keys = np.stack(pdf["keys"].to_numpy())
    vectors = [np.frombuffer(v) for v in pdf["vector"]]
    starts = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    ends = np.append(starts[1:], len(cell))
    left, right = [], []
    for s, e in zip(starts[ends - starts > 1], ends[ends - starts > 1], strict=True):
        x = np.stack(vectors[s:e])
        near = np.triu(x @ x.T >= cosine, 1)
        if cross[s]:
            near &= block[s:e, None] != block[None, s:e]
        i, j = np.nonzero(near)
        left.append(i + s)
        right.append(j + s)
    n = len(pdf)
    i = np.concatenate(left) if left else np.zeros(0, dtype=np.int64)
    j = np.concatenate(right) if right else np.zeros(0, dtype=np.int64)
    root = np.arange(n)
    while True:  # least row reachable
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    first = np.ones(len(i), dtype=bool)
    for t in range(keys.shape[1]):
        first &= ~((keys[i, t] == keys[j, t]) & (t < table[i]))
    i, j = i[first], j[first]
    copies, rep = pdf["copies"].to_numpy(), pdf["rep"].to_numpy()
    links = np.bincount(i, copies[j], n) + np.bincount(j, copies[i], n)
    keep = (links > 0) | (root != np.arange(n))
    return pd.DataFrame({"rep": rep[keep], "links": links[keep].astype(np.int64), "root": rep[root[keep]]})


def _links(keyed: DataFrame, tables: range, cosine: float) -> DataFrame:
    """(rep, links, root) of the links whose first table is one of ``tables``."""
    own = F.slice("keys", tables.start + 1, len(tables))
    placed = keyed.select("rep", "label", "dim", F.posexplode(own).alias("table", "key")).withColumn("table", F.col("table") + tables.start)
    bucket = ["label", "dim", "table", "key"]
    sizes = placed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    shared = placed.join(sizes.withColumn("blocks", blocks).drop("n"), bucket).withColumn(
        "block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    )
    split = shared.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = split.select(
        "rep", "table", "block", (F.col("block") != F.col("other")).alias("_own"),
        F.xxhash64(*bucket, F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
        (F.col("block") != F.col("other")).alias("cross"),
    ).drop("_own")
    cells = written(cells, "cells")
    groups = max(1, math.ceil(cells.count() / GROUP_ROWS))
    dealt = cells.join(keyed.select("rep", "copies", "dim", "vector", "keys"), "rep").withColumn(
        "_group", F.pmod(F.col("cell"), F.lit(groups))
    )
    return written(
        dealt.groupBy("_group").applyInPandas(lambda pdf: _link_cells(pdf, cosine), "rep long, links long, root long"), "links"
    )


def near_vectors(embeddings: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings`` (vec_id, embedding, label)."""
    spark = embeddings.sparkSession
    rows = embeddings.select(
        "vec_id",
        F.col("label").cast("string").alias("label"),
        "embedding",
        (usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()).alias("_usable"),
        F.md5(F.to_json(F.struct("embedding"))).alias("_key"),
    )
    vectors = materialize(
        rows.filter("_usable").groupBy("label", "_key").agg(
            F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding")
        ),
        "vectors",
    )
    total = vectors.count()
    bits = min(BITS_HIGH, max(BITS_LOW, math.ceil(math.log2(max(total, 2))) - 3))
    tables = table_count(bits, cosine)
    coding = spark.sparkContext.broadcast(train(vectors, bits * tables, total))
    keyed = materialize(_keys(vectors.select("rep", "label", "copies", "embedding"), coding, bits, tables), "codes")
    parts = [_links(keyed, range(t, min(t + PASS_TABLES, tables)), cosine) for t in range(0, tables, PASS_TABLES)]
    linked = reduce(DataFrame.union, parts)
    counts = linked.groupBy("rep").agg(F.sum("links").alias("links"))
    components = connected_components(linked.select("rep", "root"))
    known = (
        vectors.select("label", "_key", "rep", "copies")
        .join(counts, "rep", "left")
        .join(components.withColumnRenamed("vertex", "rep"), "rep", "left")
        .select(
            F.col("label").alias("_label"), F.col("_key").alias("_vector"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    out = rows.drop("embedding").join(
        known, (F.col("label") == F.col("_label")) & (F.col("_key") == F.col("_vector")) & F.col("_usable"), "left"
    )
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
