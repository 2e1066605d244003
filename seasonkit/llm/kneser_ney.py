"""Quality by perplexity: an interpolated modified Kneser-Ney bigram model of trusted text.

The units are the words of ``words.words``; the border of a text is a word before its first one and after
its last one. Every table grows with the input and is kept in shards: words and pairs of
words are 64-bit keys, and no table of them reaches the driver or is broadcast whole.

1. Trusted texts have label quality 1 and an id that is not held out. A quarter of them (by id) sets
   the high thresholds, since a model knows the texts that it has counted too well; the others are
   counted. Tasks count the pairs of those; Spark sums
   the counts by pair. Followers and continuation counts of each word are aggregations of them.
2. Joins of pairs and words give the discounted probabilities. The log probability of a word after
   another is written as a sum of weights of keys, so that one join by key is enough::

       log p(w | v) = unknown + weight(w as predicted) + weight(v as context) + weight(v, w)

   where keys without trusted text weigh nothing. The last weight is the log of p(w | v)
   over its share by interpolation alone.
3. Texts send (key, text, count) to the shard of the key, where the model's weights meet them; a block of texts sends each
   shard one packed row and gets one back, whose sums are added to the block's. This is done in ``ROUNDS`` slices of the keys, each written when done, so that
   the shuffles of one slice alone stand on disk at a time.
4. A language's thresholds are quantiles of the perplexities of its trusted texts: the high one of those
   that were not counted, the low one of all, so that no counted text is taken for a repetitive one.
   Texts above the high one are unlike trusted text, texts below the low one repeat common pairs.

Skew: a word or pair with more than ``SHARE`` of all words of the documents is found by a counting
pass over all of them. There are at most 2 / SHARE such keys; their weights are broadcast and
applied where the text is, so no shard gathers a hot key. Equal texts of one language share one key, and their
sums and lengths grow alike, so the perplexity stays right and copies need no rows of their own.

Counts and statistics cover all counted rows, quantiles all trusted rows named above.

Defined cases: a null or empty text has no words, a null perplexity, and is not kept; a
null language is read as an empty one; a language without counted text is judged by the
model of all languages together, one without quantiles by theirs; without any counted text perplexities are
null, and without them or quantiles everything with a word is kept; repeated rows get a result each; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_side, written
from .toxicity import held_out
from .words import mix, words

ROUNDS = 4
BLOCK_CHARS = 1 << 23
SHARE = 2.0**-15
SHARD_ENTRIES = 1_000_000
#: log2 of the counters that a block's keys are hashed into before the frequent ones are sorted.
COUNTERS = 20
LEAST_SHARDS = 12
LOW_QUANTILE, HIGH_QUANTILE = 0.005, 0.99
BROADCAST_ROWS = 1_000_000
POOLED = 0
_BORDER = np.uint64(1)


class Block:
    """Word keys of some texts. ``doc`` is the text of each key, ``pair`` the key with the one after it."""

    def __init__(self, rid: list[int], seed: list[int], texts: list[str]):
        self.rid = np.array(rid, dtype=np.int64)
        self.seed = np.array(seed, dtype=np.int64)
        h, doc = words(texts)
        first = np.flatnonzero(np.diff(doc, prepend=-1))
        border = first + np.arange(len(first))
        self.doc = np.insert(doc, first, doc[first])
        self.key = mix(np.insert(h, first, _BORDER) ^ self.seed.view(np.uint64)[self.doc])
        self.next = np.roll(self.key, -1)
        if len(border):
            self.next[np.append(border[1:], len(self.key)) - 1] = self.key[border]
        self.pair = (self.key << np.uint64(1) | self.key >> np.uint64(63)) ^ self.next


def blocks(parts: Iterator[pd.DataFrame]) -> Iterator[Block]:
    rows, size = ([], [], []), 0
    for pdf in parts:
        for row in zip(pdf["rid"], pdf["seed"], pdf["text"], strict=True):
            for column, x in zip(rows, row, strict=True):
                column.append(x)
            size += len(row[2])
            if size >= BLOCK_CHARS:
                yield Block(*rows)
                rows, size = ([], [], []), 0
    if rows[0]:
        yield Block(*rows)


def pair_key(v: Column, w: Column) -> Column:
    return F.shiftleft(v, 1).bitwiseOR(F.shiftrightunsigned(v, 63)).bitwiseXOR(w)


def count_pairs(trusted: DataFrame) -> DataFrame:
    """(seed, v, w, c) over all rows of ``trusted`` (rid, seed, text), written slice by slice."""
    out = []
    for r in range(ROUNDS):

        def work(parts: Iterator[pd.DataFrame], r=r) -> Iterator[pd.DataFrame]:
            for b in blocks(parts):
                here = np.flatnonzero(b.pair % np.uint64(ROUNDS) == r)
                _, at, c = np.unique(b.pair[here], return_index=True, return_counts=True)
                at = here[at]
                v, w = b.key[at].view(np.int64), b.next[at].view(np.int64)
                yield pd.DataFrame({"seed": b.seed[b.doc[at]], "v": v, "w": w, "c": c})

        counted = trusted.mapInPandas(work, "seed long, v long, w long, c long")
        out.append(written(counted.groupBy("seed", "v", "w").agg(F.sum("c").alias("c")), "pairs"))
    return _union(out)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _discounts(prefix: str) -> list[Column]:
    """Discounts of counts 1, 2 and 3 or more, from the numbers of keys counted once to four times."""
    n = [F.col(f"{prefix}{k}").cast("double") for k in range(5)]
    y = F.when(n[1] > 0, n[1] / (n[1] + 2 * n[2])).otherwise(F.lit(0.5))

    def discount(k: int) -> Column:
        d = F.when(n[k] > 0, k - (k + 1) * y * n[k + 1] / n[k])
        return F.when(d > 0, F.least(d, F.lit(float(k)))).otherwise(F.lit(0.5 * k))

    return [discount(k) for k in (1, 2, 3)]


def _of(c: Column, d: list[Column]) -> Column:
    return F.when(c == 1, d[0]).when(c == 2, d[1]).otherwise(d[2])


def _times(column: str, prefix: str) -> list[Column]:
    return [F.count_if(F.col(column) == k).alias(f"{prefix}{k}") for k in range(5)]


class Weights(NamedTuple):
    """(key, weight) of the words, and of the pairs by slice of their keys."""

    of_words: DataFrame
    of_pairs: list[DataFrame]

    def slice(self, r: int) -> DataFrame:
        return self.of_words.filter(F.col("key").bitwiseAND(ROUNDS - 1) == r).unionByName(self.of_pairs[r])


def build_model(pairs: DataFrame) -> tuple[Weights, DataFrame]:
    """Of (seed, v, w, c): the weights and, by seed, the log probability of an unknown word."""
    follows = pairs.groupBy("seed", F.col("v").alias("key")).agg(
        F.sum("c").alias("total"), F.count_if(F.col("c") == 1).alias("f1"), F.count_if(F.col("c") == 2).alias("f2"),
        F.count_if(F.col("c") > 2).alias("f3"),
    )
    before = pairs.groupBy(F.col("w").alias("key")).agg(F.count(F.lit(1)).alias("k"))
    types = written(follows.join(before, "key"), "types")
    of_pairs = pairs.groupBy("seed").agg(*_times("c", "p"))
    of_types = types.groupBy("seed").agg(
        *_times("k", "t"), F.sum("k").alias("all_k"), F.count(F.lit(1)).alias("size"),
        F.count_if(F.col("k") > 2).alias("more"),
    )
    d, t = _discounts("p"), _discounts("t")
    held = (t[0] * F.col("t1") + t[1] * F.col("t2") + t[2] * F.col("more")) / F.col("all_k")
    stats = of_pairs.join(of_types, "seed").select(
        "seed", "all_k", *[x.alias(f"d{i}") for i, x in enumerate(d)], *[x.alias(f"e{i}") for i, x in enumerate(t)],
        F.log(held / (F.col("size") + 1)).alias("unknown"),
    )
    stats = written(stats, "model-stats")  # a row for each language
    languages = stats.count()
    d, t = ([F.col(f"{x}{i}") for i in range(3)] for x in "de")
    types = types.join(small_side(stats, languages, BROADCAST_ROWS), "seed")
    seen = (F.col("k") - _of(F.col("k"), t)) / F.col("all_k") + F.exp("unknown")
    gamma = (d[0] * F.col("f1") + d[1] * F.col("f2") + d[2] * F.col("f3")) / F.col("total")
    types = types.select("key", "total", "unknown", F.log(seen).alias("alone"), F.log(gamma).alias("back"))
    types = written(types, "word-weights")
    of_words = types.select("key", (F.col("alone") - F.col("unknown") + F.col("back")).cast("float").alias("weight"))
    of_pairs = []
    v = types.select(F.col("key").alias("v"), "total", "back")
    w = types.select(F.col("key").alias("w"), "alone")
    for r in range(ROUNDS):
        own = pairs.filter(pair_key(F.col("v"), F.col("w")).bitwiseAND(ROUNDS - 1) == r)
        own = own.join(small_side(stats.select("seed", "d0", "d1", "d2"), languages, BROADCAST_ROWS), "seed")
        own = own.select("v", "w", (F.col("c") - _of(F.col("c"), d)).alias("kept")).join(v, "v")
        own = own.select("v", "w", (F.col("kept") / F.col("total")).alias("alpha"), "back").join(w, "w")
        share = F.exp(F.col("back") + F.col("alone"))
        gain = F.log1p(F.col("alpha") / share).cast("float")
        of_pairs.append(written(own.select(pair_key(F.col("v"), F.col("w")).alias("key"), gain.alias("weight")), "pair-weights"))
    return Weights(of_words, of_pairs), stats.select("seed", "unknown")


def frequent_keys(texts: DataFrame) -> tuple[DataFrame, int]:
    """Words and pairs with more than about ``SHARE`` of all words of ``texts``, and the number of all words.

    A block sends the keys that have SHARE of its own words (at least 4 times). A key with
    2 * SHARE of all words has more than SHARE of them in blocks that send it; at most
    2 / SHARE keys (words and pairs) pass.
    """

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in blocks(parts):
            yield pd.DataFrame({"key": [None], "c": [len(b.key)]}, dtype="Int64")
            for keys in (b.key, b.pair):
                # keys that share a counter below the bound are below it themselves: only the others are sorted
                at = (keys >> np.uint64(64 - COUNTERS)).astype(np.int64)
                least = max(4, SHARE * len(keys))
                u, c = np.unique(keys[np.bincount(at, minlength=1 << COUNTERS)[at] >= least], return_counts=True)
                often = c >= least
                yield pd.DataFrame({"key": u[often].view(np.int64), "c": c[often]})

    sums = texts.mapInPandas(work, "key long, c long").groupBy("key").agg(F.sum("c").alias("c"))
    sums = written(sums, "frequent")
    row = sums.filter("key IS NULL").first()
    total = row["c"] if row else 0
    return sums.filter(F.col("key").isNotNull() & (F.col("c") >= SHARE * total)).select("key"), total


def _packed(x: np.ndarray) -> bytes:
    """Bytes of like weight together, compressed; the length is put in front."""
    planes = x.view(np.uint8).reshape(-1, x.dtype.itemsize).T
    return x.nbytes.to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, kind: type) -> np.ndarray:
    got = pa.decompress(raw[8:], decompressed_size=int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(got, dtype=np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


#: Of a block for a shard: the texts that ask (numbers within the block), their keys, the text of each key and how often it has it.
_ASKED = ("block", "shard", "used", "key", "doc", "times")
#: Of a block for itself, by way of any shard: its texts, the sums of their frequent keys, their lengths, how many they are.
_OWN = ("block", "shard", "rid", "total", "n", "copies")
_SENT = "block long, shard int, used binary, key binary, doc binary, times binary, rid binary, total binary, n binary, copies binary"
#: Of a shard for a block: the sums of the texts that asked and have any; and what the block sent for itself.
_ANSWER = "block long, used binary, rid binary, total binary, n binary, copies binary"


def _block_id(b: Block) -> int:
    """The hash of the block's texts: blocks of equal texts may share it, as their sums are added in the end anyway."""
    return int.from_bytes(hashlib.blake2b(b.rid.tobytes(), digest_size=8).digest(), "little", signed=True)


def _requests(b: Block, r: int, shards: int, often: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, pd.DataFrame]:
    """(the summed weights of each text's frequent keys, the other keys of slice ``r`` by shard)."""
    held, left = np.zeros(len(b.rid)), []
    for keys in (b.key, b.pair):
        here = np.flatnonzero(keys % np.uint64(ROUNDS) == r)
        key, doc = keys[here], b.doc[here]
        if len(often):
            at = np.minimum(np.searchsorted(often, key), len(often) - 1)
            hit = often[at] == key
            held += np.bincount(doc[hit], weight[at[hit]], len(held))
            key, doc = key[~hit], doc[~hit]
        left.append((key, doc))
    key, doc = (np.concatenate(x) for x in zip(*left, strict=True))
    order = np.argsort(key, kind="stable")  # shards are ranges of the key
    key, doc = key[order], doc[order].astype(np.uint32)
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]))) if len(key) else np.zeros(0, int)
    times = np.diff(np.append(first, len(key))).astype(np.uint32)
    key, doc = key[first], doc[first]
    shard = (key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    edges = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, dtype=np.int64)
    block, rows = _block_id(b), []
    for lo, hi in zip(edges, np.append(edges[1:], len(shard)), strict=True):
        used, at = np.unique(doc[lo:hi], return_inverse=True)
        gaps = np.diff(key[lo:hi], prepend=np.uint64(0))
        rows.append((block, int(shard[lo]), *map(_packed, (np.diff(used, prepend=np.uint32(0)), gaps, at.astype(np.uint32), times[lo:hi]))))
    return held, pd.DataFrame(rows, columns=_ASKED).assign(rid=None, total=None, n=None, copies=None)


def _own(b: Block, r: int, held: np.ndarray, shards: int) -> pd.DataFrame:
    n = np.bincount(b.doc, minlength=len(b.rid)) if r == 0 else np.zeros(len(b.rid), dtype=np.int64)
    copies = np.full(len(b.rid), int(r == 0), dtype=np.int64)
    block = _block_id(b)
    row = (block, block % shards, *map(_packed, (b.rid, held, n, copies)))
    return pd.DataFrame([row], columns=_OWN).assign(used=None, key=None, doc=None, times=None)


def _answers(model: pd.DataFrame, sent: pd.DataFrame) -> pd.DataFrame:
    """One row a block that asked the shard, whatever the number of its texts."""
    key = model["key"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(key)
    key, weight = key[order], model["weight"].to_numpy(dtype=np.float64)[order]
    out = []
    for row in sent.itertuples(index=False):
        if row.key is None:
            out.append((row.block, None, row.rid, row.total, row.n, row.copies))
        elif len(key):
            asked = np.cumsum(_unpacked(row.key, np.uint64))
            used = np.cumsum(_unpacked(row.used, np.uint32), dtype=np.uint32)
            at = np.minimum(np.searchsorted(key, asked), len(key) - 1)
            gain = np.where(key[at] == asked, weight[at], 0.0) * _unpacked(row.times, np.uint32)
            total = np.bincount(_unpacked(row.doc, np.uint32), gain, len(used))
            some = np.flatnonzero(total)
            if len(some):
                out.append((row.block, _packed(np.diff(used[some], prepend=np.uint32(0))), None, _packed(total[some]), None, None))
    return pd.DataFrame(out, columns=[x.split()[0] for x in _ANSWER.split(", ")])


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    """(rid, total, n, copies) of one block: at most the texts of ``BLOCK_CHARS`` characters."""
    mine = [row for row in rows.itertuples(index=False) if row.rid is not None]
    rid = _unpacked(mine[0].rid, np.int64)
    total, n, copies = np.zeros(len(rid)), np.zeros(len(rid), dtype=np.int64), np.zeros(len(rid), dtype=np.int64)
    for row in mine:
        total += _unpacked(row.total, np.float64)
        n += _unpacked(row.n, np.int64)
        copies += _unpacked(row.copies, np.int64)
    for row in rows.itertuples(index=False):
        if row.used is not None:
            total[np.cumsum(_unpacked(row.used, np.uint32), dtype=np.uint32)] += _unpacked(row.total, np.float64)
    out = pd.DataFrame({"rid": rid, "total": total, "n": n, "copies": copies})
    return out.groupby("rid", as_index=False).sum()


def score(texts: DataFrame, weights: Weights) -> DataFrame:
    """(rid, total, n, copies) over all rows of ``texts`` (rid, seed, text): log weights and keys of equal texts."""
    often, total = frequent_keys(texts)
    # at most 2 / SHARE keys
    found = _union([weights.of_words, *weights.of_pairs]).join(F.broadcast(often), "key").toPandas()
    known = set(found["key"])
    rest = [k for (k,) in often.collect() if k not in known]
    keys = np.array([*found["key"], *rest], dtype=np.int64).view(np.uint64)
    order = np.argsort(keys)
    held = texts.sparkSession.sparkContext.broadcast(
        (keys[order], np.append(found["weight"].to_numpy(dtype=np.float64), np.zeros(len(rest)))[order])
    )
    shards = max(LEAST_SHARDS, -(-2 * total // (ROUNDS * SHARD_ENTRIES)))
    shard = F.shiftright(F.shiftrightunsigned("key", 32) * shards, 32).cast("int").alias("shard")
    out = []
    for r in range(ROUNDS):

        def work(parts: Iterator[pd.DataFrame], r=r) -> Iterator[pd.DataFrame]:
            for b in blocks(parts):
                held_here, rows = _requests(b, r, shards, *held.value)
                yield rows
                yield _own(b, r, held_here, shards)[rows.columns]

        sent = texts.mapInPandas(work, _SENT)
        own = weights.slice(r).select("key", "weight", shard)
        answers = own.groupBy("shard").cogroup(sent.groupBy("shard")).applyInPandas(_answers, _ANSWER)
        sums = answers.groupBy("block").applyInPandas(_summed, "rid long, total double, n long, copies long")
        out.append(written(sums, "text-sums"))
    return _union(out).groupBy("rid").agg(*[F.sum(c).alias(c) for c in ("total", "n", "copies")])


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, n_words, perplexity, low, high, kept for every row of ``docs``."""
    known = (
        labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .select(F.col("doc_id").alias("_trusted"), (F.crc32(F.col("doc_id").cast("string")) % 5 == 1).alias("_sets"))
        .distinct()
    )
    known = small_side(known, known.count(), BROADCAST_ROWS)
    docs = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("text", F.lit("")).alias("text")
    )
    is_trusted = F.col("doc_id") == F.col("_trusted")
    trusted = docs.join(known.filter("NOT _sets"), is_trusted, "left_semi")
    languages = written(trusted.filter("text != ''").select(F.col("lang").alias("_lang")).distinct(), "languages")
    languages = small_side(languages, languages.count(), BROADCAST_ROWS)
    marked = docs.join(languages, F.col("lang") == F.col("_lang"), "left")
    seed = F.when(F.col("_lang").isNotNull(), F.xxhash64("lang")).otherwise(F.lit(POOLED).cast("long"))
    marked = marked.select("doc_id", "lang", seed.alias("seed"), "text", F.xxhash64(seed, "text").alias("rid"))
    own = trusted.select(F.lit(0).cast("long").alias("rid"), F.xxhash64("lang").alias("seed"), "text")
    if marked.filter(F.col("seed") == POOLED).head(1):  # a language without trusted text
        own = own.unionByName(own.withColumn("seed", F.lit(POOLED).cast("long")))
    weights, stats = build_model(count_pairs(own))
    sums = score(marked.select("rid", "seed", "text"), weights)
    n = F.coalesce(F.col("n") / F.col("copies") - 1, F.lit(0)).cast("long")
    rows = marked.select("doc_id", "lang", "seed", "rid").join(sums, "rid", "left").join(small_side(stats, stats.count(), BROADCAST_ROWS), "seed", "left")
    rows = rows.withColumn("perplexity", F.when(F.col("n") > 0, F.exp(-(F.col("total") / F.col("n") + F.col("unknown")))))
    rows = rows.select("doc_id", "lang", F.greatest(n, F.lit(0)).alias("n_words"), "perplexity")
    rows = rows.join(known, is_trusted, "left")
    scored = written(rows, "perplexities")
    bounds = lambda *key: scored.filter("_trusted IS NOT NULL AND perplexity IS NOT NULL").groupBy(*key).agg(
        F.percentile_approx("perplexity", F.lit(LOW_QUANTILE), F.lit(10_000)).alias("low"),
        F.percentile_approx(F.expr("CASE WHEN _sets THEN perplexity END"), F.lit(HIGH_QUANTILE), F.lit(10_000)).alias("high"),
    )
    pooled = bounds().first()
    by_language = written(bounds("lang"), "quantiles")
    judged = scored.join(small_side(by_language, by_language.count(), BROADCAST_ROWS), "lang", "left")
    low, high = (F.coalesce(F.col(c), F.lit(pooled[c]).cast("double")) for c in ("low", "high"))
    inside = F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return judged.select("doc_id", "lang", "n_words", "perplexity", low.alias("low"), high.alias("high")).withColumn(
        "kept", inside & (F.col("n_words") > 0)
    )
