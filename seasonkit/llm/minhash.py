"""Near-duplicate documents: improved consistent weighted sampling over TF-IDF shingles.

1. Equal texts are one text from here on (grouped by a 128-bit hash, least id in front).
2. The document frequency of every shingle (five words) is counted over all texts, hashed
   into ``IDF_BUCKETS`` counters as in hashed TF-IDF; partial counts leave each task once, and
   the counters, whose size is fixed, are broadcast.
3. A shingle weighs ``(1 + ln tf) * (1 + IDF_SHARE * ln((N + 1) / (df + 1)) / ln(N + 1))``. The idf
   part is kept small so that a large group of copies, which by itself makes the shared
   shingles frequent, does not pull the similarity of its members below the bound.
4. ``BANDS * ROWS`` samples of improved consistent weighted sampling per text: each sample
   is the same for two texts with a probability that equals their weighted Jaccard
   similarity. ``ROWS`` samples make a band; texts that share a band are candidates (at
   similarity 0.8 all bands miss one pair in 100,000, above it fewer).
5. In each band bucket the least text is the leader, and every other member is compared with
   it by exact weighted Jaccard similarity: pairs grow with the members, not their square. A
   second round does the same, under new leaders, for members not yet in their leader's class.
6. In buckets that still hold several classes, members outside the leader's class are held
   against all members of other classes, in blocks of ``BLOCK`` by ``BLOCK`` inside tasks: a pair is
   compared exactly only if ``NEAR_SAMPLES`` of its 48 samples agree (a pair at 0.8 fails this once
   in 20,000, above it more rarely) and its classes are not joined yet. A block sends the links
   that join classes, never its pairs.
7. Classes are the connected components of the verified links.

Texts are compared in tasks that Spark deals out by join; a hot leader's rows are split by
adaptive execution.

Defined cases: a null text is in a class of its own; texts without words are in one class
only when equal; repeated ids with one text are in one class and each row is returned; an
empty table gives no rows; rows with a null id are returned and kept; unlike texts under one
id count as one document; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import boxed, unboxed
from .components import connected_components
from .shingles import batches, distinct_shingles, mix, shingle_hashes

SIMILARITY = 0.8
BANDS, ROWS = 16, 3
IDF_BUCKETS = 1 << 20
SLICE_BUCKETS = 1 << 16
IDF_SHARE = 0.1
#: Agreeing samples of 48 that let a pair of two classes go on to the exact comparison.
NEAR_SAMPLES = 28
BLOCK = 256
#: Size of the tables of random draws; each sample combines four independent entries.
DRAWS = 1 << 14

_rng = np.random.default_rng(7)
_R = _rng.gamma(2.0, 1.0, DRAWS).astype(np.float32)
_LN_C = np.log(_rng.gamma(2.0, 1.0, DRAWS)).astype(np.float32)
_BETA = _rng.random(DRAWS, dtype=np.float32)
_SEEDS = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)


def _encoded(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "replace") for t in texts]


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes & np.uint64(buckets - 1)).astype(np.int64)


def document_frequencies(texts: DataFrame, buckets: int = IDF_BUCKETS) -> tuple[np.ndarray, int]:
    """(texts holding a shingle of each bucket, texts) over all rows of ``texts.text``.

    Counters travel as compressed slices of ``SLICE_BUCKETS``, added by slice before they reach the driver: a row a slice.
    """
    width = min(buckets, SLICE_BUCKETS)

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, n = np.zeros(buckets, dtype=np.int64), 0
        for pdf in parts:
            n += len(pdf)
            for a, b in batches(pdf["text"].map(len)):
                owner, hashes, _ = distinct_shingles(*shingle_hashes(_encoded(pdf["text"].iloc[a:b])))
                seen += np.bincount(_bucket(hashes, buckets), minlength=buckets)
        if n:
            cut = seen.reshape(-1, width)
            yield pd.DataFrame({"slice": np.arange(len(cut)), "n": n, "counts": [_squeezed(c) for c in cut]})

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(width, dtype=np.int64), 0
        for part in parts:
            n += int(part["n"].sum())
            for c in part["counts"]:
                total += _spread(c, width)
        yield pd.DataFrame({"slice": [key[0]], "n": [n], "counts": [_squeezed(total)]})

    schema = "slice long, n long, counts binary"
    df, n = np.zeros((buckets // width, width), dtype=np.int64), 0
    for row in texts.select("text").mapInPandas(count, schema).groupBy("slice").applyInPandas(add, schema).collect():
        df[row["slice"]], n = _spread(bytes(row["counts"]), width), row["n"]
    return df.ravel(), n


def _squeezed(counts: np.ndarray) -> bytes:
    return pa.compress(counts.tobytes(), codec="zstd", asbytes=True)


def _spread(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=8 * width, codec="zstd", asbytes=True), dtype=np.int64)


def idf_weights(df: np.ndarray, n: int, share: float = IDF_SHARE) -> np.ndarray:
    return (1 + share * np.log((n + 1) / (np.minimum(df, n) + 1)) / np.log(n + 2)).astype(np.float32)


def weighted_shingles(docs: list[bytes], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, weight), sorted by text, then shingle."""
    owner, hashes, times = distinct_shingles(*shingle_hashes(docs))
    return owner, hashes, (1 + np.log(times)).astype(np.float32) * idf[_bucket(hashes, len(idf))]


def samples(owner: np.ndarray, hashes: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """``n`` consistent weighted samples of each text that has shingles, one row per text."""
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
    sizes = np.diff(np.append(starts, len(owner)))
    ln_w = np.log(weights)
    out = np.empty((len(starts), n), dtype=np.uint64)
    low = np.uint64(DRAWS - 1)
    for i in range(n):
        h = hashes * (_SEEDS[i] | np.uint64(1))  # hashes are mixed already; the upper bits are used
        r = _R[h >> np.uint64(50)]
        beta = _BETA[(h >> np.uint64(36)) & low]
        ln_c = _LN_C[(h >> np.uint64(22)) & low]
        t = np.floor(ln_w / r + beta)
        a = ln_c - r * (t - beta + 1)
        least = np.minimum.reduceat(a, starts)
        hit = np.flatnonzero(a == np.repeat(least, sizes))
        # the first of equal ones: shingles are sorted, so copies of a text agree
        text = np.searchsorted(starts, hit, side="right") - 1
        first = np.append(True, text[1:] != text[:-1])
        at = hit[first]
        out[:, i] = mix(hashes[at] ^ (t[at].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return out


def band_hashes(drawn: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(drawn), bands), dtype=np.uint64)
    for b in range(bands):
        for j in range(rows):
            out[:, b] = mix(out[:, b] * np.uint64(31) + drawn[:, b * rows + j] + np.uint64(b))
    return out.view(np.int64)


def _signed(texts: DataFrame, idf, bands: int, rows: int) -> DataFrame:
    """(rep, buckets, samples) of every text with words; a bucket's hash holds its band.

    ``samples`` keeps 16 bits of each sample.
    """

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            ids = pdf["rep"].to_numpy()
            for a, b in batches(pdf["text"].map(len)):
                owner, hashes, weights = weighted_shingles(_encoded(pdf["text"].iloc[a:b]), idf.value)
                if not len(owner):
                    continue
                drawn = samples(owner, hashes, weights, bands * rows)
                yield pd.DataFrame({
                    "rep": ids[a:b][np.unique(owner)],
                    "buckets": list(band_hashes(drawn, bands, rows)),
                    "samples": [x.tobytes() for x in drawn.astype(np.uint16)],
                })

    return texts.select("rep", "text").mapInPandas(work, "rep long, buckets array<long>, samples binary")


def weighted_jaccard(left: list[bytes], right: list[bytes], idf: np.ndarray) -> np.ndarray:
    """Weighted Jaccard similarity of each pair of texts; 0 where one has no words."""
    n = len(left)
    owner, hashes, weights = weighted_shingles([*left, *right], idf)
    side, pair = owner >= n, owner % n
    order = np.lexsort((hashes, pair))
    pair, hashes, weights = pair[order], hashes[order], weights[order].astype(np.float64)
    same = np.flatnonzero((pair[1:] == pair[:-1]) & (hashes[1:] == hashes[:-1]))
    total = np.bincount(pair, weights, n)
    low = np.bincount(pair[same], np.minimum(weights[same], weights[same + 1]), n)
    return np.divide(low, total - low, out=np.zeros(n), where=total > 0)


def _compared(pairs: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """(a, b, similarity) of each pair of representatives."""

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for s, e in batches(pdf["text_a"].map(len) + pdf["text_b"].map(len)):
                left, right = _encoded(pdf["text_a"].iloc[s:e]), _encoded(pdf["text_b"].iloc[s:e])
                yield pd.DataFrame({
                    "a": pdf["a"].to_numpy()[s:e], "b": pdf["b"].to_numpy()[s:e],
                    "similarity": weighted_jaccard(left, right, idf.value),
                })

    text = texts.select("rep", "text")
    both = pairs.join(text.toDF("b", "text_b"), "b").join(text.toDF("a", "text_a"), "a")
    return both.select("a", "b", "text_a", "text_b").mapInPandas(work, "a long, b long, similarity double")


def _merged(x: pd.DataFrame, y: pd.DataFrame, bucket: int, idf: np.ndarray, near: int, similarity: float) -> list[tuple[int, int]]:
    """Links between members of ``x`` and of ``y`` that join two classes, by exact similarity.

    A pair that shares several buckets is looked at in the bucket of its first common band.
    """
    samples_of = lambda p: np.frombuffer(b"".join(p["samples"]), dtype=np.uint16).reshape(len(p), -1)
    sx, sy, bx, by = samples_of(x), samples_of(y), np.stack(x["buckets"].to_numpy()), np.stack(y["buckets"].to_numpy())
    agree = np.zeros((len(x), len(y)), dtype=np.int16)
    for k in range(sx.shape[1]):
        agree += sx[:, k, None] == sy[None, :, k]
    cx, cy = x["class_b"].to_numpy(), y["class_b"].to_numpy()
    i, j = np.nonzero((agree >= near) & (cx[:, None] != cy[None, :]))
    same = bx[i] == by[j]
    here = bx[i, same.argmax(axis=1)] == bucket
    i, j = i[here], j[here]
    order = np.argsort(-agree[i, j], kind="stable")
    of: dict[int, int] = {}  # union of classes

    def find(c: int) -> int:
        while of.setdefault(c, c) != c:
            of[c] = c = of[of[c]]
        return c

    parts: dict[tuple[bool, int], tuple[np.ndarray, np.ndarray, float]] = {}

    def shingled(left: bool, k: int) -> tuple[np.ndarray, np.ndarray, float]:
        if (left, k) not in parts:
            _, hashes, weights = weighted_shingles([(x if left else y)["text"].iat[k].encode("utf-8", "replace")], idf)
            parts[left, k] = hashes, weights.astype(np.float64), float(weights.sum(dtype=np.float64))
        return parts[left, k]

    links = []
    for a, b in zip(i[order].tolist(), j[order].tolist(), strict=True):
        if (ca := find(int(cx[a]))) == (cb := find(int(cy[b]))):
            continue
        (ha, wa, ta), (hb, wb, tb) = shingled(True, a), shingled(False, b)
        at = np.minimum(np.searchsorted(hb, ha), len(hb) - 1)
        low = np.minimum(wa, wb[at])[hb[at] == ha].sum()
        if low >= similarity * (ta + tb - low):
            of[ca] = cb
            links.append((int(x["b"].iat[a]), int(y["b"].iat[b])))
    return links


def _across_classes(members: DataFrame, signed: DataFrame, texts: DataFrame, idf, near: int, similarity: float) -> DataFrame:
    """(a, b): links between members of one bucket that are of two classes, enough to connect them.

    ``members``: (bucket, a, b, class_a, class_b), b a member and a its leader.
    """
    sizes = members.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("m"), F.count_if(F.col("class_a") != F.col("class_b")).alias("f")
    )
    mixed = members.join(sizes.filter("f > 1 OR (f > 0 AND m > 2)"), "bucket").join(signed.withColumnRenamed("rep", "b"), "b")
    mixed = mixed.join(texts.select(F.col("rep").alias("b"), "text"), "b").withColumn("f_own", F.col("class_a") != F.col("class_b"))
    blocks = lambda n: F.ceil(F.col(n) / F.lit(BLOCK)).cast("int")
    deal = lambda n, salt: F.pmod(F.xxhash64("b", F.lit(salt)), F.col(n)).cast("int")
    mixed = mixed.withColumns({"bf": blocks("f"), "bm": blocks("m")})
    columns = ["bucket", "b", "class_b", "samples", "buckets", "text"]
    one = mixed.filter("bm = 1").select(*columns, F.col("f_own").alias("x"), F.lit(True).alias("y"), F.lit(0).alias("i"), F.lit(0).alias("j"))
    many = mixed.filter("bm > 1")
    left = many.filter("f_own").select(
        *columns, F.lit(True).alias("x"), F.lit(False).alias("y"),
        deal("bf", 1).alias("i"), F.explode(F.sequence(F.lit(0), F.col("bm") - 1)).alias("j"),
    )
    right = many.select(
        *columns, F.lit(False).alias("x"), F.lit(True).alias("y"),
        F.explode(F.sequence(F.lit(0), F.col("bf") - 1)).alias("i"), deal("bm", 2).alias("j"),
    )

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf[pdf["x"]], pdf[pdf["y"]]
        links = _merged(x, y, int(pdf["bucket"].iat[0]), idf.value, near, similarity) if len(x) and len(y) else []
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return one.unionByName(left).unionByName(right).groupBy("bucket", "i", "j").applyInPandas(work, "a long, b long")


def verified_links(texts: DataFrame, idf, similarity: float, bands: int, rows: int) -> DataFrame:
    """(a, b) with weighted Jaccard of at least ``similarity``, enough of them to connect every
    class: steps 4 to 6 of the module's text."""
    signed = materialize(_signed(texts, idf, bands, rows), "signed")
    members = signed.select("rep", F.explode("buckets").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    at = materialize(members.join(shared.select("bucket", "a"), "bucket").withColumnRenamed("rep", "b"), "members")
    links, compared = None, None

    def verify(pairs: DataFrame) -> None:
        nonlocal links, compared
        fresh = pairs if compared is None else pairs.join(compared, ["a", "b"], "left_anti")
        done = materialize(_compared(fresh, texts, idf), "compared")
        compared = done.select("a", "b") if compared is None else compared.union(done.select("a", "b"))
        near = done.filter(F.col("similarity") >= similarity).select("a", "b")
        links = near if links is None else links.union(near)

    def with_classes() -> DataFrame:
        found = connected_components(links)
        for side in ("a", "b"):
            known = found.select(F.col("vertex").alias(side), F.col("component").alias(f"class_{side}"))
            joined = (at if side == "a" else classed).join(known, side, "left")
            classed = joined.withColumn(f"class_{side}", F.coalesce(f"class_{side}", side))
        return materialize(classed, "classed")

    verify(at.filter("a <> b").select("a", "b").distinct())
    classed = with_classes()
    # the second leader of a bucket: the least member outside the first one's class
    second = classed.filter("class_a <> class_b").groupBy("bucket").agg(F.min("b").alias("second"), F.count(F.lit(1)).alias("n"))
    again = classed.filter("class_a <> class_b").join(second.filter("n > 1"), "bucket").filter("b <> second")
    verify(again.select(F.col("second").alias("a"), "b").distinct())
    near = NEAR_SAMPLES * bands * rows // (BANDS * ROWS)
    return links.union(materialize(_across_classes(with_classes(), signed, texts, idf, near, similarity), "across"))


def near_duplicates(
    docs: DataFrame,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    idf_share: float = IDF_SHARE,
) -> DataFrame:
    """doc_id, class_id (least id of the class), copies (documents with the very same text),
    kept (the class's first document) for every row of ``docs``."""
    spark = docs.sparkSession
    keyed = docs.select("doc_id", "text", F.md5(F.encode("text", "UTF-8")).alias("_key"))
    groups = materialize(
        keyed.filter("text IS NOT NULL").groupBy("_key").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies")),
        "texts",
    )
    texts = docs.filter("text IS NOT NULL").select(F.col("doc_id").alias("rep"), "text")
    reps = groups.select("rep").filter("rep IS NOT NULL")
    texts = texts.join(reps.distinct(), "rep", "left_semi")
    df, n = document_frequencies(docs.filter("text IS NOT NULL"))
    idf = spark.sparkContext.broadcast(idf_weights(df, n, idf_share))
    links = verified_links(texts, idf, similarity, bands, rows)
    classes = connected_components(links)
    classed = (
        groups.join(classes.withColumnRenamed("vertex", "rep"), "rep", "left")
        .select("_key", F.coalesce("component", "rep").alias("class_id"), "copies")
    )
    out = keyed.drop("text").join(classed, "_key", "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("copies"),
    )
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def drop_near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The first document of every class, with its columns as they came."""
    kept = near_duplicates(docs, similarity).filter("kept").select(F.col("doc_id").alias("_kept")).distinct()
    return unboxed(boxed(docs, "doc_id").join(kept, F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi"))
