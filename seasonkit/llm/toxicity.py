"""Toxicity: a factorization machine over hashed terms.

Every text becomes the set of its lower-cased words and their stems, hashed into ``n_features`` buckets. The
factorization machine has a weight for each bucket and an inner product of two factor
vectors for each pair of buckets, so a pair of terms can count as toxic where neither
alone does. It is fitted by Spark ML on a bounded sample of the labelled rows
(``max_train_rows``, chosen by the hash of the document id, the rarer class first) and
applied to every row. Where the classes are sampled at unlike rates, the odds of a score are divided by
the ratio of the rates, so that scores stand for the labelled rows and not for the sample.

A document id whose CRC-32 (of its decimal text) is divisible by five is held out: its
label is never read. Labels, language, source and id are never inputs of a score.

Defined cases: a null or empty text has no term and is scored by the intercept alone; a
null id is in the training part but has no label; rows with a null label, and ids with
two unlike labels, are not trained on; one class only, or no labelled row at all, gives
every text the share of the class (0 without rows); repeated rows are scored each.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import FMClassificationModel, FMClassifier
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, unboxed

N_FEATURES = 1 << 16
FACTORS = 4
MAX_TRAIN_ROWS = 40_000
#: The sample is bounded, so are its parts; each part sends one gradient per iteration.
TRAIN_PARTITIONS = 6
MAX_ITER = 60
STEP = 0.05
REG = 1e-4
SEED = 17
#: Letters of a stem: families of words share them.
STEM = 4


class Fitted(NamedTuple):
    """A machine, or the share of the class, and the sampling rate of toxic rows over that of the others."""

    model: FMClassificationModel | float
    ratio: float = 1.0


def held_out(doc_id: Column) -> Column:
    """True where CRC-32 of the id as text is divisible by five; null ids are not."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def terms(text: Column) -> Column:
    """The distinct lower-cased words (runs of letters and digits) of a text, and the stems
    of the longer ones: their first ``STEM`` letters, marked by a star."""
    words = F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"))
    stems = F.transform(
        F.filter(words, lambda w: F.char_length(w) > STEM), lambda w: F.concat(F.substring(w, 1, STEM), F.lit("*"))
    )
    return F.array_remove(F.concat(words, F.array_distinct(stems)), "")


def _hashed(df: DataFrame, n_features: int) -> DataFrame:
    tf = HashingTF(numFeatures=n_features, inputCol="_terms", outputCol="_features", binary=True)
    return tf.transform(df.withColumn("_terms", terms(F.col("text")))).drop("_terms")


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> tuple[DataFrame, float]:
    """(text, label, _deal) of at most about ``max_rows`` labelled rows outside the held-out part, and the
    sampling rate of toxic rows over that of the others.

    Each class keeps the ids whose hash falls under its share, so the choice does not
    depend on partitions or on the order of rows; up to half of the rows are the rarer class.
    """
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("_toxic"))
        .filter(F.col("doc_id").isNotNull() & F.col("_toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("_toxic").alias("_toxic"), F.max("_toxic").alias("_other"))
        .filter("_toxic = _other")
        .select("doc_id", "_toxic")
    )
    n = {r["_toxic"]: r["n"] for r in known.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    rare = 1 if n.get(1, 0) <= n.get(0, 0) else 0
    keep_rare = min(n.get(rare, 0), max_rows // 2)
    share = {rare: keep_rare / max(1, n.get(rare, 0)), 1 - rare: (max_rows - keep_rare) / max(1, n.get(1 - rare, 0))}
    u = F.pmod(F.xxhash64("doc_id", F.lit(SEED).cast("long")), F.lit(1_000_000)) / 1_000_000.0
    chosen = known.filter(u < F.when(F.col("_toxic") == 1, F.lit(share[1])).otherwise(F.lit(share[0])))
    # broadcast: at most about ``max_rows`` rows
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    rows = rows.select("text", F.col("_toxic").cast("double").alias("label"), F.xxhash64("doc_id", "text").alias("_deal"))
    rate = {k: min(1.0, v) for k, v in share.items()}
    return rows, rate[1] / rate[0] if rate[0] and rate[1] else 1.0


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    n_features: int = N_FEATURES,
    factors: int = FACTORS,
    max_train_rows: int = MAX_TRAIN_ROWS,
    max_iter: int = MAX_ITER,
) -> Fitted:
    """The fitted machine, or the share of the class when there are not two classes."""
    chosen, ratio = training_rows(docs, labels, max_train_rows)
    # dealt by id, so that copies of one text do not share a part; the parts of a bounded sample are bounded too
    chosen = chosen.repartition(TRAIN_PARTITIONS, "_deal").coalesce(TRAIN_PARTITIONS)
    train = _hashed(chosen, n_features).select("_features", "label").persist()
    try:
        seen = train.groupBy("label").count().collect()
        if len(seen) < 2:
            return Fitted(float(seen[0]["label"]) if seen else 0.0)
        fm = FMClassifier(
            featuresCol="_features", labelCol="label", factorSize=factors, maxIter=max_iter, stepSize=STEP,
            regParam=REG, initStd=0.05, seed=SEED, solver="adamW", tol=0.0,
        )
        return Fitted(fm.fit(train), ratio)
    finally:
        train.unpersist()


def score_toxicity(docs: DataFrame, fitted: Fitted) -> DataFrame:
    """The rows of ``docs`` with ``_score``: the probability of label 1, null never."""
    model, ratio = fitted
    if isinstance(model, float):
        return docs.withColumn("_score", F.lit(model))
    n = model.numFeatures
    scored = model.setProbabilityCol("_probability").setRawPredictionCol("").setPredictionCol("").transform(
        _hashed(docs, n)
    )
    p = vector_to_array("_probability")[1]
    return scored.withColumn("_score", p / (p + ratio * (1 - p))).drop("_features", "_probability")


def classify_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    model = fit_toxicity(docs, labels)
    return score_toxicity(docs.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with their columns as they came."""
    model = fit_toxicity(docs, labels)
    return unboxed(score_toxicity(boxed(docs, "text"), model).filter("_score < 0.5"))
