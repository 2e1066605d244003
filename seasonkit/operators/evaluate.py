"""Threshold sweep, confusion matrices, classification reports, best picks.

Input is a *score table*: one row per (model, scored row) with ``label``
(0/1 double), ``p1`` (positive-class probability) and ``model_ord`` (the
model's position in the leaderboard). Every operator here is one grouped
aggregate over that table for all models at once: per model and cut-off the
four confusion cells are conditional counts computed in a single pass
(partial aggregation map-side, so a model holding a third of the rows costs
nothing extra), then unpivoted. Rows are never multiplied by the number of
cut-offs before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import required
from ..schema import MODEL_CUTOFFS, THRESHOLDS

MODEL_COLS = ("model", "model_ord")
CUTOFF_ROWS = 100_000


def _count_if(cond):
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def confusion_counts(
    scores: DataFrame,
    thresholds: Sequence[float] = THRESHOLDS,
    prob: str = "p1",
    label: str = "label",
    group: Sequence[str] = MODEL_COLS,
) -> DataFrame:
    """(group..., threshold, tp, fp, tn, fn, n) for every cut-off; predicted
    class is 1 when ``prob > threshold`` (strict). A null or NaN probability or
    label fails: it would leave the denominator or count as class 1 unseen."""
    p, y = required(prob, group), required(label, group)
    aggs = []
    for i, t in enumerate(thresholds):
        hit = p > F.lit(float(t))
        aggs += [
            _count_if(hit & (y == 1)).alias(f"tp{i}"),
            _count_if(hit & (y != 1)).alias(f"fp{i}"),
            _count_if(~hit & (y != 1)).alias(f"tn{i}"),
            _count_if(~hit & (y == 1)).alias(f"fn{i}"),
        ]
    wide = scores.groupBy(*group).agg(*aggs)
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"tp{i}").alias("tp"),
                F.col(f"fp{i}").alias("fp"),
                F.col(f"tn{i}").alias("tn"),
                F.col(f"fn{i}").alias("fn"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    long = wide.select(*group, F.inline(rows))
    return long.withColumn("n", F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"))


def threshold_sweep(scores: DataFrame, thresholds: Sequence[float] = THRESHOLDS, **kw) -> DataFrame:
    """Leaderboard: (model, model_ord, threshold, accuracy)."""
    cc = confusion_counts(scores, thresholds, **kw)
    return cc.select(
        *MODEL_COLS, "threshold", ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy")
    )


def confusion_matrix(scores: DataFrame, thresholds: Sequence[float] = THRESHOLDS, **kw) -> DataFrame:
    """Long, zero-filled 2×2 matrices: (model, model_ord, threshold, actual, predicted, n)."""
    cc = confusion_counts(scores, thresholds, **kw)
    cells = F.array(
        F.struct(F.lit(0).alias("actual"), F.lit(0).alias("predicted"), F.col("tn").alias("n")),
        F.struct(F.lit(0).alias("actual"), F.lit(1).alias("predicted"), F.col("fp").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(0).alias("predicted"), F.col("fn").alias("n")),
        F.struct(F.lit(1).alias("actual"), F.lit(1).alias("predicted"), F.col("tp").alias("n")),
    )
    return cc.select(*MODEL_COLS, "threshold", F.inline(cells))


def confusion_observed(scores: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """Confusion counts over the labels actually seen: (model, actual, predicted, n)."""
    return scores.groupBy("model", F.col(label).alias("actual"), F.col(pred).alias("predicted")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n")
    )


def _ratio(num, den):
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def _f1(p, r):
    return F.when((p + r) > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0))


def report_from_counts(cc: DataFrame, group: Sequence[str] = (*MODEL_COLS, "threshold")) -> DataFrame:
    """Per-class precision/recall/F1/support plus accuracy, macro and weighted
    averages, from confusion counts. A class is listed when it occurs among
    actual or predicted values; a zero denominator gives 0."""
    tp, fp, tn, fn, n = (F.col(c) for c in ("tp", "fp", "tn", "fn", "n"))
    per = cc.select(
        *group,
        n.alias("n"),
        ((tp + tn) / n).alias("acc"),
        # class 0
        _ratio(tn, tn + fn).alias("p0"),
        _ratio(tn, tn + fp).alias("r0"),
        (tn + fp).alias("s0"),
        ((tn + fp + tn + fn) > 0).alias("in0"),
        # class 1
        _ratio(tp, tp + fp).alias("p1"),
        _ratio(tp, tp + fn).alias("r1"),
        (tp + fn).alias("s1"),
        ((tp + fn + tp + fp) > 0).alias("in1"),
    ).withColumns({"f0": _f1(F.col("p0"), F.col("r0")), "f1": _f1(F.col("p1"), F.col("r1"))})

    k = F.col("in0").cast("int") + F.col("in1").cast("int")

    def macro(a, b):
        return (F.when(F.col("in0"), F.col(a)).otherwise(0.0) + F.when(F.col("in1"), F.col(b)).otherwise(0.0)) / k

    def weighted(a, b):
        return (F.col(a) * F.col("s0") + F.col(b) * F.col("s1")) / F.col("n")

    def row(cls, p, r, f, s, keep=F.lit(True)):
        return F.when(
            keep,
            F.struct(
                F.lit(cls).alias("class"),
                p.cast("double").alias("precision"),
                r.cast("double").alias("recall"),
                f.cast("double").alias("f1"),
                s.cast("bigint").alias("support"),
            ),
        )

    null = F.lit(None).cast("double")
    rows = F.array(
        row("0", F.col("p0"), F.col("r0"), F.col("f0"), F.col("s0"), F.col("in0")),
        row("1", F.col("p1"), F.col("r1"), F.col("f1"), F.col("s1"), F.col("in1")),
        row("accuracy", null, null, F.col("acc"), F.col("n")),
        row("macro avg", macro("p0", "p1"), macro("r0", "r1"), macro("f0", "f1"), F.col("n")),
        row("weighted avg", weighted("p0", "p1"), weighted("r0", "r1"), weighted("f0", "f1"), F.col("n")),
    )
    return per.select(*group, F.inline(F.filter(rows, lambda x: x.isNotNull())))


def classification_report(scores: DataFrame, thresholds: Sequence[float] = THRESHOLDS, **kw) -> DataFrame:
    """(model, model_ord, threshold, class, precision, recall, f1, support)."""
    return report_from_counts(confusion_counts(scores, thresholds, **kw))


def prediction_counts(
    scores: DataFrame, pred: str = "prediction", label: str = "label", group: Sequence[str] = MODEL_COLS
) -> DataFrame:
    """Confusion counts of each model's own decision (``prediction``), one
    aggregate; ``threshold`` is null. A missing decision or label fails."""
    p, y = required(pred, group), required(label, group)
    cc = scores.groupBy(*group).agg(
        _count_if((p == 1) & (y == 1)).alias("tp"),
        _count_if((p == 1) & (y != 1)).alias("fp"),
        _count_if((p != 1) & (y != 1)).alias("tn"),
        _count_if((p != 1) & (y == 1)).alias("fn"),
    )
    return cc.withColumns(
        {
            "n": F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"),
            "threshold": F.lit(None).cast("double"),
        }
    )


def prediction_report(scores: DataFrame, **kw) -> DataFrame:
    """Classification report of each model's own decision (no cut-off)."""
    return report_from_counts(prediction_counts(scores, **kw))


def cutoff_table(spark, cutoffs=MODEL_CUTOFFS) -> DataFrame:
    """The per-model cut-offs as a small literal table (20 rows)."""
    return spark.createDataFrame([(m, float(t)) for m, t in cutoffs], "model string, cutoff double")


def report_at_cutoffs(scores: DataFrame, cutoffs: DataFrame, prob: str = "p1", label: str = "label") -> DataFrame:
    """Classification report of each model at its own cut-off.

    ``cutoffs`` (model, cutoff) has one row per model; it is broadcast up to
    ``CUTOFF_ROWS`` rows, so that the scores aren't shuffled by a few models. A model without a cut-off fails instead of
    leaving the report, as does a null or NaN probability or label.
    """
    small = cutoffs.count() <= CUTOFF_ROWS
    s = scores.join(F.broadcast(cutoffs) if small else cutoffs, "model", "left")
    hit = required(prob, MODEL_COLS) > F.col("cutoff")
    y = required(label, MODEL_COLS)
    cc = s.groupBy(*MODEL_COLS, required("cutoff", MODEL_COLS).alias("threshold")).agg(
        _count_if(hit & (y == 1)).alias("tp"),
        _count_if(hit & (y != 1)).alias("fp"),
        _count_if(~hit & (y != 1)).alias("tn"),
        _count_if(~hit & (y == 1)).alias("fn"),
    )
    cc = cc.withColumn("n", F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"))
    return report_from_counts(cc)


def best_overall(leaderboard: DataFrame) -> DataFrame:
    """The single best (model, threshold): highest accuracy, then lowest
    ``model_ord``, then lowest threshold (the reference's first-row rule)."""
    best = leaderboard.orderBy(F.desc("accuracy"), F.asc("model_ord"), F.asc("threshold")).limit(1)
    # percentage to two places, half-even as the reference's NumPy rounding
    return best.withColumn("accuracy_pct", F.bround(F.col("accuracy") * 100.0, 2))


def best_per_model(leaderboard: DataFrame) -> DataFrame:
    """Best threshold per model (ties → lower threshold), as an aggregate so
    that it combines map-side rather than windowing whole models."""
    best = F.max(F.struct(F.col("accuracy"), (-F.col("threshold")).alias("neg_t")))
    return leaderboard.groupBy(*MODEL_COLS).agg(best.alias("b")).select(
        *MODEL_COLS, (-F.col("b.neg_t")).alias("threshold"), F.col("b.accuracy").alias("accuracy")
    )
