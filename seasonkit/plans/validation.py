"""Cut-offs chosen on training seasons only.

Each training season is scored by a model that has not seen it; the cut-off that does best on these scores is then
reported on the test seasons, which it was not chosen on.

For Gaussian naive Bayes this is one job: counts, means and variances by (season, class) are one aggregate, and a
season's own part is taken out of the totals in closed form, so no model is fitted season by season. Other learners
are fitted once a season, as concurrent jobs.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import required
from ..operators.evaluate import best_per_model, report_at_cutoffs, threshold_sweep
from ..schema import THRESHOLDS
from ..session import materialize
from .scores import score_rows

#: The variance floor of Gaussian naive Bayes, as a share of the largest variance.
FLOOR = 1e-9


def _without_own(parts: DataFrame, features: Sequence[str], by: Sequence[str], season: str) -> DataFrame:
    """(season, by, n, m_*, v_*) of all rows of the other seasons, from (season, by, n, m_*, s_*) where s is the sum of
    squares about the part's own mean. One row a season and class: the window holds no rows of the table."""
    whole = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(1))
    total = parts.withColumn("_n", F.sum("n").over(whole))
    for c in features:
        total = total.withColumn(f"_m_{c}", F.sum(F.col("n") * F.col(f"m_{c}")).over(whole) / F.col("_n"))
        total = total.withColumn(
            f"_s_{c}", F.sum(F.col(f"s_{c}") + F.col("n") * F.pow(F.col(f"m_{c}") - F.col(f"_m_{c}"), F.lit(2.0))).over(whole)
        )
    rest = F.col("_n") - F.col("n")
    out = []
    for c in features:
        mean = (F.col("_n") * F.col(f"_m_{c}") - F.col("n") * F.col(f"m_{c}")) / rest
        spread = F.col(f"_s_{c}") - F.col(f"s_{c}") - F.col("n") * rest / F.col("_n") * F.pow(F.col(f"m_{c}") - mean, F.lit(2.0))
        out += [mean.alias(f"m_{c}"), (F.greatest(spread, F.lit(0.0)) / rest).alias(f"v_{c}")]
    return total.filter(rest > 0).select(season, *by, rest.alias("n"), *out)


def naive_bayes_season_out(
    train: DataFrame, features: Sequence[str], keys: Sequence[str], model: str = "naive bayes", model_ord: int = 2, season: str = "year"
) -> DataFrame:
    """Score table of the training rows: each season scored by Gaussian naive Bayes of all the other seasons.

    A season whose other seasons lack a class gets that class's share, 0 or 1. One season alone has no other: no row.
    """
    rows = train.select(*keys, *[required(c, keys).alias(c) for c in features], required("label", keys).alias("label"))
    moments = lambda c: [F.avg(c).alias(f"m_{c}"), (F.var_pop(c) * F.count(c)).alias(f"s_{c}")]
    aggs = [F.count(F.lit(1)).cast("double").alias("n"), *[a for c in features for a in moments(c)]]
    by_class = _without_own(_filled(rows.groupBy(season, "label").agg(*aggs), features, season), features, ["label"], season)
    overall = _without_own(rows.groupBy(season).agg(*aggs), features, [], season)
    floor = F.lit(FLOOR) * F.greatest(*[F.col(f"v_{c}") for c in features]) if len(features) > 1 else F.lit(FLOOR) * F.col(f"v_{features[0]}")
    overall = overall.select(season, F.col("n").alias("_all"), floor.alias("_floor"))
    log = F.log(F.col("n") / F.col("_all"))
    for c in features:
        v = F.col(f"v_{c}") + F.col("_floor")
        log = log - 0.5 * F.log(F.lit(2 * math.pi) * v) - 0.5 * F.pow(F.col(f"x_{c}") - F.col(f"m_{c}"), F.lit(2.0)) / v
    named = rows.select(*keys, "label", *[F.col(c).alias(f"x_{c}") for c in features])
    models = by_class.withColumnRenamed("label", "_class").join(overall, season)
    joint = named.join(models, season).withColumn("_log", log)
    wide = joint.groupBy(*keys, "label").agg(
        F.max(F.when(F.col("_class") == 0, F.col("_log"))).alias("_l0"), F.max(F.when(F.col("_class") == 1, F.col("_log"))).alias("_l1")
    )
    p1 = (
        F.when(F.col("_l1").isNull(), F.lit(0.0)).when(F.col("_l0").isNull(), F.lit(1.0))
        .otherwise(F.lit(1.0) / (F.lit(1.0) + F.exp(F.col("_l0") - F.col("_l1"))))
    )
    return score_rows(wide.withColumn("_p", p1), model, model_ord, keys, F.col("_p"), None, (F.col("_p") > 0.5).cast("double"))


def _filled(parts: DataFrame, features: Sequence[str], season: str) -> DataFrame:
    """A row of zeros for each season that lacks a class, so that its other seasons' totals are not lost."""
    every = parts.select(season).distinct().select(season, F.explode(F.array(F.lit(0.0), F.lit(1.0))).alias("label"))
    zeros = {"n": 0.0} | {f"{k}_{c}": 0.0 for c in features for k in ("m", "s")}
    return every.join(parts, [season, "label"], "left").na.fill(zeros)


def season_out(train: DataFrame, fit: Callable[[DataFrame, DataFrame], DataFrame], season: str = "year", parallelism: int = 4) -> DataFrame:
    """Score table of the training rows by any learner: ``fit(other seasons, season)`` scores each season."""
    seasons = sorted(r[0] for r in train.select(season).distinct().collect())  # one row a season
    if len(seasons) < 2:
        raise ValueError("leaving a season out needs two seasons at least")
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        jobs = [pool.submit(copy_context().run, fit, train.filter(F.col(season) != s), train.filter(F.col(season) == s)) for s in seasons]
        return reduce(DataFrame.unionByName, [j.result() for j in jobs])


def chosen_cutoffs(validation: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """(model, cutoff): the best cut-off of each model on the seasons it had not seen; ties go to the lower one."""
    best = best_per_model(threshold_sweep(validation, thresholds))
    return best.select("model", F.col("threshold").alias("cutoff"))


def validated_report(validation: DataFrame, test_scores: DataFrame, thresholds: Sequence[float] = THRESHOLDS) -> DataFrame:
    """Classification report on the test rows at cut-offs chosen on the validation rows."""
    # both written, as score tables are: a plan that knows the only model's name would drop the join's key
    cutoffs = materialize(chosen_cutoffs(validation, thresholds), "cutoffs")
    return report_at_cutoffs(materialize(test_scores, "test-scores"), cutoffs)
