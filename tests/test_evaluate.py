"""Evaluation operators: edge cases and identities against NumPy."""

import numpy as np
import pytest

from seasonkit.operators import curves, evaluate, explain

SC = "model string, model_ord int, id int, label double, p1 double, score double"


def _scores(spark, rows):
    return spark.createDataFrame(rows, SC)


def test_probability_exactly_at_threshold_is_class_zero(spark):
    df = _scores(spark, [("m", 1, 1, 0.0, 0.5, 0.5)])
    cm = {(r["threshold"], r["actual"], r["predicted"]): r["n"] for r in evaluate.confusion_matrix(df, [0.5]).collect()}
    assert cm[(0.5, 0, 0)] == 1 and cm[(0.5, 0, 1)] == 0


def test_confusion_cells_sum_to_rows_and_accuracy(spark):
    rng = np.random.default_rng(0)
    rows = [("m", 1, i, float(rng.integers(0, 2)), float(rng.random()), 0.0) for i in range(200)]
    df = _scores(spark, rows)
    cc = evaluate.confusion_counts(df).collect()
    assert all(r["tp"] + r["fp"] + r["tn"] + r["fn"] == 200 for r in cc)
    lb = {r["threshold"]: r["accuracy"] for r in evaluate.threshold_sweep(df).collect()}
    y = np.array([r[3] for r in rows])
    p = np.array([r[4] for r in rows])
    for t in (0.1, 0.5, 0.9):
        assert lb[t] == pytest.approx(np.mean((p > t).astype(float) == y))


def test_never_predicted_class_has_zero_precision(spark):
    df = _scores(spark, [("m", 1, 1, 1.0, 0.2, 0.0), ("m", 1, 2, 0.0, 0.1, 0.0)])
    rep = {r["class"]: r for r in evaluate.classification_report(df, [0.5]).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["recall"] == 0.0 and rep["1"]["f1"] == 0.0
    assert rep["accuracy"]["f1"] == pytest.approx(0.5)
    assert rep["macro avg"]["precision"] == pytest.approx(0.25)


def test_report_omits_class_absent_from_truth_and_predictions(spark):
    df = _scores(spark, [("m", 1, 1, 0.0, 0.2, 0.0), ("m", 1, 2, 0.0, 0.1, 0.0)])
    classes = {r["class"] for r in evaluate.classification_report(df, [0.5]).collect()}
    assert classes == {"0", "accuracy", "macro avg", "weighted avg"}


def test_best_overall_tie_break(spark):
    lb = spark.createDataFrame(
        [("b", 2, 0.1, 0.9), ("a", 1, 0.3, 0.9), ("a", 1, 0.2, 0.9), ("c", 3, 0.1, 0.5)],
        "model string, model_ord int, threshold double, accuracy double",
    )
    r = evaluate.best_overall(lb).first()
    assert (r["model"], r["threshold"]) == ("a", 0.2)
    per = {x["model"]: x["threshold"] for x in evaluate.best_per_model(lb).collect()}
    assert per == {"a": 0.2, "b": 0.1, "c": 0.1}


def test_equal_importances_order_by_name_desc(spark):
    imp = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 0.5)], "feature string, importance double")
    assert [r["feature"] for r in explain.top_importances(imp, 2).collect()] == ["b", "a"]


def _sk_roc(y, s):
    """Reference algorithm of the ROC curve (distinct thresholds, collinear points dropped)."""
    order = np.argsort(-s, kind="mergesort")
    y, s = y[order], s[order]
    idx = np.r_[np.where(np.diff(s))[0], len(s) - 1]
    tps = np.cumsum(y)[idx]
    fps = 1 + idx - tps
    if len(fps) > 2:
        keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
        fps, tps, thr = fps[keep], tps[keep], s[idx][keep]
    else:
        thr = s[idx]
    return np.r_[0, fps] / fps[-1], np.r_[0, tps] / tps[-1], thr


@pytest.mark.parametrize("seed", [0, 1])
def test_roc_points_and_auc_match_reference_algorithm(spark, seed):
    rng = np.random.default_rng(seed)
    n = 300
    y = rng.integers(0, 2, n).astype(float)
    s = np.round(rng.random(n) + 0.3 * y, 1)  # heavy ties
    df = _scores(spark, [("m", 1, i, float(y[i]), 0.0, float(s[i])) for i in range(n)])
    pts = curves.roc_points(df).collect()
    fpr, tpr, thr = _sk_roc(y, s)
    got = sorted(((r["threshold"] if r["threshold"] is not None else np.inf), r["fpr"], r["tpr"]) for r in pts)
    want = sorted(zip(np.r_[np.inf, thr], fpr, tpr))
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a == pytest.approx(b)
    area = curves.auc(df).first()["auc"]
    assert area == pytest.approx(np.trapezoid(tpr, fpr))
    pos, neg = s[y == 1], s[y == 0]
    conc = ((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :])).mean()
    assert area == pytest.approx(conc)


def test_roc_buckets_span_partitions(spark):
    """Running sums cross range-partition boundaries correctly."""
    rng = np.random.default_rng(3)
    n = 2000
    y = rng.integers(0, 2, n).astype(float)
    s = rng.random(n)
    df = _scores(spark, [("m", 1, i, float(y[i]), 0.0, float(s[i])) for i in range(n)] +
                 [("k", 2, i, float(y[i]), 0.0, float(-s[i])) for i in range(n)])
    rc = curves.running_counts(curves.score_counts(df), buckets=7).filter("model = 'm'").toPandas()
    rc = rc.sort_values("score", ascending=False)
    assert (np.diff(rc["cum_pos"].to_numpy()) >= 0).all()
    assert rc["cum_pos"].iloc[-1] == y.sum() and rc["cum_neg"].iloc[-1] == n - y.sum()


def test_decision_grid_matches_numpy_arange(spark):
    tr = spark.createDataFrame([(0.0, 0.0), (2.2, 1.1)], "x double, y double")
    g = explain.decision_grid(tr, "x", "y", lambda pts: pts.withColumn("prediction", pts["x"] * 0))
    xs = sorted({r["x"] for r in g.collect()})
    ys = sorted({r["y"] for r in g.collect()})
    assert xs == pytest.approx(list(np.arange(0.0, 2.2, 0.5)))
    assert ys == pytest.approx(list(np.arange(0.0, 1.1, 0.5)))
    assert g.count() == len(xs) * len(ys)


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_missing_probability_fails(spark, bad):
    df = _scores(spark, [("m", 1, 1, 1.0, 0.2, 0.0), ("m", 1, 2, 0.0, bad, 0.0)])
    with pytest.raises(Exception, match="missing value in p1: model=m"):
        evaluate.confusion_counts(df).collect()


def test_model_without_cutoff_fails(spark):
    df = _scores(spark, [("m", 1, 1, 1.0, 0.2, 0.0), ("other", 2, 1, 1.0, 0.2, 0.0)])
    cut = evaluate.cutoff_table(spark, [("m", 0.1)])
    with pytest.raises(Exception, match="missing value in cutoff: model=other"):
        evaluate.report_at_cutoffs(df, cut).collect()
    assert evaluate.report_at_cutoffs(df.filter("model = 'm'"), cut).count() == 4
