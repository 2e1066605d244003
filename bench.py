"""Bench: headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

Prints ONE JSON line:
``{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}``
plus per-learner fit seconds (``fit_sec``) and row counts.

Stages (each timed to the end of its action; tables feeding later stages are
written once to the shared checkpoint folder, as in production):

* season_features   -- plays → team-game → team-season table, written
* nearest_neighbour -- exact 1-NN of every test season (20 features)
* leaderboard       -- 20 fits (10 learners × {20 features, 2 components}),
                       scores written; fits run as concurrent jobs
* threshold_sweep   -- 20 models × 9 cut-offs, one aggregate
* confusion_matrix, classification_report, report_at_cutoffs
* roc_points, auc   -- over every model's ranking margin
* best_overall, best_per_model
* top_importances, decision_grid
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    from seasonkit import catalog as C
    from seasonkit.operators import curves, evaluate, explain
    from seasonkit.operators.nearest import nearest_neighbour
    from seasonkit.plans.leaderboard import run_models
    from seasonkit.plans.learners import fit_model
    from seasonkit.schema import FEATURES
    from seasonkit.session import local_session

    spark = local_session(cpus, app="seasonkit-bench")
    q: dict[str, float] = {}
    rows: dict[str, int] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        q[name] = round(time.time() - t0, 3)
        return out

    def count(df):
        """Run the whole plan once (count() alone would let unused columns go) and count its rows on the way."""
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.format("noop").mode("overwrite").save()
        return seen.get["n"]

    st = timed("season_features", lambda: C.labelled_seasons(spark, sf_dir))
    rows["season_features"] = st.count()
    train, test = st.filter(~F.col("is_test")), st.filter(F.col("is_test"))

    rows["nearest_neighbour"] = timed(
        "nearest_neighbour", lambda: count(nearest_neighbour(train, test, FEATURES, "label", C.KEYS, C.KEYS))
    )

    fit_sec: dict[str, float] = {}
    scores = timed("leaderboard", lambda: run_models(train, test, FEATURES, C.KEYS, timings=fit_sec))
    rows["scores"] = scores.count()

    rows["threshold_sweep"] = timed("threshold_sweep", lambda: count(evaluate.threshold_sweep(scores)))
    rows["confusion_matrix"] = timed("confusion_matrix", lambda: count(evaluate.confusion_matrix(scores)))
    rows["classification_report"] = timed(
        "classification_report", lambda: count(evaluate.classification_report(scores))
    )
    cut = evaluate.cutoff_table(spark)
    rows["report_at_cutoffs"] = timed(
        "report_at_cutoffs", lambda: count(evaluate.report_at_cutoffs(scores, cut))
    )
    rows["roc_points"] = timed("roc_points", lambda: count(curves.roc_points(scores, score="margin")))
    rows["auc"] = timed("auc", lambda: count(curves.auc(scores, score="margin")))
    lb = evaluate.threshold_sweep(scores)
    rows["best_overall"] = timed("best_overall", lambda: count(evaluate.best_overall(lb)))
    rows["best_per_model"] = timed("best_per_model", lambda: count(evaluate.best_per_model(lb)))

    def importances():
        m = fit_model("logit", train, FEATURES)
        return count(explain.top_importances(explain.coefficient_importances(spark, m.coefficients, FEATURES)))

    rows["top_importances"] = timed("top_importances", importances)
    rows["decision_grid"] = timed("decision_grid", lambda: count(C.q_decision_grid(spark, sf_dir)))

    out = {
        "metric": "total_sec",
        "value": round(sum(q.values()), 3),
        "unit": "sec",
        "queries": q,
        "fit_sec": fit_sec,
        "rows": rows,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }
    print(json.dumps(out), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
