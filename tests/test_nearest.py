"""Exact 1-NN join against brute force."""

import tracemalloc

import numpy as np
import pytest

from seasonkit.catalog import KEYS, labelled_seasons
from seasonkit.operators import lsh, nearest
from seasonkit.operators.lsh import approximate_neighbour
from seasonkit.operators.nearest import nearest_neighbour
from seasonkit.schema import FEATURES

from .conftest import SF_MID


def _brute(tr, te):
    out = {}
    for qid, q in te:
        best = None
        for rid, x, y in tr:
            d = float(((q - x) ** 2).sum())
            key = (d, rid)
            if best is None or key < best[0]:
                best = (key, y)
        out[qid] = (best[1], np.sqrt(best[0][0]))
    return out


@pytest.mark.parametrize("cells", [{}, {"cell_points": 40, "block_points": 9}])
@pytest.mark.parametrize("dim,leaf", [(2, 8), (5, 16), (20, 64)])
def test_exact_nearest_neighbour_matches_brute_force(spark, dim, leaf, cells):
    rng = np.random.default_rng(dim)
    n_tr, n_te = 400, 120
    xs = rng.normal(size=(n_tr, dim)).round(1)  # rounding creates ties and duplicates
    xs[:60] = xs[0]  # one vector held by many rows (a hot key)
    ys = rng.integers(0, 2, n_tr).astype(float)
    qs = rng.normal(size=(n_te, dim)).round(1)
    qs[:5] = xs[0]
    feats = [f"f{i}" for i in range(dim)]
    tr = spark.createDataFrame(
        [(int(i), *map(float, xs[i]), float(ys[i])) for i in range(n_tr)],
        "rid int, " + ", ".join(f"{f} double" for f in feats) + ", label double",
    )
    te = spark.createDataFrame(
        [(int(i), *map(float, qs[i])) for i in range(n_te)], "qid int, " + ", ".join(f"{f} double" for f in feats)
    )
    nn = nearest_neighbour(tr, te, feats, "label", ["rid"], ["qid"], leaf_size=leaf, query_chunk=16, **cells)
    got = {r["qid"]: (r["nn_label"], r["nn_dist"]) for r in nn.collect()}
    want = _brute([(i, xs[i], ys[i]) for i in range(n_tr)], [(i, qs[i]) for i in range(n_te)])
    assert set(got) == set(want)
    for k in want:
        assert got[k][0] == want[k][0]
        assert got[k][1] == pytest.approx(want[k][1], abs=1e-9)


def test_tasks_stay_bounded_when_the_tree_is_full(spark, monkeypatch):
    """Two cells at most, far more points: cells are dealt into blocks and chunks of bounded size, and answers stay exact."""
    monkeypatch.setattr(nearest, "MAX_DEPTH", 1)
    rng = np.random.default_rng(3)
    xs, qs = rng.normal(size=(2000, 3)), rng.normal(size=(300, 3))
    tr = spark.createDataFrame([(i, *map(float, x), float(i % 2)) for i, x in enumerate(xs)], "rid int, a double, b double, c double, label double")
    te = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(qs)], "qid int, a double, b double, c double")
    got = nearest_neighbour(tr, te, ["a", "b", "c"], "label", ["rid"], ["qid"], cell_points=50, block_points=100, query_chunk=20, counts=True)
    want = _brute([(i, x, float(i % 2)) for i, x in enumerate(xs)], list(enumerate(qs)))
    for r in got.collect():
        assert (r.nn_label, r.nn_dist) == (want[r.qid][0], pytest.approx(want[r.qid][1])) and r.nn_checked < 1000


def test_block_search_visits_few_leaves():
    """Ties go to the first row, a bound leaves out what lies beyond it, and near leaves come first."""
    rng = np.random.default_rng(4)
    x, q = rng.normal(size=(4000, 3)), rng.normal(size=(50, 3))
    x[7] = x[3000] = q[0]
    at, d2, checked = nearest.search_block(x, x, q, q, np.full(50, np.inf), 32)
    every = ((q[:, None] - x[None]) ** 2).sum(-1)
    assert at[0] == 7 and (at == every.argmin(1)).all() and np.allclose(d2, every.min(1))
    assert checked.mean() < 400
    at, d2, _ = nearest.search_block(x, x, q, q, every.min(1) * 0.99, 32)
    assert (at[1:] == -1).all() and (d2[1:] == every.min(1)[1:] * 0.99).all()


def test_cells_within_the_bound_are_all_found():
    rng = np.random.default_rng(6)
    z = rng.normal(size=(500, 2))
    axis, split = np.array([0, 0, 1, 1]), np.array([0.0, 0.1, 0.2, -0.3])
    tree = nearest.Tree(np.zeros(2), np.eye(2), 2, axis, split)
    cell = tree.cell(z)
    low, high = np.full((8, 2), np.inf), np.full((8, 2), -np.inf)
    for c in range(4):
        low[4 + c], high[4 + c] = z[cell == c].min(0), z[cell == c].max(0)
    for i in (3, 2, 1):
        low[i], high[i] = np.minimum(low[2 * i], low[2 * i + 1]), np.maximum(high[2 * i], high[2 * i + 1])
    q, bound = rng.normal(size=(60, 2)), rng.uniform(0, 1, 60)
    own = tree.cell(q)
    got = set(zip(*map(list, nearest.near_cells(q, own, bound, tree, nearest.Boxes(low, high))), strict=True))
    far = nearest._mindist(q, low[4:], high[4:])
    assert {(int(a), int(b)) for a, b in got} == {(i, c) for i in range(60) for c in range(4) if c != own[i] and far[i, c] <= bound[i]}


def test_few_distances_on_the_season_table(spark):
    """20 correlated features: less than a quarter of all distances is computed."""
    st = labelled_seasons(spark, SF_MID)
    train, test = st.filter("NOT is_test"), st.filter("is_test")
    nn = nearest_neighbour(train, test, FEATURES, "label", KEYS, KEYS, counts=True)
    assert nn.agg({"nn_checked": "avg"}).first()[0] < 0.25 * train.count()


@pytest.mark.parametrize("bad", [None, float("nan")])
@pytest.mark.parametrize("side", ["train", "test"])
def test_missing_feature_fails(spark, bad, side):
    rows = {"train": [(1, 0.0, 1.0), (2, 1.0, 0.0)], "test": [(1, 0.5, 0.0), (2, 0.7, 0.0)]}
    rows[side][1] = (7, bad, 0.0)
    tr, te = (spark.createDataFrame(rows[s], "id int, a double, label double") for s in ("train", "test"))
    with pytest.raises(Exception, match="missing value in a: id=7"):
        nearest_neighbour(tr, te, ["a"], "label", ["id"], ["id"]).collect()


def test_no_training_rows_answer_nothing(spark):
    te = spark.createDataFrame([(1, 0.5, 0.0)], "id int, a double, label double")
    assert nearest_neighbour(te.limit(0), te, ["a"], "label", ["id"], ["id"]).collect() == []


def _recall(spark, train, test, features, keys, **kw):
    exact = {tuple(r[k] for k in keys): r.nn_dist for r in nearest_neighbour(train, test, features, "label", keys, keys).collect()}
    rows = approximate_neighbour(train, test, features, "label", keys, keys, counts=True, **kw).collect()
    got = {tuple(r[k] for k in keys): r for r in rows}
    assert got.keys() == exact.keys() and len(rows) == len(got)
    assert all(r.nn_dist >= exact[k] - 1e-9 for k, r in got.items())
    return np.mean([r.nn_dist <= exact[k] + 1e-9 for k, r in got.items()]), np.mean([r.nn_checked for r in rows])


def test_probing_finds_most_neighbours_of_the_season_table(spark):
    st = labelled_seasons(spark, SF_MID)
    train, test = st.filter("NOT is_test"), st.filter("is_test")
    recall, checked = _recall(spark, train, test, FEATURES, KEYS)
    assert recall >= 0.9 and checked < 0.5 * train.count()


def test_probing_with_a_hot_key_and_far_queries(spark, monkeypatch):
    """A third of the points within one step of each other, cut into blocks; queries far from all points go the exact way."""
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(1000, 6)) * 0.01, rng.normal(size=(2000, 6)) * 20])
    q = np.concatenate([rng.normal(size=(200, 6)) * 0.01, x[1500:1600] + 0.1, rng.normal(size=(5, 6)) * 1000])
    cols = ", ".join(f"f{i} double" for i in range(6))
    frame = lambda v: spark.createDataFrame([(i, *map(float, r), float(i % 2)) for i, r in enumerate(v)], f"id long, {cols}, label double")
    recall, _ = _recall(spark, frame(x), frame(q), [f"f{i}" for i in range(6)], ["id"], block_points=100, query_chunk=30)
    assert recall >= 0.9
    none = approximate_neighbour(frame(x).limit(0), frame(q), ["f0"], "label", ["id"], ["id"])
    assert none.collect() == []


def test_collision_probability():
    assert lsh.collision(1e-9, 1.0) == pytest.approx(1.0) and lsh.collision(1e9, 1.0) < 1e-6
    rng = np.random.default_rng(9)
    a, b = rng.normal(size=50_000), rng.uniform(0, 3, 50_000)
    met = np.floor(b / 3.0) == np.floor((b + 1.5 * a) / 3.0)
    assert lsh.collision(1.5, 3.0) == pytest.approx(met.mean(), abs=0.01)


def test_joins_back_to_rows_are_not_broadcast(spark):
    """A row for each scored row, and points and queries, never pass through the driver; the few cells may."""
    from seasonkit.plans.learners import fit

    rng = np.random.default_rng(3)
    rows = spark.createDataFrame([(i, float(a), float(b), float(a > 0)) for i, (a, b) in enumerate(rng.normal(size=(60, 2)))], "id long, f0 double, f1 double, label double")
    for kind in ("knn", "cart"):
        plan = fit(kind, rows, ["f0", "f1"], ["id"]).score(rows, ["id"])._jdf.queryExecution().executedPlan().toString()
        ends = [line for line in plan.splitlines() if "Join" in line and "id#" in line]
        assert ends and not any("Broadcast" in line for line in ends)


def test_probing_keys_a_piece_at_a_time(spark, monkeypatch):
    """What a task holds of the copies for all tables is bounded by ``PIECE`` rows; the answers are the same."""
    from seasonkit.operators import lsh

    rng = np.random.default_rng(4)
    train = spark.createDataFrame([(i, float(a), float(b), 1.0) for i, (a, b) in enumerate(rng.normal(size=(300, 2)))], "id long, f0 double, f1 double, label double")
    ask = lambda: {r.id: r.nn_dist for r in approximate_neighbour(train, train, ["f0", "f1"], "label", ["id"], ["id"]).collect()}
    whole = ask()
    monkeypatch.setattr(lsh, "PIECE", 7)
    assert ask() == whole and set(whole.values()) == {0.0}


def test_distances_to_boxes_hold_no_array_of_every_dimension():
    rng = np.random.default_rng(5)
    z, low = rng.normal(size=(200, 20)), rng.normal(size=(300, 20))
    high = low + rng.uniform(size=(300, 20))
    gap = np.maximum(np.maximum(low[None] - z[:, None], z[:, None] - high[None]), 0.0)
    tracemalloc.start()
    got = nearest._mindist(z, low, high)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.allclose(got, (gap * gap).sum(-1), rtol=1e-12) and most < 6 * got.nbytes


def test_pairs_of_queries_and_cells_come_a_few_at_a_time(spark, monkeypatch):
    """Far queries have every cell within their bound; a task makes ``PAIRS`` of these rows at once, and answers stay exact."""
    monkeypatch.setattr(nearest, "PAIRS", 64)
    rng = np.random.default_rng(6)
    xs, qs = rng.normal(size=(400, 3)), rng.normal(size=(80, 3)) * 50
    tr = spark.createDataFrame([(i, *map(float, x), float(i % 2)) for i, x in enumerate(xs)], "rid int, a double, b double, c double, label double")
    te = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(qs)], "qid int, a double, b double, c double")
    got = nearest_neighbour(tr, te, ["a", "b", "c"], "label", ["rid"], ["qid"], cell_points=20).collect()
    want = _brute([(i, x, float(i % 2)) for i, x in enumerate(xs)], list(enumerate(qs)))
    assert len(got) == 80 and all((r.nn_label, r.nn_dist) == (want[r.qid][0], pytest.approx(want[r.qid][1])) for r in got)
