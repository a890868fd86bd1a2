import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from clickweave.operators import grid, many_trees, stacking, training

COLS = ["a", "b"]


@pytest.fixture
def frame(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((240, 2))
    label = (x[:, 0] + rng.standard_normal(240) > 0).astype(int)
    rows = [(i, int(label[i]), float(x[i, 0]), float(x[i, 1])) for i in range(240)]
    return grid.fold_frame(spark.createDataFrame(rows, "session_id LONG, label INT, a DOUBLE, b DOUBLE"), COLS, 3, 42)


def pairs_won(rows):
    ones, zeros = ([s for v, s in rows if v == c] for c in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


def test_one_pass_scores_the_models_of_all_folds(frame):
    models = [stacking.base_estimator("gbt_b", {"maxIter": 2, "maxDepth": 2}, 160).fit(frame.where(F.col("fold") != f)) for f in range(3)]
    found = grid.model_areas(frame, models)
    for f, model in enumerate(models):
        told = [(r["fold"], r["label"], r["s"]) for r in model.transform(frame).select("fold", "label", vector_to_array("gbt_b_probability")[1].alias("s")).collect()]
        for side in (0, 1):
            assert found[f, side] == pytest.approx(pairs_won([(v, s) for own, v, s in told if (own == f) == bool(side)]))


def test_search_scores_each_configuration_once(frame, monkeypatch):
    asked, plain = [], grid.model_areas
    monkeypatch.setattr(grid, "model_areas", lambda rows, models: asked.append(len(models)) or plain(rows, models))
    found = grid.search(frame, [({"depth": d}, training.tree_estimator(d, 1)) for d in (1, 4)], 3, keep=True)
    assert asked == [3, 3] and set(found.models) == {(c, f) for c in (0, 1) for f in range(3)}
    assert set(found.scores) == {(c, f, side) for c in (0, 1) for f in range(3) for side in (0, 1)}
    assert all(m.depth <= (1, 4)[c] for (c, _), m in found.models.items())


def test_a_long_list_keeps_the_best_models_of_each_family_only(frame):
    configs = [({"depth": d}, training.tree_estimator(d, 1)) for d in (1, 4, 2, 3)]
    found = grid.search(frame, configs, 3, keep=True, families=["x", "x", "y", "y"])
    whole = grid.search(frame, configs, 3, keep=True)
    assert found.scores == whole.scores and len(whole.models) == 12
    best = [max(pair, key=lambda c: (found.mean(c), -c)) for pair in ((0, 1), (2, 3))]
    assert set(found.models) == {(c, f) for c in best for f in range(3)}


def test_forests_of_all_sizes_and_depths_share_their_trees(frame, monkeypatch):
    grown, plain = [], many_trees.TreeRows.grow
    monkeypatch.setattr(many_trees.TreeRows, "grow", lambda self, trees: grown.extend(trees) or plain(self, trees))
    params = [{"numTrees": n, "maxDepth": d, "minInstancesPerNode": leaf, "featureSubsetStrategy": "all"} for n in (2, 5) for d in (1, 6) for leaf in (1, 4)]
    found = grid.search_forests(frame, COLS, params, 3)
    assert len(grown) == 2 * 3 * 5 and len(found.scores) == len(params) * 3 * 2
    monkeypatch.setattr(many_trees, "FOREST_ROWS", 480)  # two trees at a time
    assert grid.search_forests(frame, COLS, params, 3).scores == pytest.approx(found.scores)
    # against forests of trees grown to that depth
    rows = frame.select("session_id", "label", "fold").toPandas().set_index("session_id")
    with many_trees.TreeRows(frame, COLS) as data:
        for i in (1, 2, 4, 7):
            trees = [many_trees.Tree((0, 1), params[i]["maxDepth"], params[i]["minInstancesPerNode"], 1, b, bootstrap=True) for b in range(params[i]["numTrees"])]
            told = {r["session_id"]: r["probability"] for r in data.mean(data.grow(trees), frame).collect()}
            for side in (0, 1):
                own = [(r["label"], told[s]) for s, r in rows.iterrows() if (r["fold"] == 1) == bool(side)]
                assert found.scores[i, 1, side] == pytest.approx(pairs_won(own))


@pytest.mark.parametrize("local_rows", [0, 4096])
def test_splits_of_a_forest_are_drawn_from_some_columns(frame, monkeypatch, local_rows):
    monkeypatch.setattr(many_trees, "LOCAL_ROWS", local_rows)
    trees = [many_trees.Tree((0, 1), 8, 1, bag=b, bootstrap=True, tried=1) for b in range(12)]
    with many_trees.TreeRows(frame, COLS) as data:
        roots = {int(tree.column[0]) for tree in data.grow(trees)}
        for tree in trees:
            assert (tree.draw(np.arange(50), 42).sum(axis=1) == 1).all()
    assert roots == {0, 1}
    assert [grid.columns_tried(s, 12) for s in ("auto", "sqrt", "log2", "all")] == [4, 4, 4, 12]
