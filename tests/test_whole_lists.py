"""Registered queries run their whole lists of values."""

from clickweave.plans import q_clusters, q_fitted, q_io, q_models, q_online


def _calls(monkeypatch, module, name, result=None):
    seen = []
    monkeypatch.setattr(module, name, lambda *a, **k: (seen.append((a, k)), result)[1])
    return seen


def test_click_counts_and_folds(monkeypatch):
    for name in ("prepare_clickstream", "raw_clicks", "manual_labels"):
        monkeypatch.setattr(q_fitted, name, lambda *a, **k: None)
    for name in ("raw_clicks", "manual_labels"):
        monkeypatch.setattr(q_online, name, lambda *a, **k: None)
    sweep, cv = _calls(monkeypatch, q_fitted.sequences, "n_click_sweep"), _calls(monkeypatch, q_online.sequences, "sequence_cv")
    q_fitted._sweep(None, None)
    q_online.q_sequence_cv(None, None)
    (args, options), = sweep
    assert args[2:4] == (2, 10) and options["k"] == 5
    assert cv[0][1]["k"] == 5


def test_cluster_and_model_lists(monkeypatch, spark):
    monkeypatch.setattr(q_clusters, "scaled", lambda *a: None)
    sweep = _calls(monkeypatch, q_clusters.clusters, "k_sweep")
    q_clusters.q_k_sweep(None, None)
    assert "ks" not in sweep[0][1] and len(sweep[0][0]) == 2  # the operator's own list, 2, 4 .. 30


def test_model_lists(monkeypatch, spark):
    monkeypatch.setattr(q_models, "_split_train_test", lambda *a: (spark.range(50), None, []))
    stack = _calls(monkeypatch, q_models.stacking, "fit_stack")
    q_models._stack(None, None)
    assert stack[0][1] == {"k": 5}  # the operator's own grids
    assert len(q_models.stacking.logistic_grid()) == 64 and q_models.stacking.META_C == [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]
    assert set(q_models.stacking.BASES) == {"logistic_regression", *q_models.stacking.TREES}
    assert set(q_models.baseline_fitters([])) == {"logistic_regression", "random_forest", "knn", "gbt_a", "gbt_b"}
    assert {b.base: b.n_estimators for b in q_models.bagging.FAMILIES} == {"logistic_regression": 100, "decision_tree": 100, "knn": 50}


def test_all_cluster_tables_are_written(monkeypatch, spark):
    write, seen = q_io.files.write_cluster_outputs, {}
    monkeypatch.setattr(q_io.files, "write_cluster_outputs", lambda tables, *a: (seen.update(tables), write(tables, *a))[1])
    assert q_io.q_write_cluster_outputs(spark, "/root/testdata/sf0.001").count() == 8
    assert set(seen) == {"assignments", "summary", "representatives", "labeled_sessions"}
    assert seen["representatives"].groupBy("cluster_id").count().where("count = 5").count() == 8


def test_stack_grids_are_the_published_ones():
    trees = q_models.stacking.TREES
    assert {name: len({str(sorted(params.items())) for params in grid}) for name, grid in trees.items()} == {"random_forest": 64, "gbt_a": 64, "gbt_b": 64}
    values = {name: {key: {params[key] for params in grid} for key in grid[0]} for name, grid in trees.items()}
    assert values["random_forest"] == {"numTrees": {100, 200, 300, 500}, "maxDepth": {5, 10, 20, 30}, "minInstancesPerNode": {1, 2}, "featureSubsetStrategy": {"sqrt", "log2"}}
    boosted = {"maxIter": {100, 200}, "maxDepth": {3, 5, 7, 10}, "stepSize": {0.01, 0.1}, "subsamplingRate": {0.8, 1.0}, "featureSubsetStrategy": {"0.8", "all"}}
    assert values["gbt_a"] == boosted and values["gbt_b"] == {**boosted, "minInstancesPerNode": {20}}
