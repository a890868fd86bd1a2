"""Exact quotas, fold-cached searches, stacking, bagging and the pruned neighbour search."""

import hashlib
import json
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from clickweave.operators import bagging, grid, knn, metrics, stacking, training

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(600, 3)), 2)
    y = rng.random(600) < 1 / (1 + np.exp(-(x[:, 0] * 2 + x[:, 1] * x[:, 2] - 1)))
    data = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "session_id long, a double, b double, c double, label int").repartition(6).cache()


@pytest.fixture(scope="module")
def split(rows):
    both = training.class_weights(training.stratified_split(rows)).cache()
    return both.where("is_test = 0"), both.where("is_test = 1")


def area(told):
    return metrics.roc_auc(training.probability_of_one(told).select("label", "probability")).first()[0]


def order(row, salt):
    return hashlib.md5(f"{row['session_id']}{salt}".encode()).hexdigest(), row["session_id"]


@pytest.mark.parametrize("fraction", [0.0, 0.001, 0.2, 0.5, 1.0])
def test_split_takes_the_exact_quota_of_each_class(rows, fraction):
    told = training.stratified_split(rows, fraction).collect()
    assert training.stratified_split(rows.repartition(2, "a"), fraction).where("is_test = 1").count() == sum(r["is_test"] for r in told)
    for label in (0, 1):
        mine = sorted((r for r in told if r["label"] == label), key=lambda r: order(r, 42))
        quota = math.ceil(round(fraction * len(mine), 9))
        assert [r["is_test"] for r in mine] == [1] * quota + [0] * (len(mine) - quota)


def test_folds_follow_the_rank_inside_a_class(rows, spark):
    told = training.stratified_folds(rows, 7).collect()
    for label in (0, 1):
        mine = sorted((r for r in told if r["label"] == label), key=lambda r: order(r, "42:folds"))
        assert [r["fold"] for r in mine] == [i % 7 for i in range(len(mine))]
    few = spark.createDataFrame([(i, int(i < 3)) for i in range(20)], "session_id long, label int")
    with pytest.raises(ValueError):
        training.stratified_folds(few, 5)
    with pytest.raises(ValueError):
        training.stratified_folds(few, 1)


def test_training_set_errors(rows):
    features, labels = rows.drop("label"), rows.select("session_id", "label")
    assert training.training_set(features, labels)[1] == COLS
    for bad in (labels.where("label = 1"), labels.limit(0)):
        with pytest.raises(ValueError):
            training.training_set(features, bad)


def test_search_tables_hold_scores_and_ranks(rows, spark):
    frame = grid.fold_frame(rows, COLS, 3, 42)
    trees = grid.search(frame, [({"depth": d}, training.tree_estimator(d, 1)) for d in (1, 3, 12)], 3)
    table = trees.table(spark).collect()
    assert [json.loads(r["params"])["depth"] for r in table] == [1, 3, 12]
    for r in table:
        own = [r[f"split{f}_test_roc_auc"] for f in range(3)]
        assert r["mean_test_roc_auc"] == pytest.approx(np.mean(own)) and r["std_test_roc_auc"] == pytest.approx(np.std(own))
        assert r["rank_test_roc_auc"] == 1 + sum(o["mean_test_roc_auc"] > r["mean_test_roc_auc"] for o in table)
    assert table[2]["mean_train_roc_auc"] > 0.99 > table[2]["mean_test_roc_auc"] and table[trees.best]["rank_test_roc_auc"] == 1
    fold = training.tree_estimator(3, 1).fit(frame.where("fold <> 1"))
    assert trees.scores[1, 1, 1] == pytest.approx(area(fold.transform(frame.where("fold = 1"))))
    lines = grid.search_logistic(frame, COLS, stacking.logistic_grid([0.01, 1.0]), 3)
    one = training.model_logistic(COLS, c=1.0, n=frame.where("fold <> 0").count()).fit(training.class_weights(frame.where("fold <> 0").drop("weight", "features")))
    assert lines.params[3] == {"c": 1.0, "penalty": "l2"}
    assert lines.scores[3, 0, 1] == pytest.approx(area(one.transform(frame.drop("features").where("fold = 0"))), abs=2e-3)


def test_stack_is_one_saved_model_and_its_importances(split, spark, tmp_path):
    train, test = split
    trees = {"random_forest": [{"numTrees": 5, "maxDepth": d} for d in (2, 5)], "gbt_a": [{"maxIter": 3, "maxDepth": 2}], "gbt_b": [{"maxIter": 3, "maxDepth": 3}]}
    stack = stacking.fit_stack(train, COLS, 3, trees=trees, logistic=stacking.logistic_grid([0.1, 1.0]), meta_c=[0.1, 10.0])
    assert list(stack.searches) == list(stacking.BASES) and len(stack.searches["random_forest"].params) == 2
    oof = stack.oof.toPandas()
    assert len(oof) == train.count() and oof[list(stacking.BASES)].notna().all().all()
    # a fold's scores come from the models that did not see it
    forest = stack.searches["random_forest"]
    model = forest.models[forest.best, 1]
    mine = oof[oof["fold"] == 1].set_index("session_id")["random_forest"]
    frame = training.assemble(train, COLS).where(F.col("session_id").isin([int(i) for i in mine.index]))
    from pyspark.ml.functions import vector_to_array
    seen = {r[0]: r[1] for r in model.transform(frame).select("session_id", vector_to_array("random_forest_probability")[1]).collect()}
    assert seen == pytest.approx(mine.to_dict())
    stack.model.write().overwrite().save(str(tmp_path / "stack"))
    again = PipelineModel.load(str(tmp_path / "stack"))
    told = [{r["session_id"]: r["probability"] for r in training.score_rows(m, test).collect()} for m in (stack.model, again)]
    assert told[0] == pytest.approx(told[1]) and len(told[0]) == test.count()
    assert area(stack.model.transform(test)) > 0.75
    table = stacking.stacking_importance(stack, test, area, n_repeats=2).collect()
    assert {(r["model"], r["feature"]) for r in table} == {(m, c) for m in ("stack", *stacking.BASES) for c in COLS}
    assert all(r["importance_std"] is None for r in table if r["model"] != "stack")


def gap(t, r):
    total = 0.0
    for c in COLS:  # not sum(): it compensates rounding
        total += (t[c] - r[c]) * (t[c] - r[c])
    return math.sqrt(total)


def brute(train, test, k):
    out = []
    for t in test:
        near = sorted((gap(t, r), r["session_id"], r["label"]) for r in train)[:k]
        out += [(t["session_id"], i + 1, n, lab, round(d, 9)) for i, (d, n, lab) in enumerate(near)]
    return sorted(out)


@pytest.mark.parametrize("cell_rows,block_rows,k", [(20, 15, 5), (3, 50, 9), (10_000, 40, 700)])
def test_pruned_neighbours_equal_brute_force(split, spark, cell_rows, block_rows, k):
    train, test = split
    hot = train.limit(1).select(F.explode(F.sequence(F.lit(5000), F.lit(5080))).alias("session_id"), *COLS, "label")  # one crowded point
    train = train.select("session_id", *COLS, "label").union(hot.select("session_id", *COLS, "label"))
    found = knn.nearest_neighbours(train, test, COLS, k, block_rows, cell_rows)
    told = sorted((r["test_id"], r["rank"], r["train_id"], r["train_label"], round(r["distance"], 9)) for r in found.collect())
    assert told == brute(train.collect(), test.collect(), k)


def test_bags_do_not_depend_on_partitions(rows, split):
    bags = bagging.Bags("decision_tree", 6, 0.7, 0.7)
    drawn = rows.select("session_id", *[bagging.draws(bags, b).alias(f"d{b}") for b in range(3)])
    assert sorted(map(tuple, drawn.collect())) == sorted(map(tuple, drawn.repartition(3).collect()))
    data = drawn.toPandas()
    assert abs(data["d0"].mean() - 0.7) < 0.15 and (data["d0"] != data["d1"]).any() and data["d0"].max() > 1
    once = rows.select(bagging.draws(bagging.Bags("knn", 1, 0.6, bootstrap=False), 0).alias("d")).toPandas()["d"]
    assert set(once) == {0, 1} and abs(once.mean() - 0.6) < 0.1
    assert len(bags.columns(COLS, 0)) == 2


def test_bagged_neighbours_equal_plain_votes(split):
    train, test = split
    bags = bagging.Bags("knn", 4, 0.6, 1.0, neighbours=3, subsets=1)
    told = {r["session_id"]: r["probability"] for r in bagging.model_bagging(train, test, COLS, bags).collect()}
    known = train.select("session_id", "label", *COLS, *[bagging.draws(bags, b).alias(f"d{b}") for b in range(4)]).toPandas()
    x = known[COLS].to_numpy()
    mean, std = x.mean(axis=0), x.std(axis=0)
    z = np.round((x - mean) / std, 9)
    for t in test.toPandas().itertuples():
        d = np.sqrt(((np.round((np.array([t.a, t.b, t.c]) - mean) / std, 9) - z) ** 2).sum(axis=1))
        near = known.iloc[np.lexsort((known["session_id"], d))]
        votes = []
        for b in range(4):
            labels = np.repeat(near["label"].to_numpy(), near[f"d{b}"].to_numpy())[:3]
            votes.append(labels.mean())
        assert told[t.session_id] == pytest.approx(np.mean(votes)), t


def test_compare_bagging_table(split):
    train, test = split
    families = [bagging.Bags("logistic_regression", 8, 0.8), bagging.Bags("decision_tree", 4, 0.8, 0.7, bootstrap=False, max_depth=4),
                bagging.Bags("knn", 4, 0.8, 0.7, neighbours=5, subsets=2)]

    def evaluate(told):
        return metrics.classification_metrics(told).select("*", metrics.roc_auc(told).scalar().alias("roc_auc"))
    table = bagging.compare_bagging(train, test, COLS, evaluate, families, 3).collect()
    assert {r["model"] for r in table} == {f"bagging_{f.base}" for f in families}
    assert all(0.6 < r["cv_roc_auc"] <= 1 and 0.6 < r["test_roc_auc"] <= 1 for r in table)
    assert [r["test_roc_auc"] for r in table] == sorted((r["test_roc_auc"] for r in table), reverse=True)
