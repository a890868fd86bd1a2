"""Many logistic models at once against single fits by Spark and plain formulas."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.operators import metrics, training
from clickweave.operators.many_logistic import LogisticRows, Model, areas, bag_counts

COLS = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def train(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(900, 3)) * [1, 50, 0.01] + [0, 10, 3]
    y = rng.random(900) < 1 / (1 + np.exp(-(x[:, 0] * 1.5 - (x[:, 1] - 10) / 40 - 1)))
    rows = [(i, *map(float, r), 7.0, int(t), i % 5) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "session_id long, a double, b double, c double, d double, label int, fold int").repartition(4).cache()


def test_each_model_equals_a_single_fit(train):
    models = [Model(c=c, penalty=p, fold=f) for c in (0.01, 1.0, 100.0) for p in ("l2", "l1") for f in (None, 2)]
    with LogisticRows(train, COLS) as rows:
        found = rows.fit(models)
    for m, got in zip(models, found):
        assert got.steps < 60 and abs(got.weights[3]) < 1e-9
        if m.penalty == "l2":
            mine = training.class_weights(train if m.fold is None else train.where(F.col("fold") != m.fold))
            lr = training.model_logistic(COLS, scaled=True, c=m.c, n=mine.count()).fit(mine).stages[-1]
            assert np.allclose(got.scaled[:3], lr.coefficients.toArray()[:3], rtol=5e-3, atol=2e-3)


def test_lasso_meets_its_optimality_conditions(train):
    with LogisticRows(train, COLS) as rows:
        got = rows.fit([Model(c=0.02, penalty="l1")])[0]
    data = train.toPandas()
    x = data[COLS].to_numpy()
    std = np.where(x.std(axis=0) > 1e-9, x.std(axis=0), 1)
    z = (x - x.mean(axis=0)) / std
    y = data["label"].to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    slope = (weight * (1 / (1 + np.exp(-(x @ got.weights + got.intercept))) - y)) @ z
    for s, w in zip(slope, got.scaled):
        assert abs(s + np.sign(w) / 0.02) < 1e-3 if w else abs(s) <= 50 + 1e-6
    assert (got.scaled == 0).sum() >= 2


def test_areas_equal_the_rank_metric(train):
    models = [Model(fold=f) for f in range(3)] + [Model()]
    with LogisticRows(train, COLS) as rows:
        scored = rows.scores(models, rows.fit(models))
        found = {(r["model"], r["side"]): r["roc_auc"] for r in areas(scored).collect()}
        tied = scored.withColumn("score", F.round("score", 1))
        coarse = {(r["model"], r["side"]): r["roc_auc"] for r in areas(tied).collect()}
        assert set(found) == {(i, s) for i in range(3) for s in (0, 1)} | {(3, 0)}
        for (m, side), value in found.items():
            mine = scored.where((F.col("model") == m) & (F.col("side") == side)).withColumnRenamed("score", "probability")
            assert value == pytest.approx(metrics.roc_auc(mine).first()[0])
            rounded = mine.withColumn("probability", F.round("probability", 1))
            assert coarse[m, side] == pytest.approx(metrics.roc_auc(rounded).first()[0])


def test_bags_follow_from_the_keys(train):
    keys = np.random.default_rng(0).integers(-2**63, 2**63 - 1, 200_000)
    drawn = bag_counts(keys, 4, 1.0, 42)
    assert drawn.mean() == pytest.approx(1, abs=0.02) and drawn.var() == pytest.approx(1, abs=0.03)
    half = bag_counts(keys, 4, 0.5, 42)
    assert half.mean() == pytest.approx(0.5, abs=0.02) and set(half[half > 0] == drawn[half > 0]) == {True}
    assert not np.array_equal(drawn, bag_counts(keys, 5, 1.0, 42))
    models = [Model(bag=b, share=s) for b in (0, 1) for s in (0.6, 1.0)]
    with LogisticRows(train, COLS) as one, LogisticRows(train.repartition(9, "a"), COLS) as other:
        for a, b in zip(one.fit(models), other.fit(models)):
            assert np.allclose(a.weights, b.weights)


def test_one_class_is_an_error(train):
    with LogisticRows(train.where("label = 1"), COLS) as rows, pytest.raises(ValueError):
        rows.fit([Model()])


def test_areas_of_blocks_equal_those_of_rows(train, monkeypatch):
    from clickweave.operators import many_logistic

    models = [Model(fold=f, c=c) for f in (None, 0, 3) for c in (0.1, 10.0)]
    with LogisticRows(train, COLS) as rows:
        fitted = rows.fit(models)
        want = {(r["model"], r["side"]): r["roc_auc"] for r in areas(rows.scores(models, fitted)).collect()}
        for range_rows in (1 << 20, 100):  # one range of scores, and nine
            monkeypatch.setattr(many_logistic, "RANGE_ROWS", range_rows)
            assert {(r["model"], r["side"]): r["roc_auc"] for r in rows.areas(models, fitted).collect()} == pytest.approx(want, abs=1e-12)
        tests = {r["model"] for r in rows.areas(models, fitted, sides=(1,)).collect()}
    assert tests == {i for i, m in enumerate(models) if m.fold is not None}


def test_a_part_of_the_rows_is_learned_as_if_the_rest_were_gone(train):
    parted = train.withColumn("part", training.unit_hash("session_id", 7))
    with LogisticRows(parted, COLS) as rows:
        one, = rows.fit([Model(below=0.4, fold=1)])
    with LogisticRows(parted.where("part < 0.4 AND fold <> 1"), COLS) as rows:
        two, = rows.fit([Model()])
    assert np.allclose(one.weights, two.weights) and one.intercept == pytest.approx(two.intercept)


def test_weighted_rows_equal_a_single_fit(train):
    weighted = training.class_weights(train)
    part = weighted.where("fold <> 1 AND session_id < 500")
    lr = training.model_logistic(COLS, scaled=True, n=part.count()).fit(part).stages[-1]
    with LogisticRows(part, COLS, weighted=True) as rows:
        one, = rows.fit([Model()])
    assert np.allclose(one.scaled[:3], lr.coefficients.toArray()[:3], rtol=1e-4, atol=1e-5)


def test_step_limits_share_a_path(train, monkeypatch):
    models = [Model(c=c, fold=f, max_iter=limit) for c in (1.0, 10.0) for limit in (2, 50, 500, 1000) for f in (0, 1)]
    asked, plain = [], LogisticRows._derivatives
    monkeypatch.setattr(LogisticRows, "_derivatives", lambda self, units, of, *more: asked.append(len(of)) or plain(self, units, of, *more))
    with LogisticRows(train, COLS) as rows:
        many = rows.fit(models)
        assert max(asked) == 4  # 2 strengths on 2 folds
        for m, got in [*zip(models, many)][:3]:
            one, = rows.fit([m])
            assert np.allclose(one.weights, got.weights) and one.intercept == pytest.approx(got.intercept) and one.steps == got.steps
        assert many[0].steps == 2 < many[2].steps
        found = {(r["model"], r["side"]): r["roc_auc"] for r in rows.areas(models, many).collect()}
        for r in rows.areas(models[2:3], many[2:3]).collect():
            assert found[2, r["side"]] == pytest.approx(r["roc_auc"]) == found[6, r["side"]]
        assert len(found) == 2 * len(models)
