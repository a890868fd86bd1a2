"""Grid search on ROC AUC over fixed folds (L-13, L-14, M-11).

Rows are assembled once and kept with their folds; every configuration and
fold reads the same frame. Logistic grids, decision trees and forests are fitted together
(``many_logistic``, ``many_trees``); other estimators run as concurrent jobs.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators import training
from clickweave.operators.many_logistic import LogisticRows, Model, areas_in_blocks
from clickweave.operators.many_trees import Tree, TreeRows, forest_areas
from clickweave.session import shared_table

Scores = dict[tuple[int, int, int], float]  # (configuration, fold, side): area; side 1 is the fold's own rows


@dataclass
class Search:
    """What a search found: a row per configuration, the best one, and its fold models (if kept)."""

    params: list[dict]
    scores: Scores
    k: int
    models: dict[tuple[int, int], object] = field(default_factory=dict)

    def _of(self, config: int, side: int) -> list[float]:
        return [self.scores[config, f, side] for f in range(self.k)]

    def mean(self, config: int, side: int = 1) -> float:
        return sum(self._of(config, side)) / self.k

    @property
    def best(self) -> int:
        """Configuration of the greatest mean test score (ties: the earlier)."""
        return max(range(len(self.params)), key=lambda c: (self.mean(c), -c))

    def rows(self) -> list[tuple]:
        means = [self.mean(c) for c in range(len(self.params))]
        out = []
        for c, params in enumerate(self.params):
            row = [json.dumps(params), 1 + sum(m > means[c] for m in means)]
            for side in (1, 0):
                own, mean = self._of(c, side), self.mean(c, side)
                row += [mean, (sum((x - mean) ** 2 for x in own) / self.k) ** 0.5, *own]
            out.append(tuple(row))
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """(params, rank_test_roc_auc, mean / std / split scores of test and train), in the order of the grid."""
        names = [f"{what}_{side}_roc_auc" for side in ("test", "train") for what in ("mean", "std", *[f"split{f}" for f in range(self.k)])]
        return spark.createDataFrame(self.rows(), ", ".join(["params STRING", "rank_test_roc_auc INT", *[f"{n} DOUBLE" for n in names]]))


def fold_frame(train: DataFrame, cols: Sequence[str], k: int, seed: int) -> DataFrame:
    """(session_id, label, weight, fold, columns, features): assembled and balanced once, sized to its rows, persisted."""
    folded = train if "fold" in train.columns else training.stratified_folds(train, k, seed)
    if "weight" not in folded.columns:
        folded = training.class_weights(folded)
    rows = training.assemble(folded.select("session_id", "label", "weight", "fold", *cols), cols)
    return training.right_size(shared_table(rows, "folds")).persist()


def side_by_side(spark: SparkSession, fn: Callable, tasks: Sequence, parallelism: int = 8) -> list:
    with ThreadPool(max(1, min(parallelism, len(tasks)))) as pool:
        return pool.map(inheritable_thread_target(spark)(fn), tasks, chunksize=1)


def model_areas(frame: DataFrame, models: Sequence) -> dict[tuple[int, int], float]:
    """ROC AUC by (fold, side): the model at place f, which did not see fold f, scores all rows; all models in one pass."""
    from pyspark.ml.functions import vector_to_array

    cores = frame.sparkSession.sparkContext.defaultParallelism
    told = frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame
    for f, model in enumerate(models):
        stage = model.stages[-1] if hasattr(model, "stages") else model
        told = model.transform(told).select(*told.columns, vector_to_array(stage.getProbabilityCol())[1].alias(f"_score{f}"))
    scores = told.select("label", "fold", F.posexplode(F.array(*[F.col(f"_score{f}") for f in range(len(models))])).alias("model", "score"))
    sides = scores.select("model", (F.col("fold") == F.col("model")).cast("int").alias("side"), "label", "score")
    return {(r["model"], r["side"]): r["roc_auc"] for r in areas_in_blocks(sides, frame.count()).collect()}


def search(frame: DataFrame, configs: Sequence[tuple[dict, object]], k: int, parallelism: int = 8, keep: bool = False,
           families: Sequence[str] | None = None) -> Search:
    """Fits every (params, estimator over ``features`` and ``weight``) on every fold's complement.

    A configuration's fold models score all rows in one pass and go then, unless ``keep``; with ``families`` (a name a
    configuration) the best configuration of each is kept only, so a long list needs no more memory than a short one."""
    scores: Scores = {}
    kept: dict[int, list] = {}
    leader: dict[str, tuple[float, int]] = {}
    lock = Lock()

    def run(c: int) -> None:
        fitted = [configs[c][1].fit(frame.where(F.col("fold") != f)) for f in range(k)]
        found = model_areas(frame, fitted)
        with lock:
            scores.update({(c, f, side): area for (f, side), area in found.items()})
            if not keep:
                return
            kept[c] = fitted
            if families is not None:
                mine, name = (sum(found[f, 1] for f in range(k)) / k, -c), families[c]
                worse = min(mine, leader.get(name, mine))
                leader[name] = max(mine, leader.get(name, mine))
                if worse != leader[name]:
                    del kept[-worse[1]]

    side_by_side(frame.sparkSession, run, range(len(configs)), parallelism)
    return Search([p for p, _ in configs], scores, k, {(c, f): model for c, fitted in kept.items() for f, model in enumerate(fitted)})


def search_logistic(frame: DataFrame, cols: Sequence[str], grid: Sequence[dict], k: int, seed: int = 42, scale: bool = True) -> Search:
    """Logistic configurations (dicts of ``c``, ``penalty``, ``max_iter``) on every fold's complement, all in the same passes."""
    models = [Model(fold=f, **params) for params in grid for f in range(k)]
    with LogisticRows(frame, cols, seed, scale) as rows:
        found = rows.areas(models, rows.fit(models)).collect()
    scores = {(r["model"] // k, r["model"] % k, r["side"]): r["roc_auc"] for r in found}
    return Search(list(grid), scores, k)


def search_trees(frame: DataFrame, cols: Sequence[str], grid: Sequence[dict], k: int, seed: int = 42) -> Search:
    """Decision trees (dicts of ``maxDepth``, ``minInstancesPerNode``) on every fold's complement, all in the same passes."""
    trees = [Tree(tuple(range(len(cols))), params["maxDepth"], params["minInstancesPerNode"], f) for params in grid for f in range(k)]
    with TreeRows(frame, cols, seed) as rows:
        found = rows.areas(trees, rows.grow(trees)).collect()
    return Search(list(grid), {(r["model"] // k, r["model"] % k, r["side"]): r["roc_auc"] for r in found}, k)


def columns_tried(strategy: str, p: int) -> int:
    """Columns that ``pyspark.ml``'s forests draw for a split."""
    return {"all": p, "onethird": math.ceil(p / 3), "log2": max(1, math.ceil(math.log2(p)))}.get(strategy, math.ceil(math.sqrt(p)))


def search_forests(frame: DataFrame, cols: Sequence[str], grid: Sequence[dict], k: int, seed: int = 42, parallelism: int = 4) -> Search:
    """Random forests (dicts of ``numTrees``, ``maxDepth``, ``minInstancesPerNode``, ``featureSubsetStrategy``) on every fold's complement.

    Settings that differ in number and depth of trees, or in names of an equal number of columns, share their trees."""
    kinds: dict[tuple[int, int], list[int]] = defaultdict(list)
    for i, params in enumerate(grid):
        kinds[params.get("minInstancesPerNode", 1), columns_tried(params.get("featureSubsetStrategy", "auto"), len(cols))].append(i)
    tasks = [(kind, f) for f in range(k) for kind in kinds]
    cores = frame.sparkSession.sparkContext.defaultParallelism
    with TreeRows(frame.repartition(cores) if frame.rdd.getNumPartitions() < cores else frame, cols, seed) as rows:
        def run(task: tuple) -> dict:
            (leaf, tried), f = task
            depths, sizes = (sorted({grid[i][name] for i in kinds[leaf, tried]}) for name in ("maxDepth", "numTrees"))
            return forest_areas(rows, Tree(tuple(range(len(cols))), depths[-1], leaf, f, tried=tried), depths, sizes)
        found = dict(zip(tasks, side_by_side(frame.sparkSession, run, tasks, parallelism)))
    scores = {(i, f, side): found[kind, f][grid[i]["numTrees"], grid[i]["maxDepth"], side]
              for kind, f in tasks for i in kinds[kind] for side in (0, 1)}
    return Search(list(grid), scores, k)
