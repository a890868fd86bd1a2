"""Many logistic models at once (L-05, L-10, L-13, L-14, M-11).

A search over penalties, folds and bags fits hundreds of small linear models
of the same rows. Here they share the passes: each Newton step of all models
that still move is one pass, which adds up losses, gradients and Hessians (a
few hundred numbers a model) per partition. The penalised step of each model
is solved on the driver, by a linear system (ridge) or coordinate descent
(lasso). Classes are balanced and, if asked for, columns standardised within
the rows each model learns from, from one further pass.

A model learns from the rows outside its fold, each as often as its bag draws
it: a Poisson count from a hash of the row's key and the bag, so any
partitioning and any retry gives the same bags.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.operators.many_means import _matrix, _summed, _emit, _uniform
from clickweave.session import ship_package

CHUNK_VALUES = 1 << 20  # row x model values held at once by a task
BLOCK_VALUES = 1 << 22  # scores a task gathers before it hands on sorted blocks
RANGE_ROWS = 1 << 20  # rows of a model, about, in one range of scores
_POISSON = np.cumsum([np.exp(-1.0) / float(np.prod(range(1, i + 1))) for i in range(12)])  # of mean 1


@dataclass(frozen=True)
class Model:
    """What one model learns from and how it is penalised: strength 1 / c of ``penalty`` on the standardised weights."""

    c: float = 1.0
    penalty: str = "l2"
    fold: int | None = None  # rows of this fold are left out
    bag: int | None = None  # rows are drawn with replacement
    share: float = 1.0  # of the rows a bag sees
    max_iter: int = 1000
    below: float | None = None  # only rows whose ``part`` is less

    @property
    def unit(self) -> tuple:
        return self.fold, self.bag, self.share, self.below


@dataclass
class Fitted:
    """Weights of the plain columns, and the intercept."""

    weights: np.ndarray
    intercept: float
    scaled: np.ndarray
    steps: int


def bag_counts(keys: np.ndarray, bag: int, share: float, seed: int) -> np.ndarray:
    """How often a bag draws each row: zero for rows outside its share, else Poisson of mean 1."""
    drawn = np.searchsorted(_POISSON, _uniform(keys, seed * 7919 + 2 * bag + 1)).astype(np.float64)
    return drawn if share >= 1 else drawn * (_uniform(keys, seed * 7919 + 2 * bag) < share)


class LogisticRows:
    """Training rows (columns, label 0/1, fold, key, part, weight) persisted as plain columns.

    ``weighted``: rows count by their ``weight`` column and columns are scaled by sample deviations, as in
    ``training.model_logistic``; else classes are balanced within the rows a model learns from.
    """

    def __init__(self, df: DataFrame, cols: Sequence[str], seed: int = 42, scale: bool = True, weighted: bool = False) -> None:
        ship_package(df.sparkSession)
        self.p, self.seed, self.scale, self.weighted = len(cols), seed, scale, weighted
        fold = F.col("fold").cast("int") if "fold" in df.columns else F.lit(-1)
        part = F.col("part").cast("double") if "part" in df.columns else F.lit(0.0)
        self.df = df.select(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)).alias(f"c{i}") for i, c in enumerate(cols)],
                            F.col("label").cast("int").alias("label"), fold.alias("fold"), F.xxhash64("session_id").alias("key"), part.alias("part"),
                            (F.col("weight").cast("double") if weighted else F.lit(1.0)).alias("weight")).persist()

    def __enter__(self) -> LogisticRows:
        return self

    def __exit__(self, *_: object) -> None:
        self.df.unpersist()

    def _parts(self, batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, ...]]:
        step, p = max(1, CHUNK_VALUES // max(width, 1)), self.p
        for batch in batches:
            for lo in range(0, batch.num_rows, step):
                rows = batch.slice(lo, step)
                yield _matrix(rows, p), *(rows.column(p + i).to_numpy() for i in range(5))

    def _weights(self, units: list[tuple], fold: np.ndarray, key: np.ndarray, part: np.ndarray) -> np.ndarray:
        out = np.ones((len(key), len(units)))
        for i, (left, bag, share, below) in enumerate(units):
            if bag is not None:
                out[:, i] = bag_counts(key, bag, share, self.seed)
            if left is not None:
                out[fold == left, i] = 0
            if below is not None:
                out[part >= below, i] = 0
        return out

    def _moments(self, units: list[tuple]) -> np.ndarray:
        """(negatives, positives, sums, squares, weight) of each unit."""
        me = self._plain()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(units), 3 + 2 * me.p))
            for x, label, fold, key, part, given in me._parts(batches, len(units)):
                w = me._weights(units, fold, key, part)
                total += w.T @ np.concatenate([(label == 0)[:, None], (label == 1)[:, None], x, x * x, given[:, None]], axis=1)
            yield _emit(total)
        return _summed(self.df, run, len(units), 3 + 2 * self.p)

    def _plain(self) -> _Plain:
        return _Plain(self.p, self.seed)

    def fit(self, models: Sequence[Model], tol: float = 1e-6) -> list[Fitted]:
        units = sorted({m.unit for m in models}, key=str)
        found = self._moments(units)
        p, of = self.p, [units.index(m.unit) for m in models]
        n = found[:, :2].sum(axis=1)
        if (found[:, :2] == 0).any():
            raise ValueError("a model would learn from one class only")
        mean = found[:, 2:2 + p] / n[:, None]
        std = np.sqrt(np.maximum(found[:, 2 + p:2 + 2 * p] / n[:, None] - mean**2, 0))
        std[std < 1e-12 * (1 + np.abs(mean))] = 1.0
        if not self.scale:
            mean, std = np.zeros_like(mean), np.ones_like(std)
        balance = n[:, None] / (2 * found[:, :2])  # class weights
        strength = np.ones(len(units))
        if self.weighted:
            balance, strength = np.ones_like(balance), found[:, -1] / n
            std *= np.sqrt(n / np.maximum(n - 1, 1))[:, None] if self.scale else 1
        # models that differ in their step limit only take the same path, each as far as its limit
        paths: dict[tuple, list[int]] = defaultdict(list)
        for i, m in enumerate(models):
            paths[m.c, m.penalty, of[i]].append(i)
        state = [_Newton(max((models[i] for i in same), key=lambda m: m.max_iter), p, strength[u] / c) for (c, _, u), same in paths.items()]
        way = list(paths)
        stops: dict[int, Fitted] = {}
        for _ in range(max(m.max_iter for m in models)):
            live = [j for j, s in enumerate(state) if not s.done]
            if not live:
                break
            raw = np.stack([state[j].plain(mean[way[j][2]], std[way[j][2]]) for j in live])
            sums = self._derivatives(units, [way[j][2] for j in live], balance, raw)
            for j, row in zip(live, sums):
                u = way[j][2]
                state[j].move(row, mean[u], std[u], tol)
                for i in paths[way[j]]:
                    if i not in stops and state[j].steps >= models[i].max_iter:
                        stops[i] = state[j].fitted(mean[u], std[u])
        for (_, _, u), same, s in zip(way, paths.values(), state):
            last = s.fitted(mean[u], std[u])
            stops |= {i: last for i in same if i not in stops}
        return [stops[i] for i in range(len(models))]

    def _derivatives(self, units: list[tuple], of: list[int], balance: np.ndarray, raw: np.ndarray) -> np.ndarray:
        """Per model: loss, gradient and upper Hessian triangle in plain columns (intercept first)."""
        p, me = self.p, self._plain()
        a, b = np.triu_indices(p + 1)
        of = np.array(of)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(raw), 1 + p + 1 + len(a)))
            for x, label, fold, key, part, given in me._parts(batches, 4 * len(raw) + len(a)):
                x1 = np.concatenate([np.ones((len(x), 1)), x], axis=1)
                w = (me._weights(units, fold, key, part) * balance[:, label].T * given[:, None])[:, of]
                logit = x1 @ raw.T
                chance = 1 / (1 + np.exp(-np.clip(logit, -500, 500)))
                total[:, 0] += (w * (np.logaddexp(0, logit) - logit * label[:, None])).sum(axis=0)
                total[:, 1:p + 2] += (w * (chance - label[:, None])).T @ x1
                total[:, p + 2:] += (w * chance * (1 - chance)).T @ (x1[:, a] * x1[:, b])
            yield _emit(total)
        return _summed(self.df, run, len(raw), 1 + p + 1 + len(a))

    def scores(self, models: Sequence[Model], fitted: Sequence[Fitted]) -> DataFrame:
        """(model, side, label, score) of every row under every model; side 1 are the rows a model's fold left out."""
        me, p = self._plain(), self.p
        weights = np.stack([np.append(f.intercept, f.weights) for f in fitted])
        folds = np.array([-1 if m.fold is None else m.fold for m in models])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x, label, fold, *_ in me._parts(batches, 8 * len(weights)):
                chance = 1 / (1 + np.exp(-np.clip(np.concatenate([np.ones((len(x), 1)), x], axis=1) @ weights.T, -500, 500)))
                out = (folds >= 0) & (fold[:, None] == folds)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(len(weights), dtype=np.int32), len(x))), pa.array(out.ravel().astype(np.int32)),
                     pa.array(np.repeat(label, len(weights)).astype(np.int32)), pa.array(chance.ravel())], ["model", "side", "label", "score"])
        return self.df.mapInArrow(run, "model int, side int, label int, score double")

    def areas(self, models: Sequence[Model], fitted: Sequence[Fitted], sides: Sequence[int] = (0, 1)) -> DataFrame:
        """``areas`` of ``scores``, with a row for each sorted block of scores in place of a row a score."""
        me, wanted = self._plain(), tuple(sides)
        alike: dict[tuple, list[int]] = defaultdict(list)  # models of equal weights and fold are scored once
        for i, (m, f) in enumerate(zip(models, fitted)):
            alike[m.fold, f.intercept, f.weights.tobytes()].append(i)
        firsts = [same[0] for same in alike.values()]
        weights = np.stack([np.append(fitted[i].intercept, fitted[i].weights) for i in firsts])
        folds = [models[i].fold for i in firsts]
        ranges = max(1, -(-self.df.count() // RANGE_ROWS))
        edges = np.arange(1, ranges) / ranges

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = defaultdict(list), 0
            for x, label, fold, *_ in me._parts(batches, 2 * len(weights)):
                chance = 1 / (1 + np.exp(-np.clip(weights[:, 1:] @ x.T + weights[:, :1], -500, 500)))
                for left in set(folds):
                    own = fold == left if left is not None else np.zeros(len(x), bool)
                    pick = {(side, value): np.flatnonzero((own == bool(side)) & (label == value)) for side in wanted for value in (0, 1)}
                    for m in (i for i, f in enumerate(folds) if f == left):
                        for (side, value), rows in pick.items():
                            if len(rows):
                                held[m, side, value].append(chance[m, rows])
                size += chance.size
                if size >= BLOCK_VALUES:
                    yield score_blocks(held, edges)
                    held, size = defaultdict(list), 0
            yield score_blocks(held, edges)
        found = areas_of_blocks(self.df, run)
        named = F.get(F.array(*[F.array(*map(F.lit, same)) for same in alike.values()]), F.col("model"))
        return found.select(F.explode(named).alias("model"), "side", "roc_auc")


def score_blocks(held: dict, edges: np.ndarray) -> pa.RecordBatch:
    """Rows (model, side, range, label, sorted scores) of the lists of scores of each (model, side, label)."""
    out: list[tuple] = []
    for (m, side, label), parts in held.items():
        scores = np.sort(np.concatenate(parts))
        for at, block in enumerate(np.split(scores, np.searchsorted(scores, edges))):
            if len(block):
                out.append((m, side, at, label, block.tobytes()))
    kinds = [pa.int32()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], ["model", "side", "range", "label", "scores"])


def areas_of_blocks(rows: DataFrame, run) -> DataFrame:
    """(model, side, roc_auc) from the ``score_blocks`` that ``run`` makes of each partition of ``rows``."""
    return _from_parts(rows.mapInArrow(run, "model int, side int, range int, label int, scores binary").groupBy(
        "model", "side", "range").applyInPandas(_won, "model int, side int, _range int, u double, pos long, neg long"))


def areas_in_blocks(scores: DataFrame, rows: int) -> DataFrame:
    """``areas`` of (model, side, label, score), with a row for each sorted block of scores in place of a row a score; ``rows``: about those of a model."""
    ship_package(scores.sparkSession)
    ranges = max(1, -(-rows // RANGE_ROWS))
    edges = np.arange(1, ranges) / ranges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(list), 0
        for batch in batches:
            model, side, label, score = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            for m, s in {*zip(model.tolist(), side.tolist())}:
                for value in (0, 1):
                    held[m, s, value].append(score[(model == m) & (side == s) & (label == value)])
            size += len(score)
            if size >= BLOCK_VALUES:
                yield score_blocks(held, edges)
                held, size = defaultdict(list), 0
        yield score_blocks(held, edges)
    return areas_of_blocks(scores, run)


def _won(part: pd.DataFrame) -> pd.DataFrame:
    """Pairs of a range in which the row of class 1 scores higher, ties counted one half, and its rows of either class."""
    neg, pos = (np.sort(np.concatenate([np.zeros(0), *(np.frombuffer(b) for b in part["scores"][part["label"] == c])])) for c in (0, 1))
    u = float(np.searchsorted(neg, pos, "left").sum() + np.searchsorted(neg, pos, "right").sum()) / 2
    return pd.DataFrame({"model": part["model"].iloc[:1], "side": part["side"].iloc[:1], "_range": part["range"].iloc[:1], "u": [u], "pos": [len(pos)], "neg": [len(neg)]})


class _Plain(LogisticRows):
    """What tasks need of the rows: no session, no table."""

    def __init__(self, p: int, seed: int) -> None:
        self.p, self.seed = p, seed


class _Newton:
    """One model's path, over standardised columns; the intercept (first) is not penalised."""

    def __init__(self, model: Model, p: int, strength: float) -> None:
        self.model, self.strength, self.at, self.done, self.steps = model, strength, np.zeros(p + 1), False, 0
        self.before: tuple[float, np.ndarray] | None = None

    def plain(self, mean: np.ndarray, std: np.ndarray) -> np.ndarray:
        w = self.at[1:] / std
        return np.append(self.at[0] - w @ mean, w)

    def fitted(self, mean: np.ndarray, std: np.ndarray) -> Fitted:
        raw = self.plain(mean, std)
        return Fitted(raw[1:], float(raw[0]), self.at[1:], self.steps)

    def move(self, sums: np.ndarray, mean: np.ndarray, std: np.ndarray, tol: float) -> None:
        size, strength = len(self.at), self.strength
        lasso = self.model.penalty == "l1"
        value = sums[0] + strength * (np.abs(self.at[1:]).sum() if lasso else (self.at[1:] ** 2).sum() / 2)
        if self.before is not None and value > self.before[0] + 1e-9 * abs(self.before[0]):  # too far: go half the way back
            back = (self.at + self.before[1]) / 2
            self.done = bool(np.abs(back - self.at).max() <= tol)
            self.at = back
            return
        hessian = np.zeros((size, size))
        hessian[np.triu_indices(size)] = sums[1 + size:]
        hessian = hessian + np.triu(hessian, 1).T
        # standardised columns are T' of the plain ones
        turn = np.diag(np.append(1.0, 1 / std))
        turn[0, 1:] = -mean / std
        gradient, hessian = turn.T @ sums[1:1 + size], turn.T @ hessian @ turn
        hessian += np.eye(size) * 1e-9 * max(np.trace(hessian) / size, 1e-9)
        if lasso:
            new = self._lasso(gradient, hessian, strength)
        else:
            ridge = np.append(0.0, np.full(size - 1, strength))
            new = self.at - np.linalg.solve(hessian + np.diag(ridge), gradient + ridge * self.at)
        self.before, self.steps = (value, self.at), self.steps + 1
        self.done = bool(np.abs(new - self.at).max() <= tol) or self.steps >= self.model.max_iter
        self.at = new

    def _lasso(self, gradient: np.ndarray, hessian: np.ndarray, strength: float) -> np.ndarray:
        new = self.at.copy()
        for _ in range(200):
            widest = 0.0
            for j in range(len(new)):
                slope = gradient[j] + hessian[j] @ (new - self.at)
                goal = new[j] - slope / hessian[j, j]
                if j:
                    goal = np.sign(goal) * max(abs(goal) - strength / hessian[j, j], 0.0)
                widest, new[j] = max(widest, abs(goal - new[j])), goal
            if widest < 1e-9:
                break
        return new


SCORE_BUCKETS = 1024


def areas(scores: DataFrame) -> DataFrame:
    """(model, side, roc_auc) from rows (model, side, label, score in [0, 1]), ties counted one half.

    Rows are counted per distinct score first; running sums stay inside one of
    SCORE_BUCKETS score ranges of a model, and each range adds what lies below
    it, read from a table of a row a range.
    """
    per = scores.groupBy("model", "side", "score").agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg"))
    per = per.withColumn("_range", F.least(F.floor(F.col("score") * SCORE_BUCKETS), F.lit(SCORE_BUCKETS - 1)).cast("int"))
    inside = Window.partitionBy("model", "side", "_range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    part = per.withColumn("_below", F.coalesce(F.sum("neg").over(inside), F.lit(0))).groupBy("model", "side", "_range").agg(
        F.sum(F.col("pos") * (F.col("_below") + F.col("neg") / 2)).alias("u"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return _from_parts(part)


def _from_parts(part: DataFrame) -> DataFrame:
    """Areas from the ranges of each model: (model, side, _range, u, pos, neg), u of the pairs inside a range."""
    before = Window.partitionBy("model", "side").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    part = part.withColumn("u", F.col("u") + F.col("pos") * F.coalesce(F.sum("neg").over(before), F.lit(0)))
    return part.groupBy("model", "side").agg((F.sum("u") / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))
