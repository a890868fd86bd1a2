"""Exact top-k inner products: ball-tree branch and bound per shard.

Vectors go to the cell of the nearest of some pivots, so that a cell is a ball
around its pivot, and cells are split by a hash of the id into shards that fit
in a task. Each shard builds a ball tree; a query visits its nodes in the
order of the bound

    <q, centre> + |q| * radius   (the largest inner product a ball can hold)

and stops at a node whose bound is below the score that k vectors already
reach. That score is shared between shards: a query searches its cells in
rounds, in the order of the same bound, and carries its current k-th score
from round to round. A cell whose bound is below it is never sent the query,
so such pairs are dropped before the shuffle.

Vectors are copied to as many tasks as the queries of their shard fill blocks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import Scratch

LEAF = 64
SHARD_VALUES = 1 << 22  # components in a shard, about
QUERY_BLOCK = 8192
CELL_ROWS = 1024
LEAST_CELLS, MOST_CELLS = 24, 256  # pivots are sent to every task: 256 of 16,384 components at most are 32 MB
MOST_DIM = 1 << 14  # longer vectors have no pivots, and so no bound: each of their queries sees every shard
ROUNDS = (1, 4, MOST_CELLS)  # cells searched by the end of each round
_EXACT = 2.0**53
_LONG = 2**63 - 1


class BallTree:
    """Ball tree over integer vectors with ids; ties in score go to the smaller id."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF) -> None:
        self.order = np.lexsort((ids,))
        points = vectors.astype(np.float64)
        self.children: list[tuple[int, int]] = []
        self.span: list[tuple[int, int]] = []
        centres, radii, least = [], [], []
        order = self.order
        todo = [(0, len(ids), -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            here = points[order[a:b]]
            centre = here.mean(axis=0)
            away = np.sqrt(((here - centre) ** 2).sum(axis=1))
            node = len(radii)
            centres.append(centre)
            radii.append(away.max())
            least.append(ids[order[a:b]].min())
            self.children.append((-1, -1))
            self.span.append((a, b))
            if parent >= 0:
                pair = list(self.children[parent])
                pair[side] = node
                self.children[parent] = tuple(pair)
            if b - a > leaf and radii[-1] > 0:
                # two far points pull the others apart
                left = here[away.argmax()]
                to_left = ((here - left) ** 2).sum(axis=1)
                right = here[to_left.argmax()]
                nearer = to_left - ((here - right) ** 2).sum(axis=1)
                rank = np.argsort(nearer, kind="stable")
                middle = int(np.clip((nearer <= 0).sum(), (b - a) // 8 + 1, b - a - (b - a) // 8 - 1))
                order[a:b] = order[a:b][rank]
                todo += [(a, a + middle, node, 0), (a + middle, b, node, 1)]
        self.centres, self.radii, self.least = np.array(centres), np.array(radii), np.array(least)
        self.vectors, self.ids = vectors[order], ids[order]
        for node, (a, b) in enumerate(self.span):  # ids ascend inside a leaf
            if self.children[node][0] < 0:
                rank = np.argsort(self.ids[a:b], kind="stable")
                self.vectors[a:b], self.ids[a:b] = self.vectors[a:b][rank], self.ids[a:b][rank]
        self.size = np.abs(points).max(initial=0.0)

    def search(self, queries: np.ndarray, own: np.ndarray, floors: np.ndarray, k: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
        """For each query the (score, id) pairs that can be among its k best: at least ``floor``, k at most, its own id left out."""
        wide = np.abs(queries.astype(np.float64)).max(initial=0.0) * self.size * max(queries.shape[1], 1) >= _EXACT
        vectors = self.vectors.astype(object) if wide else self.vectors.astype(np.float64)
        asked = queries.astype(object) if wide else queries.astype(np.float64)
        real = queries.astype(np.float64)
        norm = np.sqrt((real**2).sum(axis=1))
        bounds = real @ self.centres.T + norm[:, None] * self.radii
        bounds += 1e-9 * (np.abs(bounds) + norm[:, None] * (self.radii + np.sqrt((self.centres**2).sum(axis=1)))) + 1e-6
        for i in range(len(queries)):
            bound, me = bounds[i], own[i]
            best: list[tuple[int, int]] = []  # a heap of (score, -id): the worst on top
            low = floors[i]
            nodes = [(-bound[0], 0)]
            while nodes:
                top, node = heapq.heappop(nodes)
                if -top < low:
                    break
                if len(best) == k and -top < best[0][0] + 1 and self.least[node] > -best[0][1]:
                    continue  # scores are whole: it can only tie, and its ids are larger
                left, right = self.children[node]
                if left >= 0:
                    for child in (left, right):
                        if bound[child] >= low:
                            heapq.heappush(nodes, (-bound[child], child))
                    continue
                a, b = self.span[node]
                scores = vectors[a:b] @ asked[i]
                some = np.flatnonzero(scores >= low) if not wide else range(b - a)
                for j in some:
                    if self.ids[a + j] != me:
                        found = (int(scores[j]), -int(self.ids[a + j]))
                        if len(best) < k:
                            heapq.heappush(best, found)
                        elif found > best[0]:
                            heapq.heapreplace(best, found)
                if len(best) == k:
                    low = max(low, best[0][0])
            yield i, [(s, -n) for s, n in best]


def _search(k: int):
    def run(key: tuple, vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(vectors) and len(queries):
            tree = BallTree(np.stack(vectors["v"].to_numpy()).astype(np.int64), vectors["vec_id"].to_numpy())
            asked, own = np.stack(queries["v"].to_numpy()).astype(np.int64), queries["vec_id"].to_numpy()
            for i, best in tree.search(asked, own, queries["floor"].to_numpy(), k):
                for score, vec in best:
                    out["query_id"].append(own[i])
                    out["vec_id"].append(vec)
                    out["score"].append(min(max(score, -_LONG - 1), _LONG))
        return pd.DataFrame(out).astype("int64")
    return run


def scaled(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as long; null unless all components are finite."""
    x = F.transform(vector, lambda e: e.cast("double"))
    good = vector.isNotNull() & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return F.when(good, F.transform(x, lambda e: F.floor(e * F.lit(float(scale))).cast("long")))


def _per_query(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Cells:
    """Pivots by dimension, and the radius of the ball around each that holds its cell."""

    def __init__(self, vectors: list[list[int]]) -> None:
        by_dim: dict[int, list] = {}
        for v in vectors:
            if v not in by_dim.setdefault(len(v), []):
                by_dim[len(v)].append(v)
        self.pivots = {dim: np.array(rows, dtype=np.float64).reshape(len(rows), dim) for dim, rows in by_dim.items()}
        self.radii = {dim: np.full(len(rows), -np.inf) for dim, rows in by_dim.items()}  # no rows: no bound is reached

    def nearest(self, dim: int, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each row and its distance from the pivot; cell -1 where the dimension has no pivots."""
        if dim not in self.pivots:
            return np.full(len(rows), -1), np.zeros(len(rows))
        pivots = self.pivots[dim]
        cell = ((pivots**2).sum(axis=1) - 2 * rows @ pivots.T).argmin(axis=1)
        return cell, np.sqrt(((rows - pivots[cell]) ** 2).sum(axis=1))

    def bounds(self, dim: int, rows: np.ndarray) -> np.ndarray:
        """The largest inner product each row can have with a vector of each cell."""
        if dim not in self.pivots:
            return np.full((len(rows), 1), np.inf)
        pivots, radii = self.pivots[dim], self.radii[dim]
        norm = np.sqrt((rows**2).sum(axis=1))[:, None]
        far = np.where(np.isfinite(radii), radii, 0)
        bound = rows @ pivots.T + norm * far
        bound += 1e-9 * (np.abs(bound) + norm * (far + np.sqrt((pivots**2).sum(axis=1)))) + 1e-6
        return np.where(np.isfinite(radii), bound, -np.inf)


def _dims(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The rows of a batch by the length of their vector (second column): (length, row numbers, vectors)."""
    lists = batch.column(1)
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat, first = lists.flatten().to_numpy().astype(np.float64), np.concatenate([[0], np.cumsum(size)])
    for dim in np.unique(size).tolist():
        at = np.flatnonzero(size == dim)
        yield dim, at, flat[first[at][:, None] + np.arange(dim)].reshape(len(at), dim)


def _place(cells: Cells):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, away = np.full(batch.num_rows, -1), np.zeros(batch.num_rows)
            for dim, at, rows in _dims(batch):
                cell[at], away[at] = cells.nearest(dim, rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(away)], [*batch.schema.names, "cell", "away"])
    return run


def _route(cells: Cells, begin: int, end: int):
    """Queries (vec_id, v, dim, floor) to the cells begin <= place < end in the order of their bound that can reach the floor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            floor = batch.column(3).to_numpy()
            for dim, at, rows in _dims(batch):
                bound = cells.bounds(dim, rows)
                order = np.argsort(-bound, axis=1, kind="stable")[:, begin:end]
                reach = np.take_along_axis(bound, order, axis=1)
                row, place = np.nonzero((reach >= floor[at][:, None]) & (reach > -np.inf))
                cell = order[row, place] if dim in cells.pivots else np.full(len(row), -1)
                yield pa.RecordBatch.from_arrays([c.take(pa.array(at[row])) for c in batch.columns] + [pa.array(cell.astype(np.int32))],
                                                 [*batch.schema.names, "cell"])
    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 5, shard_values: int = SHARD_VALUES, query_block: int = QUERY_BLOCK) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k largest inner products of each query with the other vectors.

    ``vectors`` has vec_id and v (array of long); ``queries`` says which rows
    ask. All rows but the query's own are candidates; ties go to the smaller
    vec_id; with fewer than k candidates all are returned. Null vectors and
    null ids take no part. Of rows that repeat a vec_id one takes part, that
    with the smallest v. Vectors of different length are compared with their
    like only. Scores outside 64 bits become the nearest 64-bit number. Other
    columns are not read. ``shard_values`` and ``query_block`` bound what a
    task holds; they don't change the rows.
    """
    scratch = Scratch(vectors.sparkSession, "topk")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "v", queries.alias("asks")).where("vec_id IS NOT NULL AND v IS NOT NULL")
    rows = rows.groupBy("vec_id").agg(F.min(F.struct("v", "asks")).alias("r"))
    rows = scratch.table(rows.select("vec_id", "r.v", F.size("r.v").alias("dim"), "r.asks"), "rows")
    n = rows.count()
    wanted = min(max(n // CELL_ROWS, LEAST_CELLS), MOST_CELLS)
    cells = Cells([r["v"] for r in rows.where(F.col("dim") <= MOST_DIM).orderBy(F.xxhash64("vec_id")).limit(wanted).select("v").collect()])
    placed = scratch.table(rows.select("vec_id", "v", "dim", "asks").mapInArrow(
        _place(cells), "vec_id long, v array<long>, dim int, asks boolean, cell int, away double"), "placed")
    sizes = scratch.table(placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.max("away").alias("radius")).withColumn(
        "shards", F.ceil(F.col("n") * F.greatest("dim", F.lit(1)) / F.lit(shard_values)).cast("int")), "cells")
    for r in sizes.where("cell >= 0").collect():  # a row a pivot
        cells.radii[r["dim"]][r["cell"]] = r["radius"]
    shard = F.pmod(F.xxhash64("vec_id"), F.col("shards")).cast("int").alias("shard")
    sharded = scratch.table(placed.join(sizes.select("dim", "cell", "shards"), ["dim", "cell"]).select(
        "vec_id", "v", "dim", "cell", shard), "vectors")
    asking = scratch.table(placed.where("asks").select("vec_id", "v", "dim"), "queries")
    scratch.drop("rows", "placed")
    keys, schema, lowest = ["dim", "cell", "shard"], "query_id long, vec_id long, score long", F.lit(float("-inf"))
    best, begin = None, 0
    for turn, end in enumerate(ROUNDS):
        if best is None:
            asked = asking.withColumn("floor", lowest)
        else:
            floors = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low")).where(F.col("n") >= k)
            # longs above 2**53 lose digits as doubles: the floor is set a little lower there
            low = F.col("low").cast("double")
            low = low - F.when(F.abs(low) >= _EXACT, F.abs(low) * 1e-15).otherwise(0.0)
            asked = asking.join(floors.select(F.col("query_id").alias("vec_id"), low.alias("low")), "vec_id", "left").select(
                "vec_id", "v", "dim", F.coalesce("low", lowest).alias("floor"))
        asked = asked.mapInArrow(_route(cells, begin, end), "vec_id long, v array<long>, dim int, floor double, cell int")
        asked = asked.join(sizes.select("dim", "cell", "shards"), ["dim", "cell"]).withColumn(
            "shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).drop("shards")
        asked = scratch.table(asked, f"asked-{turn}")
        # a shard is copied once for every block of queries that reach it, and not at all if none does
        blocks = scratch.table(asked.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / F.lit(query_block)).cast("int").alias("blocks")), f"blocks-{turn}")
        every = sharded.join(blocks, keys).select("vec_id", "v", *keys, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        those = asked.join(blocks, keys).select("vec_id", "v", "floor", *keys, F.pmod(F.xxhash64(F.lit(1), "vec_id"), "blocks").cast("int").alias("block"))
        found = every.groupBy(*keys, "block").cogroup(those.groupBy(*keys, "block")).applyInPandas(_search(k), schema)
        found = found if best is None else best.select("query_id", "vec_id", "score").unionByName(found)
        best = scratch.table(_per_query(found, k), f"best-{turn}")
        scratch.drop(f"asked-{turn}", f"blocks-{turn}", f"best-{turn - 1}")
        begin = end
    scratch.drop("vectors", "queries", "cells")
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
