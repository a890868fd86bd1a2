"""Row ordering, top-k and de-duplication (E-02 .. E-10).

Per-key "last/first row" uses ``max_by``/``min_by`` aggregates, which are
partially aggregated before the shuffle: a hot key costs one row per map
task, not one task holding all its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order_struct(order: Sequence[str]):
    return F.struct(*[F.col(c) for c in order])


# E-02
def last_click(clicks: DataFrame, key: str = "session_id", order: Sequence[str] = ("order",)) -> DataFrame:
    cols = [c for c in clicks.columns if c != key]
    row = F.max_by(F.struct(*[F.col(f"`{c}`") for c in cols]), _order_struct(order)).alias("_r")
    return clicks.groupBy(key).agg(row).select(key, *[F.col(f"_r.`{c}`").alias(c) for c in cols])


# E-03
def first_last_model(clicks: DataFrame, model: str = "page_2_model", key: str = "session_id",
                     order: Sequence[str] = ("order",)) -> DataFrame:
    o = _order_struct(order)
    return clicks.groupBy(key).agg(F.min_by(model, o).alias("first_model"), F.max_by(model, o).alias("last_model"))


def _keep_one(df: DataFrame, key: str, order_col: str, ascending: bool) -> DataFrame:
    """One row per key by an aggregate (``min_by``/``max_by`` of the whole
    row), so duplicates of a hot key are reduced before the shuffle."""
    cols = [c for c in df.columns if c != key]
    row = F.struct(*[F.col(f"`{c}`") for c in cols])
    pick = (F.min_by if ascending else F.max_by)(row, F.col(order_col)).alias("_r")
    return df.groupBy(key).agg(pick).select(key, *[F.col(f"_r.`{c}`").alias(c) for c in cols])


# E-04
def dedup_keep_last(df: DataFrame, key: str, order_col: str) -> DataFrame:
    """One row per key, the row with the largest ``order_col`` (file order)."""
    return _keep_one(df, key, order_col, ascending=False)


# E-05
def dedup_keep_first(df: DataFrame, key: str, order_col: str) -> DataFrame:
    return _keep_one(df, key, order_col, ascending=True)


# E-06
def cluster_representatives(distances: DataFrame, top_n: int = 5) -> DataFrame:
    """Rank sessions by (distance_to_centroid, session_id) inside each cluster."""
    if top_n <= 0:
        raise ValueError(f"a cluster needs at least one representative, got {top_n}")
    w = Window.partitionBy("cluster_id").orderBy("distance_to_centroid", "session_id")
    ranked = distances.withColumn("rank_within_cluster", F.row_number().over(w))
    return ranked.where(F.col("rank_within_cluster") <= top_n)


# E-07
def rank_models(comparison: DataFrame, metric: str = "test_roc_auc") -> DataFrame:
    return comparison.orderBy(F.col(metric).desc(), F.col("model"))


def best_model(comparison: DataFrame, metric: str = "test_roc_auc") -> DataFrame:
    return rank_models(comparison, metric).limit(1)


# E-08
def best_n_clicks(cv_table: DataFrame, metric: str = "cv_mean_roc_auc") -> DataFrame:
    return cv_table.agg(F.max_by("n_clicks", F.struct(F.col(metric), -F.col("n_clicks"))).alias("best_n_clicks"),
                        F.max(metric).alias(f"best_{metric}"))


# E-09
def top_features(importances: DataFrame, n: int = 10, value: str = "importance") -> DataFrame:
    return importances.orderBy(F.col(value).desc(), F.col("feature")).limit(n)


# E-10
def sessions_distinct(clicks: DataFrame, key: str = "session_id") -> DataFrame:
    return clicks.select(key).distinct()
