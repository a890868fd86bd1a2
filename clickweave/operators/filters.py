"""Filters and semi-joins (C-01 .. C-05)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.functions.values import ALLOWED_CLUSTER_LABELS


# C-01
def filter_session(clicks: DataFrame, session_id: int, check: bool = False) -> DataFrame:
    """Clicks of one session; the literal predicate reaches the Parquet scan."""
    out = clicks.where(F.col("session_id") == F.lit(session_id))
    if check and out.limit(1).count() == 0:
        raise ValueError(f"No clicks found for session_id={session_id}.")
    return out


# C-02
def clicks_with_labels(clicks: DataFrame, labels: DataFrame, check: bool = False) -> DataFrame:
    out = clicks.join(labels.select("session_id"), "session_id", "left_semi")
    if check and out.limit(1).count() == 0:
        raise ValueError("No clicks left after keeping labelled sessions.")
    return out


# C-03
def labeled_only(df: DataFrame, col: str = "label") -> DataFrame:
    return df.na.drop(subset=[col])


# C-04
def valid_cluster_labels(df: DataFrame, col: str = "intent_label") -> DataFrame:
    return df.where(F.col(col).isin(*ALLOWED_CLUSTER_LABELS))


# C-05
def unlabeled_clusters(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """Clusters without a valid label (the gate before saving)."""
    return clusters.select("cluster_id").distinct().join(
        valid_cluster_labels(labels).select("cluster_id"), "cluster_id", "left_anti")
