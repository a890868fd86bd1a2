"""Inputs derived from the driver tables for operators whose real inputs are
files produced by people or by fitted models (labels, cluster assignments,
cluster label maps, interpretations, scores). All of them are computed from
the tables, so their size grows with the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.values import CLUSTER_LABEL_MAP, cluster_label_values_sql
from clickweave.operators.clean import prepare_clickstream
from clickweave.sources.tables import raw_clicks

# Short interpretation texts of our own for the first six clusters only, so
# that the display defaults of D-09 are exercised for the rest.
INTERPRETATIONS = {i: (f"Segment {i}", f"Intent pattern {i}") for i in range(6)}


def clicks(spark: SparkSession, sf: str) -> DataFrame:
    return prepare_clickstream(raw_clicks(spark, sf))


def assignments(spark: SparkSession, sf: str, k: int = 8) -> DataFrame:
    """Cluster assignment stand-in: ``session_id % k``."""
    return clicks(spark, sf).select("session_id").distinct().select(
        "session_id", (F.col("session_id") % k).cast("int").alias("cluster_id"))


def assigned(sessions: DataFrame, k: int = 8) -> DataFrame:
    """The same stand-in for a table of one row a session."""
    return sessions.select("session_id", (F.col("session_id") % k).cast("int").alias("cluster_id"))


def assignments_sql(k: int = 8) -> str:
    return f"SELECT DISTINCT session_id, CAST(session_id % {k} AS INTEGER) AS cluster_id FROM clicks"


def cluster_label_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(CLUSTER_LABEL_MAP.items()), "cluster_id INT, intent_label STRING")


CLUSTER_MAP_SQL = f"SELECT CAST(cluster_id AS INTEGER) AS cluster_id, intent_label FROM {cluster_label_values_sql()}"


def interpretations(spark: SparkSession) -> DataFrame:
    rows = [(i, a, f"{b}.", ) for i, (a, b) in INTERPRETATIONS.items()]
    df = spark.createDataFrame(rows, "cluster_id INT, cluster_label STRING, business_intent STRING")
    return df.withColumn("cluster_size_pct", F.lit(None).cast("string"))


INTERPRETATIONS_SQL = "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{a}', '{b}.', CAST(NULL AS VARCHAR))" for i, (a, b) in INTERPRETATIONS.items()
) + ") AS it(cluster_id, cluster_label, business_intent, cluster_size_pct)"
