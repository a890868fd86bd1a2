"""Registered queries: model-input alignment (B-13), key validation (B-16),
de-duplication and top-k (E-04, E-05, E-06, E-09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.operators import clean, clusters, explain, ordering
from clickweave.plans import q_clusters as QC
from clickweave.plans import q_models as QM
from clickweave.plans import sql_features as S
from clickweave.plans.registry import CLICKS_CTE, MANUAL_LABELS_CTE, register
from clickweave.sources.tables import TEXT_LABELS_CTE, manual_labels, text_labels

EXPECTED = ["price_mean", "n_clicks_observed", "feature_not_in_batch", "category_switch_rate"]
W5 = "WITH " + CLICKS_CTE + ",\n" + MANUAL_LABELS_CTE + S.features_cte("feat5", 5, "first_n")


@register("align_to_model_features", "B-13", W5 + """
SELECT session_id, CAST(price_mean AS DOUBLE) AS price_mean, CAST(n_clicks_observed AS DOUBLE) AS n_clicks_observed,
       0.0::DOUBLE AS feature_not_in_batch, CAST(category_switch_rate AS DOUBLE) AS category_switch_rate FROM feat5""")
def q_align_to_model_features(spark, sf):
    return clean.align_to_model_features(QC.feats_first(spark, sf), EXPECTED)


@register("validate_session_key", "B-16", W5 + """
SELECT count(*) AS n_rows, count(session_id) AS n_non_null, count(DISTINCT session_id) AS n_distinct FROM feat5""")
def q_validate_session_key(spark, sf):
    return clean.validate_session_key(QC.feats_first(spark, sf), raise_on_error=False)


DUP = "WITH " + MANUAL_LABELS_CTE + ",\n" + TEXT_LABELS_CTE + """,
both_files AS (
  SELECT session_id, label, 1 AS file_row FROM manual_labels
  UNION ALL
  SELECT session_id, CASE WHEN lower(intent_label) LIKE '%high%' THEN 1 ELSE 0 END, 2 FROM text_labels
)"""


def _both(spark, sf):
    a = manual_labels(spark, sf).select("session_id", "label", F.lit(1).alias("file_row"))
    t = text_labels(spark, sf).select("session_id", F.when(F.lower("intent_label").contains("high"), 1)
                                      .otherwise(0).alias("label"), F.lit(2).alias("file_row"))
    return a.unionByName(t)


@register("dedup_keep_last", "E-04", DUP + """
SELECT session_id, label, file_row FROM both_files
QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY file_row DESC) = 1""")
def q_dedup_keep_last(spark, sf):
    return ordering.dedup_keep_last(_both(spark, sf), "session_id", "file_row")


@register("dedup_keep_first", "E-05", DUP + """
SELECT session_id, label, file_row FROM both_files
QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY file_row) = 1""")
def q_dedup_keep_first(spark, sf):
    return ordering.dedup_keep_first(_both(spark, sf), "session_id", "file_row")


@register("cluster_representatives", "E-06", QC.BASE + QC.SPACE_CTE + """
SELECT session_id, cluster_id, round(sqrt(d2), 6) AS distance_to_centroid,
       CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY sqrt(d2), session_id) AS INTEGER) AS rank_within_cluster
FROM own QUALIFY rank_within_cluster <= 5""")
def q_cluster_representatives(spark, sf):
    z, a, cent = QC._space(spark, sf)
    d = clusters.distance_to_own(z, a, QC.SPACE, cent).select("session_id", "cluster_id", "distance_to_centroid")
    reps = ordering.cluster_representatives(d, top_n=5)
    return reps.withColumn("distance_to_centroid", F.round("distance_to_centroid", 6))


@register("top_features", "E-09", QM.BASE + """
, mu AS (SELECT """ + ", ".join(f"avg({c}) AS {c}" for c in QM.WEIGHTS) + """ FROM lf),
ma AS (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(abs({w} * (lf.{c} - mu.{c}))) AS importance FROM lf CROSS JOIN mu"
    for c, w in QM.WEIGHTS.items()) + """))
SELECT feature, round(importance, 6) AS importance FROM ma ORDER BY importance DESC LIMIT 2""")
def q_top_features(spark, sf):
    imp = explain.linear_shap(QM.labelled_features(spark, sf), QM.WEIGHTS).select(
        "feature", F.col("mean_abs_shap").alias("importance"))
    return ordering.top_features(imp, 2).withColumn("importance", F.round("importance", 6))
