"""Registered queries for sources and sinks (A-03, A-05 .. A-15) and the
override join D-07. Each writes data derived from the tables into the shared
folder (``spark.checkpoint.dir``) with the operator under test and reads it
back, so the value check covers the written content."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import functions as F

from clickweave.operators import grid, clusters, labels, metrics, online, ordering, stats, training
from clickweave.plans import q_clusters as QC
from clickweave.plans import q_labels as QL
from clickweave.plans import q_models as QM
from clickweave.plans import standins as T
from clickweave.plans.registry import register
from clickweave.session import checkpoint_dir, shared_table
from clickweave.sources import files
from clickweave.sources.tables import EVENT_CLICKS_CTE, raw_clicks


def _path(spark, name):
    return os.path.join(checkpoint_dir(spark), "clickweave-io", f"{name}-{uuid.uuid4().hex}")


@register("override_labels", "D-07", QL.W + QL.override_sql("cluster_only", "manual"))
def q_override_labels(spark, sf):
    return labels.override_labels(QL._cluster_only(spark, sf), QL._manual(spark, sf))


@register("read_cluster_files", "A-03", QC.BASE + """
, cmap AS (""" + T.CLUSTER_MAP_SQL + """)
SELECT a.session_id, a.cluster_id, c.intent_label FROM assign a JOIN cmap c ON a.cluster_id = c.cluster_id""")
def q_read_cluster_files(spark, sf):
    f, a, lab = (_path(spark, n) for n in ("features", "assignments", "labels"))
    QC.feats_full(spark, sf).select("session_id", "n_clicks_observed").write.option("header", True).csv(f)
    T.assignments(spark, sf, 8).write.option("header", True).csv(a)
    T.cluster_label_map(spark).write.option("header", True).csv(lab)
    _, assign, lbl = files.read_cluster_files(spark, f, a, lab)
    out = assign.join(lbl, "cluster_id")
    return out.select(F.col("session_id").cast("bigint"), F.col("cluster_id").cast("int"), "intent_label")


@register("write_session_tables", "A-05", QL.W + "\nSELECT * FROM proxy")
def q_write_session_tables(spark, sf):
    c = raw_clicks(spark, sf)
    from clickweave.operators.features import build_session_features

    base = _path(spark, "session_tables")
    lab = labels.proxy_labels(c)
    # all three tables are written; the labels table is read back for the check
    paths = files.write_session_tables(build_session_features(c, 5),
                                       build_session_features(c, aggregation_mode="full_session"), lab, base)
    return spark.read.parquet(paths["session_labels"])


@register("write_cluster_outputs", "A-06", QC.BASE + QC.SUMMARY_CTE + "\nSELECT " +
          QC.summary_select(QC.SUMMARY_COLS) + " FROM summ")
def q_write_cluster_outputs(spark, sf):
    base = _path(spark, "cluster_outputs")
    f = shared_table(QC.feats_full(spark, sf), "features")  # all four tables come from one build of the clicks
    assigned = T.assigned(f, QC.K)
    z, a, cent = QC._space(spark, sf, f)
    distances = clusters.distance_to_own(z, a, QC.SPACE, cent).select("session_id", "cluster_id", "distance_to_centroid")
    # all four tables are written; the summary is read back for the check
    paths = files.write_cluster_outputs(
        {"assignments": assigned, "summary": QC.summary(spark, sf, f).select(*QC.SUMMARY_COLS),
         "representatives": ordering.cluster_representatives(distances, top_n=5),
         "labeled_sessions": clusters.manual_cluster_labels(assigned, T.cluster_label_map(spark))},
        {"k": 8, "assignments": "session_id % 8"}, base)
    json.loads(spark.read.text(paths["metrics"]).first()[0])
    return QC.round_summary(spark.read.parquet(paths["summary"]))


@register("write_cluster_labels", "A-07", "WITH " + EVENT_CLICKS_CTE + """,
ev AS (SELECT session_id, CAST(session_id % 8 AS INTEGER) AS cluster_id,
              CAST(page_1_main_category = 3 AS INTEGER) AS purchase_flag FROM event_clicks),
rates AS (SELECT cluster_id, avg(purchase_flag) AS purchase_rate FROM ev GROUP BY 1)
SELECT cluster_id, CASE WHEN purchase_rate >= (SELECT median(purchase_rate) FROM rates) THEN 'high-intent'
                        ELSE 'low-intent' END AS intent_label FROM rates""")
def q_write_cluster_labels(spark, sf):
    from clickweave.plans.q_clusters import _event_rates

    rates = clusters.purchase_rate(_event_rates(spark, sf))
    med = rates.agg(F.median("purchase_rate")).scalar()
    lbl = rates.select("cluster_id", F.when(F.col("purchase_rate") >= med, "high-intent").otherwise("low-intent")
                       .alias("intent_label"))
    path = files.write_cluster_labels(lbl, _path(spark, "cluster_labels"))
    return spark.read.schema("cluster_id INT, intent_label STRING").option("header", True).csv(path)


@register("write_model_report", "A-08")
def q_write_model_report(spark, sf):
    train, test, cols = QM._split_train_test(spark, sf)
    frame = grid.fold_frame(train, cols, 5, 42)
    found = grid.search_logistic(frame, cols, [{"c": c} for c in (0.01, 0.1, 1.0, 10.0, 100.0)], 5)
    frame.unpersist()
    model, scored = training.fit_score(training.model_logistic(cols, c=found.params[found.best]["c"], n=train.count()), train, test)
    measured = QM._eval(scored)
    comparison = measured.select(F.lit("logistic_regression").alias("model"), *[F.col(c).alias(f"test_{c}") for c in measured.columns])
    paths = files.write_model_report(model, measured, _path(spark, "model_report"), comparison, found.table(spark))
    return spark.read.json(paths["metrics"])


@register("load_model", "A-09")
def q_load_model(spark, sf):
    train, test, cols = QM._split_train_test(spark, sf)
    paths = files.write_model_report(training.model_decision_tree(cols).fit(train),
                                     metrics.classification_metrics(train.withColumn("prediction", F.col("label"))),
                                     _path(spark, "model"))
    model, expected = files.load_model(paths["model"])
    assert expected == cols
    return training.probability_of_one(model.transform(test)).select("session_id", "label", "probability")


@register("rnn_artifact_sink", "A-13")
def q_rnn_artifact_sink(spark, sf):
    """Sequence model artefacts: scaler moments, feature order and fitted network in one saved pipeline, reloaded."""
    from pyspark.ml import PipelineModel

    from clickweave.operators import sequences
    from clickweave.plans.q_fitted import _sequences

    data, cols = _sequences(spark, sf)
    path = _path(spark, "sequence_model")
    sequences.sequence_pipeline(5, len(cols), 16, 10).fit(data.where("is_test = 0")).write().overwrite().save(path)
    return PipelineModel.load(path).transform(data.where("is_test = 1")).select("session_id", "label", "prediction")


@register("selected_features_sink", "A-12", QC.BASE + QC.CV_CTE + """
, th AS (SELECT quantile_cont(coefficient_of_variation, 0.75) AS t FROM cvx)
SELECT 'coefficient_of_variation' AS method, CAST(0.75 AS DOUBLE) AS threshold_percentile, feature,
       round(coefficient_of_variation, 4) AS coefficient_of_variation, round(std_dev, 4) AS std_dev,
       round(mean, 4) AS mean FROM cvx CROSS JOIN th WHERE coefficient_of_variation >= t""")
def q_selected_features_sink(spark, sf):
    path = files.selected_features_sink(stats.select_discriminative(QC._cv(spark, sf)), _path(spark, "selected"))
    return spark.read.schema("method STRING, threshold_percentile DOUBLE, feature STRING, "
                             "coefficient_of_variation DOUBLE, std_dev DOUBLE, mean DOUBLE").json(path)


@register("read_selected_features", "A-14", QC.BASE + QC.CV_CTE + """
, th AS (SELECT quantile_cont(coefficient_of_variation, 0.75) AS t FROM cvx)
SELECT feature FROM cvx CROSS JOIN th WHERE coefficient_of_variation >= t""")
def q_read_selected_features(spark, sf):
    sel = stats.select_discriminative(QC._cv(spark, sf))
    path = _path(spark, "selected_doc")
    sel.select(F.to_json(F.struct(F.collect_list(F.struct("feature")).alias("features"))).alias("j")) \
        .coalesce(1).write.text(path)
    df, msg = files.read_selected_features(spark, path)
    if msg:
        raise ValueError(msg)
    return df.select("feature")


@register("read_interpretations", "A-15", QC.BASE + QC.SUMMARY_CTE + """
SELECT cluster_id, 'Cluster ' || CAST(cluster_id AS VARCHAR) AS cluster_label,
       printf('%.1f%%', cluster_percentage) AS cluster_size_pct, 'Sessions of cluster ' || CAST(cluster_id AS VARCHAR)
       AS business_intent FROM summ""")
def q_read_interpretations(spark, sf):
    s = QC.summary(spark, sf)
    path = _path(spark, "interpretations")
    s.select(F.col("cluster_id").cast("string").alias("cluster_id"),
             F.concat(F.lit("Cluster "), F.col("cluster_id").cast("string")).alias("cluster_label"),
             F.format_string("%.1f%%", "cluster_percentage").alias("cluster_size_pct"),
             F.concat(F.lit("Sessions of cluster "), F.col("cluster_id").cast("string")).alias("business_intent")) \
        .write.option("header", True).csv(path)
    df, msg = files.read_interpretations(spark, path)
    if msg:
        raise ValueError(msg)
    return df
