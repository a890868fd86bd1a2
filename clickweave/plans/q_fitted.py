"""Registered queries whose results come from fitted models or from a
streaming run (rows-only checks): I-07, K-04, N-06, N-07, P-03, P-05, E-07,
E-08, P-07, P-10."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from clickweave.operators import clusters, explain, online, ordering, sequences, stacking, stats, training
from clickweave.operators.clean import prepare_clickstream
from clickweave.operators.frequencies import frequency_table
from clickweave.plans import q_clusters as QC
from clickweave.plans import q_models as QM
from clickweave.plans.registry import register
from clickweave.session import checkpoint_dir, shared_table
from clickweave.operators.clean import CLICK_RULES
from clickweave.sources.tables import EVENT_CLICKS_CTE, event_clicks, manual_labels, raw_clicks


@register("pca_project", "I-07")
def q_pca_project(spark, sf):
    z = QC.scaled(spark, sf)
    return stats.pca_project(z, QC.SPACE, 0.9)


@register("run_cluster_labeling", "K-04")
def q_run_cluster_labeling(spark, sf):
    features = shared_table(QC.feats_full(spark, sf), "features")  # every step reads them
    out = clusters.run_cluster_labeling(features, k=8, n_init=10)
    return out["labeled_sessions"]


@register("importance_report", "N-06")
def q_importance_report(spark, sf):
    """Every method: a logistic model's coefficients and SHAP values, a forest's own importances, permutation of either, and the automatic choice."""
    train, _, cols = QM._split_train_test(spark, sf)
    line, forest = QM._logistic(train, cols).fit(train), training.model_random_forest(cols, 50, 8).fit(train)
    out = None
    for name, model, method in [("logistic", line, "coefficients"), ("logistic", line, "shap"), ("logistic", line, "auto"),
                                ("forest", forest, "model"), ("forest", forest, "auto"), ("logistic", line, "permutation")]:
        told = explain.importance_report(model, train, cols, method, score=explain.RocArea())
        value = "importance" if "importance" in told.columns else "mean_abs_shap" if "mean_abs_shap" in told.columns else "importance_mean"
        told = told.select(F.lit(name).alias("model"), F.lit(method).alias("method"), "feature", F.col(value).cast("double").alias("importance"))
        out = told if out is None else out.unionByName(told)
    return out


@register("stacking_importance", "N-07")
def q_stacking_importance(spark, sf):
    stack, _, test = QM._stack(spark, sf)
    return stacking.stacking_importance(stack, test, explain.RocArea())


def _sequences(spark, sf, n=5):
    """(rows with steps, label, is_test; feature names)"""
    seq, cols = sequences.click_sequences(raw_clicks(spark, sf, first_n=n), manual_labels(spark, sf), n)
    return training.stratified_split(shared_table(seq, "sequences")), cols


@register("sequence_classifier", "P-03")
def q_sequence_classifier(spark, sf):
    data, cols = _sequences(spark, sf)
    model = sequences.sequence_pipeline(5, len(cols), hidden=32, max_iter=30).fit(data.where("is_test = 0"))
    pred = training.probability_of_one(model.transform(data.where("is_test = 1")))
    return pred.select("session_id", "label", F.col("prediction").cast("int").alias("prediction"), "probability")


def _sweep(spark, sf):
    clicks = prepare_clickstream(raw_clicks(spark, sf, first_n=10))
    return sequences.n_click_sweep(clicks, manual_labels(spark, sf), 2, 10, k=5, hidden=8, max_iter=5)


@register("n_click_sweep", "P-05")
def q_n_click_sweep(spark, sf):
    return _sweep(spark, sf)


@register("best_n_clicks", "E-08")
def q_best_n_clicks(spark, sf):
    return ordering.best_n_clicks(_sweep(spark, sf), "cv_mean_test_roc_auc")


@register("rank_models", "E-07")
def q_rank_models(spark, sf):
    train, test, cols = QM._split_train_test(spark, sf)
    return ordering.best_model(training.compare_models(QM.baseline_fitters(cols), train, test, QM._eval))


@register("score_sessions", "P-07")
def q_score_sessions(spark, sf):
    train, _, cols = QM._split_train_test(spark, sf)
    model = QM._logistic(train, cols, scaled=True).fit(train)
    stored = frequency_table(prepare_clickstream(raw_clicks(spark, sf, first_n=5)), 5)
    return online.score_sessions(raw_clicks(spark, sf, first_n=5), model, cols, freqs=stored, n=5)


STREAM_SQL = "WITH " + EVENT_CLICKS_CTE + f"""
, nb AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY "order") AS rn,
                lag(page_1_main_category) OVER (PARTITION BY session_id ORDER BY "order") AS before FROM event_clicks),
sf AS (SELECT session_id, count(*) AS n_clicks_observed, avg(CAST(price_2 = 1 AS INTEGER)) AS high_price_share_first_n,
              avg(CAST(rn > 1 AND page_1_main_category <> before AS INTEGER)) AS category_switch_rate
       FROM nb WHERE rn <= 5 GROUP BY session_id HAVING count(*) = 5),
sp AS (SELECT session_id, round(1.0 / (1.0 + exp(-({QM.LOGIT_SQL}))), 4) AS probability FROM sf)
SELECT session_id, probability, CASE WHEN probability >= 0.5 THEN 'high-intent' ELSE 'low-intent' END AS label FROM sp"""


def _scoring_events(spark, sf):
    """Event clicks with the column names and texts that the session features read."""
    ev = event_clicks(spark, sf).withColumnRenamed("page_2_clothing_model", "page_2_model")
    ev = ev.withColumn("higher_than_average", (F.col("price_2") == 1).cast("int"))
    return ev.withColumn("main_category", F.element_at(F.create_map(
        *[F.lit(x) for kv in {1: "trousers", 2: "skirts", 3: "blouses", 4: "sale"}.items() for x in kv]), F.col("page_1_main_category")))


def _streamed(spark, sf, scorer):
    """Lands the events as files, streams the first 5 clicks of each session that has them, and reads the prediction sink.
    ``scorer`` makes the scoring function of a micro-batch from the landed clicks."""
    from clickweave.streaming.nth_click import read_sink, start

    base = os.path.join(checkpoint_dir(spark), "clickweave-stream", uuid.uuid4().hex)
    src, sink, ckpt = (os.path.join(base, d) for d in ("src", "sink", "ckpt"))
    ev = _scoring_events(spark, sf)
    ev.repartition(4, "session_id").write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(ev.schema).parquet(src)
    start(stream, scorer(spark.read.parquet(src)), sink, ckpt, n=5, trigger_once=True).awaitTermination()
    return read_sink(spark, sink, "session_id BIGINT, probability DOUBLE, label STRING")


@register("stream_score", "P-10", STREAM_SQL)
def q_stream_score(spark, sf):
    """Fire-once scoring by fixed weights; the frequencies are those of the training-time first clicks (P-06)."""
    def scorer(landed):
        from clickweave.operators.features import build_session_features

        stored = shared_table(frequency_table(prepare_clickstream(landed), 5), "frequencies")

        def score(batch):
            f = build_session_features(batch.drop("click_count"), 5, "first_n", freqs=stored)
            logit = F.lit(QM.INTERCEPT)
            for c, w in QM.WEIGHTS.items():
                logit = logit + F.lit(w) * F.col(c)
            p = F.round(1.0 / (1.0 + F.exp(-logit)), 4)
            return f.select("session_id", p.alias("probability"), F.when(p >= 0.5, "high-intent").otherwise("low-intent").alias("label"))
        return score

    return _streamed(spark, sf, scorer)


def saved_model_and_frequencies(spark, sf):
    """A fitted model and the frequencies of its training clicks, saved to the shared folder and loaded again, with its feature list."""
    from clickweave.sources import files

    train, _, cols = QM._split_train_test(spark, sf)
    base = os.path.join(checkpoint_dir(spark), "clickweave-models", uuid.uuid4().hex)
    paths = files.write_model_report(QM._logistic(train, cols).fit(train), spark.createDataFrame([(len(cols),)], "features INT"), base)
    frequency_table(prepare_clickstream(raw_clicks(spark, sf, first_n=5)), 5).write.json(f"{base}/frequencies")
    model, expected = files.load_model(paths["model"])
    return model, expected, files.read_frequencies(spark, f"{base}/frequencies")


@register("stream_score_model", "P-10")
def q_stream_score_model(spark, sf):
    """Fire-once scoring by a saved model with stored training frequencies, the same code as batch scoring (P-07)."""
    model, expected, stored = saved_model_and_frequencies(spark, sf)
    return _streamed(spark, sf, lambda landed: lambda batch: online.score_sessions(batch.drop("click_count"), model, expected, stored, 5))


def _landed_events(spark, sf):
    """Event clicks landed as files in the shared folder (the stream source)."""
    base = os.path.join(checkpoint_dir(spark), "clickweave-stream", uuid.uuid4().hex)
    ev = event_clicks(spark, sf)
    ev.repartition(4, "session_id").write.mode("overwrite").parquet(os.path.join(base, "src"))
    return base, ev.schema


@register("stream_clicks", "A-10", "WITH " + EVENT_CLICKS_CTE + """
, v AS (SELECT session_id, "order", concat_ws(',', """ + ", ".join(
    f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in CLICK_RULES.items()) + """)
  AS failed_rules FROM event_clicks)
SELECT session_id, "order", failed_rules, CAST(failed_rules = '' AS INTEGER) AS is_valid FROM v""")
def q_stream_clicks(spark, sf):
    from clickweave.streaming.nth_click import read_sink, validated_click_stream

    base, schema = _landed_events(spark, sf)
    stream = spark.readStream.schema(schema).parquet(os.path.join(base, "src"))
    q = validated_click_stream(stream, os.path.join(base, "valid"), os.path.join(base, "quarantine"),
                               os.path.join(base, "ckpt"))
    q.awaitTermination()
    schema = StructType([*schema.fields, StructField("failed_rules", StringType()), StructField("is_valid", IntegerType())])
    both = read_sink(spark, os.path.join(base, "valid"), schema).unionByName(read_sink(spark, os.path.join(base, "quarantine"), schema))
    return both.select("session_id", "order", "failed_rules", "is_valid")


@register("stream_predictions", "A-11", STREAM_SQL)
def q_stream_predictions(spark, sf):
    """The prediction sink: one row per session that reached its 5th click."""
    return q_stream_score(spark, sf).select("session_id", "label", "probability")
