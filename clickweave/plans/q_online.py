"""Registered queries: sequences and online scoring (P), file sources (A)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from clickweave.operators import online, sequences, training
from clickweave.operators.clean import normalize_columns
from clickweave.operators.features import build_session_features
from clickweave.operators.frequencies import frequency_table
from clickweave.plans import sql_features as S
from clickweave.plans.q_models import IS_TEST
from clickweave.plans.q_windows import CLICK_LEVEL_BODY
from clickweave.plans.registry import CLICKS_CTE, EVENT_CLICKS_CTE, MANUAL_LABELS_CTE, register
from clickweave.session import checkpoint_dir, shared_table
from clickweave.sources import files
from clickweave.sources.tables import event_clicks, manual_labels, raw_clicks

W = "WITH " + CLICKS_CTE + ",\n" + MANUAL_LABELS_CTE


def _prepared(spark, sf):
    from clickweave.operators.clean import prepare_clickstream

    return prepare_clickstream(raw_clicks(spark, sf))


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


# numeric columns of F-13 but session and position, in their order
SEQ = ["year", "month", "day", "order", "country", "page_1_main_category", "colour", "location", "model_photography", "price", "price_2",
       "page", "higher_than_average", "n_clicks_observed", "is_first_click", "is_last_observed_click", "running_high_price_count",
       "running_high_price_share", "running_unique_pages", "running_unique_models", "running_unique_categories", "running_unique_colours",
       "price_delta_from_prev", "category_changed_from_prev", "category_frequency", "colour_frequency", "model_frequency"]
SEQ_SQL = W + CLICK_LEVEL_BODY + """,
lab AS (SELECT cl.*, m.label FROM cl JOIN manual_labels m ON cl.session_id = m.session_id)"""


@register("session_sequences", "P-01", SEQ_SQL + f"""
SELECT session_id, label, flatten(list([{", ".join(f'CAST("{c}" AS DOUBLE)' for c in SEQ)}] ORDER BY click_position)) AS x
FROM lab GROUP BY session_id, label""")
def q_session_sequences(spark, sf):
    seq, cols = sequences.click_sequences(raw_clicks(spark, sf, first_n=5), manual_labels(spark, sf), 5)
    assert cols == SEQ, cols
    return seq.select("session_id", "label", F.flatten(F.transform("steps", lambda s: s["x"])).alias("x"))


@register("sequence_scaler", "P-02", SEQ_SQL + f"""
, ses AS (SELECT DISTINCT session_id, label FROM lab),
tr AS (SELECT lab.* FROM lab JOIN (SELECT session_id, {IS_TEST} AS is_test FROM ses) s ON lab.session_id = s.session_id WHERE NOT s.is_test)
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg(CAST(\"{c}\" AS DOUBLE)), 6) AS mean, "
    f"round(coalesce(nullif(stddev_pop(CAST(\"{c}\" AS DOUBLE)), 0), 1.0), 6) AS std FROM tr" for c in SEQ) + ")")
def q_sequence_scaler(spark, sf):
    """Moments over the first clicks of the training sessions."""
    seq, cols = sequences.click_sequences(raw_clicks(spark, sf, first_n=5), manual_labels(spark, sf), 5)
    train = training.stratified_split(shared_table(seq, "sequences")).where("is_test = 0")
    found = [(c, float(m), float(s)) for c, (m, s) in zip(cols, sequences.step_moments(train, len(cols)))]
    return spark.createDataFrame(found, "feature STRING, mean DOUBLE, std DOUBLE").select("feature", _r("mean"), _r("std"))


FREQ5 = """,
sel5 AS (SELECT * FROM clicks QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY "order") <= 5),
d5 AS (SELECT 'model_freq' AS dim, page_2_model AS value FROM sel5
       UNION ALL SELECT 'category_freq', main_category FROM sel5
       UNION ALL SELECT 'colour_freq', CAST(colour AS VARCHAR) FROM sel5),
c5 AS (SELECT dim, value, count(*) AS cnt FROM d5 WHERE value IS NOT NULL GROUP BY 1, 2),
ft AS (SELECT dim, value, cnt / sum(cnt) OVER (PARTITION BY dim) AS freq FROM c5)"""


@register("correct_frequencies", "P-06", W + FREQ5 + S.selected_cte(3) + S.ENRICH_CTE + """,
fx2 AS (SELECT e.*, coalesce(m.freq, 0.0) AS mf, coalesce(c.freq, 0.0) AS cf, coalesce(o.freq, 0.0) AS kf
        FROM enr e LEFT JOIN ft m ON m.dim = 'model_freq' AND e.page_2_model = m.value
        LEFT JOIN ft c ON c.dim = 'category_freq' AND e.main_category = c.value
        LEFT JOIN ft o ON o.dim = 'colour_freq' AND CAST(e.colour AS VARCHAR) = o.value)
SELECT session_id, round(avg(mf), 6) AS mean_model_frequency, max(mf) AS max_model_frequency,
       min(mf) AS min_model_frequency, arg_min_null(mf, click_position) AS first_model_frequency,
       arg_max_null(mf, click_position) AS last_model_frequency, arg_max_null(cf, click_position) AS last_category_frequency,
       arg_max_null(kf, click_position) AS last_colour_frequency
FROM fx2 GROUP BY session_id""")
def q_correct_frequencies(spark, sf):
    stored = frequency_table(_prepared(spark, sf), 5)
    f = build_session_features(raw_clicks(spark, sf, first_n=3), 3, "first_n", freqs=stored)
    return f.select("session_id", _r("mean_model_frequency"), "max_model_frequency", "min_model_frequency",
                    "first_model_frequency", "last_model_frequency", "last_category_frequency",
                    "last_colour_frequency")


@register("stream_nth_click", "P-09", "WITH " + EVENT_CLICKS_CTE + """
, nb AS (SELECT *, CAST(row_number() OVER (PARTITION BY session_id ORDER BY "order") AS INTEGER) AS click_count FROM event_clicks)
SELECT * FROM nb WHERE click_count <= 5 AND session_id IN (SELECT session_id FROM nb WHERE click_count = 5)""")
def q_stream_nth_click(spark, sf):
    """The event clicks land as files; the fire-once stream emits the first 5 clicks of each session that reaches its fifth."""
    from clickweave.streaming.nth_click import read_sink, start

    base = os.path.join(checkpoint_dir(spark), "clickweave-stream", uuid.uuid4().hex)
    src, sink = os.path.join(base, "src"), os.path.join(base, "sink")
    clicks = event_clicks(spark, sf)
    clicks.write.parquet(src)
    stream = spark.readStream.schema(clicks.schema).parquet(src)
    start(stream, lambda batch: batch, sink, os.path.join(base, "ckpt"), n=5).awaitTermination()
    return read_sink(spark, sink, StructType([*clicks.schema.fields, StructField("click_count", IntegerType())]))


PRED = """,
nb AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY "order") AS rn FROM clicks),
pred AS (SELECT session_id, round(avg(higher_than_average), 4) AS prediction_probability FROM nb WHERE rn <= 5
         AND session_id IN (SELECT session_id FROM nb WHERE rn = 5) GROUP BY session_id),
pred2 AS (SELECT session_id, CASE WHEN prediction_probability >= 0.5 THEN 'high-intent' ELSE 'low-intent' END
          AS prediction_label, prediction_probability FROM pred)"""


def _predictions(clicks):
    trig = online.nth_click_trigger(clicks, 5)
    p = trig.groupBy("session_id").agg(F.round(F.avg("higher_than_average"), 4).alias("probability"))
    p = p.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))
    return online.predictions_from_scores(p)


@register("session_state", "P-11", W + PRED + """
SELECT c.session_id, c.click_count, CASE WHEN p.prediction_label IS NOT NULL THEN 'predicted' ELSE 'collecting' END
       AS status, p.prediction_label, p.prediction_probability
FROM (SELECT session_id, count(*) AS click_count FROM clicks GROUP BY 1) c LEFT JOIN pred2 p
  ON c.session_id = p.session_id""")
def q_session_state(spark, sf):
    clicks = shared_table(_prepared(spark, sf).select("session_id", "order", "higher_than_average"), "clicks")
    return online.session_state(clicks, _predictions(clicks))


@register("click_log", "P-12", W + """
SELECT "year", "month", "day", "order", country, "session ID", "page 1 (main category)", "page 2 (clothing model)",
       colour, location, "model photography", price, "price 2", page FROM raw_clicks WHERE "session ID" = 0""")
def q_click_log(spark, sf):
    return online.click_log(normalize_columns(raw_clicks(spark, sf)), 0)


@register("click_events", "P-13", W + PRED + """
SELECT n.session_id, n."order", CAST(n.rn AS INTEGER) AS click_count, CAST(n.rn = 5 AS INTEGER) AS triggered,
       CASE WHEN n.rn >= 5 THEN p.prediction_label END AS prediction_label,
       CASE WHEN n.rn >= 5 THEN p.prediction_probability END AS prediction_probability,
       CAST(coalesce(CASE WHEN n.rn >= 5 THEN p.prediction_label END = 'high-intent', false) AS INTEGER) AS show_ad
FROM nb n LEFT JOIN pred2 p ON n.session_id = p.session_id""")
def q_click_events(spark, sf):
    clicks = shared_table(_prepared(spark, sf).select("session_id", "order", "higher_than_average"), "clicks")
    return online.click_events(clicks, _predictions(clicks))


@register("click_conflict", "P-14", """
SELECT l_orderkey AS session_id, l_linenumber AS "order", count(*) AS n_rows FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1""")
def q_click_conflict(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(F.col("l_orderkey").alias("session_id"),
                                                              F.col("l_linenumber").alias("order"))
    return online.click_conflicts(li)


@register("sequence_cv", "P-04")
def q_sequence_cv(spark, sf):
    return sequences.sequence_cv(raw_clicks(spark, sf, first_n=5), manual_labels(spark, sf), n=5, k=5, max_iter=20)


# ---- file sources: derived tables written to the shared folder, read back ----

def _scratch(spark, name):
    return os.path.join(checkpoint_dir(spark), "clickweave-io", name)


@register("read_external_labels", "A-02", W + """
SELECT session_id, label, confidence FROM manual_labels""")
def q_read_external_labels(spark, sf):
    path = _scratch(spark, f"manual_labels_{uuid.uuid4().hex}")
    manual_labels(spark, sf).write.mode("overwrite").option("header", True).csv(path)
    df = files.read_external_labels(spark, path)
    return df.select(F.col("session_id").cast("bigint"), F.col("label").cast("int"),
                     F.col("confidence").cast("double"))


@register("read_frequencies", "A-04", W + FREQ5 + "\nSELECT dim, value, freq FROM ft")
def q_read_frequencies(spark, sf):
    path = _scratch(spark, f"frequencies_{uuid.uuid4().hex}")
    frequency_table(_prepared(spark, sf), 5).select("dim", "value", "freq").write.mode("overwrite").json(path)
    return files.read_frequencies(spark, path)
