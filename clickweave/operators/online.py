"""Session sequences (P-01) and the batch forms of online scoring (P-06 .. P-14)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickweave.functions.values import PREDICTION_LABELS, decode
from clickweave.operators.windows import click_window, first_n_clicks


# P-01
def session_sequences(clicks: DataFrame, labels: DataFrame, n: int, cols: Sequence[str]) -> DataFrame:
    """Per labelled session: its first ``n`` clicks as an ordered array of
    feature vectors. The per-session collect holds at most ``n`` rows (the
    first-N cut runs before it, also map-side)."""
    sel = first_n_clicks(clicks.join(labels.select("session_id"), "session_id", "left_semi"), n)
    w = click_window()
    vec = F.array(*[F.col(c).cast("double") for c in cols])
    per = sel.select("session_id", F.row_number().over(w).alias("pos"), vec.alias("x"))
    seq = per.groupBy("session_id").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("steps"))
    return seq.join(labels.select("session_id", "label"), "session_id")


# P-09 (batch twin): sessions that reach exactly click N emit their first N clicks once
def nth_click_trigger(clicks: DataFrame, n: int = 5, tiebreak: Sequence[str] = ()) -> DataFrame:
    w = click_window(tiebreak)
    numbered = clicks.withColumn("click_count", F.row_number().over(w))
    reached = numbered.where(F.col("click_count") == n).select("session_id")
    return numbered.where(F.col("click_count") <= n).join(reached, "session_id", "left_semi")


# P-11
def session_state(clicks: DataFrame, predictions: DataFrame, n: int = 5) -> DataFrame:
    per = clicks.groupBy("session_id").agg(F.count(F.lit(1)).alias("click_count"))
    p = predictions.select("session_id", "prediction_label", "prediction_probability")
    out = per.join(p, "session_id", "left")
    status = F.when(F.col("prediction_label").isNotNull(), "predicted").otherwise("collecting")
    return out.select("session_id", "click_count", status.alias("status"), "prediction_label",
                      "prediction_probability")


# P-12
def click_log(clicks: DataFrame, session_id: int) -> DataFrame:
    from clickweave.operators.clean import to_raw_rows

    return to_raw_rows(clicks.where(F.col("session_id") == session_id)).orderBy("order")


# P-13
def click_events(clicks: DataFrame, predictions: DataFrame, n: int = 5) -> DataFrame:
    """Per click: running count, triggered (exactly at click n), prediction in
    force (null before the n-th click) and show_ad (prediction is high-intent)."""
    from clickweave.operators.windows import click_rank

    numbered = click_rank(clicks.select("session_id", "order"))
    p = predictions.select("session_id", "prediction_label", "prediction_probability")
    j = numbered.join(p, "session_id", "left")
    active = F.col("click_count") >= n
    label = F.when(active, F.col("prediction_label"))
    return j.select("session_id", "order", "click_count", (F.col("click_count") == n).cast("int").alias("triggered"),
                    label.alias("prediction_label"),
                    F.when(active, F.col("prediction_probability")).alias("prediction_probability"),
                    F.coalesce(label == "high-intent", F.lit(False)).cast("int").alias("show_ad"))


# P-14
def click_conflicts(clicks: DataFrame, keys: Sequence[str] = ("session_id", "order")) -> DataFrame:
    return clicks.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def predictions_from_scores(scored: DataFrame) -> DataFrame:
    return scored.select("session_id", decode(F.col("prediction"), PREDICTION_LABELS).alias("prediction_label"),
                         F.col("probability").alias("prediction_probability"))


# P-07
def score_sessions(clicks: DataFrame, model, expected: Sequence[str], freqs: DataFrame | None = None,
                   n: int = 5) -> DataFrame:
    """Batch scoring of every session: first-N features (stored frequencies
    when given) -> aligned to the model's inputs -> model -> label text and
    probability rounded to 4 digits."""
    from clickweave.operators.clean import align_to_model_features, round_probability
    from clickweave.operators.features import build_session_features
    from clickweave.operators.training import probability_of_one

    feats = build_session_features(clicks, n, "first_n", freqs=freqs)
    aligned = align_to_model_features(feats, list(expected)).withColumn("weight", F.lit(1.0))
    pred = probability_of_one(model.transform(aligned.withColumn("label", F.lit(0))))
    out = pred.select("session_id", "probability", F.col("prediction").cast("int").alias("prediction"))
    return round_probability(out).select("session_id", "label", "probability")


# P-08
def validate_single_session(clicks: DataFrame) -> DataFrame:
    """Batch form: one row per offending input problem (empty input, missing
    id / order column, more than one session id)."""
    spark = clicks.sparkSession
    problems = []
    if clicks.limit(1).count() == 0:
        problems.append("clicks DataFrame is empty")
    for c in ("session_id", "order"):
        if c not in clicks.columns:
            problems.append(f"missing required column `{c}`")
    if "session_id" in clicks.columns:
        n = clicks.agg(F.count_distinct("session_id")).first()[0]
        if n != 1:
            problems.append(f"expected exactly one session_id, found {n}")
    return spark.createDataFrame([(p,) for p in problems], "problem STRING")
