"""Registered queries: labelling (H), joins (D), filters (C), G-14..G-16."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.operators import features, filters, joins, labels
from clickweave.operators.clean import normalize_intent_label_text
from clickweave.plans import standins as T
from clickweave.session import shared_table
from clickweave.plans.registry import CLICKS_CTE, MANUAL_LABELS_CTE, register
from clickweave.sources.tables import TEXT_LABELS_CTE, manual_labels, raw_clicks, text_labels

W = "WITH " + CLICKS_CTE + ",\n" + MANUAL_LABELS_CTE + ",\n" + TEXT_LABELS_CTE + f""",
assign8 AS ({T.assignments_sql(8)}),
assign10 AS ({T.assignments_sql(10)}),
cmap AS ({T.CLUSTER_MAP_SQL}),
proxy AS (
  SELECT session_id, CAST(count("order") >= 8 AND avg(higher_than_average) >= 0.5 AS INTEGER) AS label,
         'proxy_hybrid' AS label_source, CAST(1.0 AS DOUBLE) AS label_confidence
  FROM clicks GROUP BY session_id
),
sessions AS (SELECT DISTINCT session_id FROM clicks),
manual AS (
  SELECT s.session_id, m.label, CASE WHEN m.label IS NULL THEN 'unlabeled' ELSE 'manual' END AS label_source,
         CAST(m.confidence AS DOUBLE) AS label_confidence
  FROM sessions s LEFT JOIN manual_labels m ON s.session_id = m.session_id
),
cluster_file AS (
  SELECT a.session_id, CAST(CASE c.intent_label WHEN 'high-intent' THEN 1 ELSE 0 END AS INTEGER) AS label
  FROM assign8 a JOIN cmap c ON a.cluster_id = c.cluster_id
),
cluster_only AS (
  SELECT s.session_id, f.label, CASE WHEN f.label IS NULL THEN 'unlabeled' ELSE 'cluster' END AS label_source,
         CASE WHEN f.label IS NULL THEN NULL ELSE CAST(1.0 AS DOUBLE) END AS label_confidence
  FROM sessions s LEFT JOIN cluster_file f ON s.session_id = f.session_id
)"""


def override_sql(base: str, over: str) -> str:
    return f"""
SELECT b.session_id,
       CASE WHEN o.label IS NOT NULL THEN o.label ELSE b.label END AS label,
       CASE WHEN o.label IS NOT NULL THEN o.label_source ELSE b.label_source END AS label_source,
       CASE WHEN o.label IS NOT NULL THEN o.label_confidence ELSE b.label_confidence END AS label_confidence
FROM {base} b LEFT JOIN {over} o ON b.session_id = o.session_id"""


def _clicks(spark, sf):
    return raw_clicks(spark, sf)


def _label_file(spark, sf):
    """The manual labels with repeats, as a label file has them: every third
    session carries an earlier, opposite row; the later row decides."""
    last = manual_labels(spark, sf)
    earlier = last.where("session_id % 3 = 0").select("session_id", (1 - F.col("label")).alias("label"),
                                                      F.lit(0.1).alias("confidence"), F.lit(0).alias("file_row"))
    return last.withColumn("file_row", F.lit(1)).unionByName(earlier)


def _manual(spark, sf, sessions=None):
    return labels.external_labels(sessions or _clicks(spark, sf), _label_file(spark, sf), "manual",
                                  confidence_column="confidence", row_order="file_row")


def _cluster_file(spark, sf):
    return labels.cluster_session_labels(T.assignments(spark, sf, 8), T.cluster_label_map(spark))


def _cluster_only(spark, sf):
    return labels.external_labels(_clicks(spark, sf), _cluster_file(spark, sf), "cluster")


@register("proxy_labels", "H-01", W + "\nSELECT * FROM proxy")
def q_proxy_labels(spark, sf):
    return labels.proxy_labels(_clicks(spark, sf))


@register("external_labels", "H-02", W + "\nSELECT * FROM manual")
def q_external_labels(spark, sf):
    return _manual(spark, sf)


@register("manual_over_proxy", "H-03", W + override_sql("proxy", "manual"))
def q_manual_over_proxy(spark, sf):
    proxy = shared_table(labels.proxy_labels(_clicks(spark, sf)), "proxy")  # one build of the clicks: its sessions are theirs
    return labels.override_labels(proxy, _manual(spark, sf, proxy.select("session_id")))


@register("cluster_over_proxy", "H-04", W + override_sql("proxy", "cluster_only"))
def q_cluster_over_proxy(spark, sf):
    proxy = shared_table(labels.proxy_labels(_clicks(spark, sf)), "proxy")
    sessions = proxy.select("session_id")
    file = labels.cluster_session_labels(T.assigned(sessions, 8), T.cluster_label_map(spark))
    return labels.override_labels(proxy, labels.external_labels(sessions, file, "cluster"))


@register("manual_only", "H-05", W + "\nSELECT * FROM manual")
def q_manual_only(spark, sf):
    return labels.session_labels(_clicks(spark, sf), "manual_only", manual=_label_file(spark, sf),
                                 confidence_column="confidence", row_order="file_row")


@register("cluster_only", "H-05", W + "\nSELECT * FROM cluster_only")
def q_cluster_only(spark, sf):
    return labels.session_labels(_clicks(spark, sf), "cluster_only", cluster=_cluster_file(spark, sf))


@register("session_labels", "H-06", W + override_sql("proxy", "manual"))
def q_session_labels(spark, sf):
    c = _clicks(spark, sf)
    return labels.session_labels(c, "manual_over_proxy", manual=_label_file(spark, sf),
                                 confidence_column="confidence", row_order="file_row",
                                 session_filter=labels.session_ids(c))


@register("cluster_session_labels", "H-07", W + "\nSELECT session_id, label FROM cluster_file")
def q_cluster_session_labels(spark, sf):
    return _cluster_file(spark, sf)


@register("sessions_left_labels", "D-01", W + """
SELECT s.session_id, m.label, m.confidence FROM sessions s LEFT JOIN manual_labels m ON s.session_id = m.session_id""")
def q_sessions_left_labels(spark, sf):
    return joins.sessions_left_labels(labels.session_ids(_clicks(spark, sf)), manual_labels(spark, sf))


@register("align_labels", "D-02", W + "\nSELECT s.session_id, p.label, p.label_source, p.label_confidence "
          "FROM sessions s LEFT JOIN proxy p ON s.session_id = p.session_id")
def q_align_labels(spark, sf):
    c = _clicks(spark, sf)
    return labels.align_labels(labels.session_ids(c), labels.proxy_labels(c), validate=True)


@register("assignments_inner_labels", "D-03", W + """
SELECT a.cluster_id, a.session_id, c.intent_label FROM assign8 a JOIN cmap c ON a.cluster_id = c.cluster_id""")
def q_assignments_inner_labels(spark, sf):
    return joins.assignments_inner_labels(T.assignments(spark, sf, 8), T.cluster_label_map(spark))


@register("propagate_cluster_labels", "D-05", W + """
SELECT a.session_id, a.cluster_id, c.intent_label FROM assign10 a LEFT JOIN cmap c ON a.cluster_id = c.cluster_id""")
def q_propagate_cluster_labels(spark, sf):
    lm = T.cluster_label_map(spark).withColumn("_row", F.col("cluster_id"))
    return joins.propagate_cluster_labels(T.assignments(spark, sf, 10), lm, row_order="_row")


@register("filter_session", "C-01", W + "\nSELECT * FROM clicks WHERE session_id = 0")
def q_filter_session(spark, sf):
    return filters.filter_session(T.clicks(spark, sf), 0)


@register("clicks_with_labels", "C-02", W + """
SELECT * FROM clicks c WHERE c.session_id IN (SELECT session_id FROM manual_labels)""")
def q_clicks_with_labels(spark, sf):
    return filters.clicks_with_labels(T.clicks(spark, sf), manual_labels(spark, sf))


@register("labeled_only", "C-03", W + "\nSELECT * FROM manual WHERE label IS NOT NULL")
def q_labeled_only(spark, sf):
    return filters.labeled_only(_manual(spark, sf))


@register("valid_cluster_labels", "C-04", W + """
, n AS (SELECT session_id, replace(replace(replace(lower(trim(intent_label)), '_', '-'), ' ', '-'), '‑', '-')
        AS intent_label FROM text_labels)
SELECT session_id, intent_label FROM n WHERE intent_label IN ('low-intent', 'high-intent')""")
def q_valid_cluster_labels(spark, sf):
    t = text_labels(spark, sf).select("session_id", normalize_intent_label_text("intent_label").alias("intent_label"))
    return filters.valid_cluster_labels(t)


@register("unlabeled_clusters", "C-05", W + """
SELECT DISTINCT cluster_id FROM assign10 WHERE cluster_id NOT IN (SELECT cluster_id FROM cmap)""")
def q_unlabeled_clusters(spark, sf):
    return filters.unlabeled_clusters(T.assignments(spark, sf, 10), T.cluster_label_map(spark))


@register("country_share", "G-14", W + """
, tot AS (SELECT count(*) AS nc, count(DISTINCT session_id) AS ns FROM clicks)
SELECT country, count(*) AS n_clicks, count(DISTINCT session_id) AS n_sessions,
       count(*) / max(tot.nc) AS click_share, count(DISTINCT session_id) / max(tot.ns) AS session_share
FROM clicks CROSS JOIN tot GROUP BY country""")
def q_country_share(spark, sf):
    return features.country_share(T.clicks(spark, sf))


@register("class_distribution", "G-15", W + "\nSELECT label, count(*) AS n_sessions FROM proxy GROUP BY label")
def q_class_distribution(spark, sf):
    return features.class_distribution(labels.proxy_labels(_clicks(spark, sf)))


@register("label_conflicts", "G-16", W + """
, two_labels AS (
  SELECT a.session_id, CASE c.intent_label WHEN 'high-intent' THEN 1 ELSE 0 END AS label
  FROM (SELECT * FROM assign8 UNION ALL SELECT DISTINCT session_id, CAST(session_id % 3 AS INTEGER) FROM clicks) a
  JOIN cmap c ON a.cluster_id = c.cluster_id)
SELECT session_id, count(DISTINCT label) AS n_labels FROM two_labels GROUP BY session_id HAVING count(DISTINCT label) > 1""")
def q_label_conflicts(spark, sf):
    two = T.assignments(spark, sf, 8).unionByName(T.assignments(spark, sf, 3))
    j = two.join(T.cluster_label_map(spark), "cluster_id").select(
        "session_id", (F.col("intent_label") == "high-intent").cast("int").alias("label"))
    return features.label_conflicts(j)
