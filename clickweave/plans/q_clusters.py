"""Registered queries: statistics and pruning (I), clustering (J), cluster
labels (K) and the feature/label joins D-04, D-06, D-09, D-10.

Cluster assignments are the stand-in ``session_id % 8``; centroids are the
means of the scaled features per stand-in cluster. Doubles that depend on
summation order are rounded in both engines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.functions.values import CLUSTER_FEATURES
from clickweave.operators import clusters, features, joins, labels, stats
from clickweave.plans import sql_features as S
from clickweave.plans import standins as T
from clickweave.session import shared_table
from clickweave.plans.registry import CLICKS_CTE, EVENT_CLICKS_CTE, MANUAL_LABELS_CTE, register
from clickweave.sources.tables import event_clicks, manual_labels, raw_clicks

SPACE = ["n_clicks_observed", "n_unique_pages", "price_mean", "price_std", "high_price_share_first_n",
         "category_entropy", "top_category_share", "last_page"]
FEATS = CLUSTER_FEATURES
K = 8


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


def feats_full(spark, sf):
    return features.build_session_features(raw_clicks(spark, sf), aggregation_mode="full_session")


def feats_written(spark, sf, cols=FEATS):
    """Full-session features, written once: steps that read them several times shuffle the clicks once."""
    return shared_table(feats_full(spark, sf).select("session_id", *cols), "features")


def feats_first(spark, sf):
    return features.build_session_features(raw_clicks(spark, sf, first_n=5), 5, "first_n")


def scaled(spark, sf, cols=SPACE, f=None):
    if f is None:
        f = feats_written(spark, sf, cols)  # moments and rows from one build of the clicks
    return stats.standardize(f, cols)


def summary(spark, sf, f=None):
    f = shared_table(feats_full(spark, sf), "features") if f is None else f  # assignments and features from one build of the clicks
    return clusters.cluster_summary(T.assigned(f, K), f)


# ---- SQL building blocks ----------------------------------------------------

def scaled_cte(cols, src="feat", name="scaled") -> str:
    mom = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in cols)
    z = ", ".join(f"({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END AS {c}" for c in cols)
    return f""",
mom_{name} AS (SELECT {mom} FROM {src}),
{name} AS (SELECT session_id, {z} FROM {src} CROSS JOIN mom_{name})"""


def sqdist(a: str, b: str, cols) -> str:
    return " + ".join(f"({a}.{c} - {b}.{c}) * ({a}.{c} - {b}.{c})" for c in cols)


BASE = ("WITH " + CLICKS_CTE + ",\n" + MANUAL_LABELS_CTE + S.features_cte("feat")
        + f""",
assign AS ({T.assignments_sql(K)})""")

SUMMARY_CTE = f""",
summ AS (
  SELECT a.cluster_id, count(a.session_id) AS cluster_size,
         count(a.session_id) / (SELECT count(*) FROM assign) * 100 AS cluster_percentage,
         {", ".join(f"avg(f.{c}) AS mean_{c}" for c in FEATS)}
  FROM assign a LEFT JOIN feat f ON a.session_id = f.session_id GROUP BY a.cluster_id
)"""

SPACE_CTE = scaled_cte(SPACE) + f""",
cent AS (SELECT CAST(session_id % {K} AS INTEGER) AS cluster_id, {", ".join(f"avg({c}) AS {c}" for c in SPACE)}
         FROM scaled GROUP BY 1),
own AS (
  SELECT s.session_id, c.cluster_id, {sqdist('s', 'c', SPACE)} AS d2
  FROM scaled s JOIN cent c ON CAST(s.session_id % {K} AS INTEGER) = c.cluster_id
)"""


def summary_select(cols) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" if c.startswith("mean_") or c == "cluster_percentage" else c
                     for c in cols)


SUMMARY_COLS = ["cluster_id", "cluster_size", "cluster_percentage"] + [f"mean_{c}" for c in FEATS]


def round_summary(df):
    return df.select(*[_r(c) if c.startswith("mean_") or c == "cluster_percentage" else F.col(c)
                       for c in df.columns])


# ---- I: statistics -----------------------------------------------------------

def _corr_sql():
    pairs = [(i, j) for i in range(len(FEATS)) for j in range(i + 1, len(FEATS))]
    rows = " UNION ALL ".join(
        f"SELECT '{FEATS[i]}' AS feature_a, '{FEATS[j]}' AS feature_b, {i} AS pos_a, {j} AS pos_b, "
        f"c_{i}_{j} AS corr FROM w" for i, j in pairs)
    aggs = ", ".join(f"corr({FEATS[i]}, {FEATS[j]}) AS c_{i}_{j}" for i, j in pairs)
    return f""",
w AS (SELECT {aggs} FROM feat),
corr_long AS (SELECT feature_a, feature_b, CAST(pos_a AS INTEGER) AS pos_a, CAST(pos_b AS INTEGER) AS pos_b,
  CASE WHEN isnan(corr) THEN NULL ELSE round(corr, 6) END AS corr FROM ({rows}))"""


def _corr(spark, sf):
    c = stats.correlation_matrix(feats_written(spark, sf), FEATS)
    return c.select("feature_a", "feature_b", F.col("pos_a").cast("int").alias("pos_a"),
                    F.col("pos_b").cast("int").alias("pos_b"), _r("corr"))


@register("correlation_matrix", "I-01", BASE + _corr_sql() + "\nSELECT * FROM corr_long")
def q_correlation_matrix(spark, sf):
    return _corr(spark, sf)


@register("high_corr_pairs", "I-02", BASE + _corr_sql() +
          "\nSELECT *, abs(corr) AS abs_corr FROM corr_long WHERE abs(corr) > 0.7")
def q_high_corr_pairs(spark, sf):
    return stats.high_corr_pairs(_corr(spark, sf), 0.7)


NAMES_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{c}', {i})" for i, c in enumerate(FEATS)) + ") AS n(feature, position)"


@register("drop_correlated", "I-03", BASE + _corr_sql() + f"""
, hits AS (SELECT feature_b AS feature, count(*) AS n FROM corr_long WHERE abs(corr) > 0.7 GROUP BY 1)
SELECT n.feature, CAST(n.position AS INTEGER) AS position, CAST(h.n IS NOT NULL AS INTEGER) AS dropped
FROM ({NAMES_SQL}) n LEFT JOIN hits h ON n.feature = h.feature""")
def q_drop_correlated(spark, sf):
    return stats.drop_correlated(_corr(spark, sf), FEATS, 0.7)


@register("drop_low_variance", "I-04", BASE + """
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(var_samp({c}), 6) AS variance, CAST(var_samp({c}) <= 1e-8 AS INTEGER) AS dropped FROM feat"
    for c in FEATS) + ")")
def q_drop_low_variance(spark, sf):
    return stats.drop_low_variance(feats_full(spark, sf), FEATS).select("feature", _r("variance"), "dropped")


@register("standardize", "I-06", BASE + scaled_cte(FEATS) + "\nSELECT session_id, "
          + ", ".join(f"round({c}, 6) AS {c}" for c in FEATS) + " FROM scaled")
def q_standardize(spark, sf):
    z = stats.standardize(feats_written(spark, sf), FEATS)
    return z.select("session_id", *[_r(c) for c in FEATS])


CV_CTE = SUMMARY_CTE + """,
cv AS (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT 'mean_{c}' AS feature, stddev_samp(mean_{c}) AS std_dev, avg(mean_{c}) AS mean FROM summ" for c in FEATS
) + """)),
cvx AS (SELECT feature, CASE WHEN mean <> 0 THEN std_dev / mean ELSE 0.0 END AS coefficient_of_variation,
        std_dev, mean FROM cv)"""


def _cv(spark, sf):
    return stats.feature_cv(summary(spark, sf).select("cluster_id", *[f"mean_{c}" for c in FEATS]))


def _round_cv(df):
    return df.select(*[_r(c) if c in ("coefficient_of_variation", "std_dev", "mean", "cv_value", "threshold_value",
                                      "percentage") else F.col(c) for c in df.columns])


@register("feature_cv", "I-08", BASE + CV_CTE + """
SELECT feature, round(coefficient_of_variation, 6) AS coefficient_of_variation, round(std_dev, 6) AS std_dev,
       round(mean, 6) AS mean FROM cvx""")
def q_feature_cv(spark, sf):
    return _round_cv(_cv(spark, sf))


@register("select_discriminative", "I-09", BASE + CV_CTE + """
, th AS (SELECT quantile_cont(coefficient_of_variation, 0.75) AS t FROM cvx)
SELECT feature, round(coefficient_of_variation, 6) AS coefficient_of_variation, round(std_dev, 6) AS std_dev,
       round(mean, 6) AS mean, round(t, 6) AS threshold_value
FROM cvx CROSS JOIN th WHERE coefficient_of_variation >= t""")
def q_select_discriminative(spark, sf):
    return _round_cv(stats.select_discriminative(_cv(spark, sf), 0.75))


@register("threshold_comparison", "I-10", BASE + CV_CTE + """
, cuts AS (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{name}' AS threshold, CAST({p} AS DOUBLE) AS percentile, "
    f"(SELECT quantile_cont(coefficient_of_variation, {p}) FROM cvx) AS cv_value"
    for name, p in stats.CV_PERCENTILES.items()) + """))
SELECT threshold, percentile, round(cv_value, 6) AS cv_value,
   (SELECT count(*) FROM cvx WHERE coefficient_of_variation >= cv_value) AS features_selected,
   round((SELECT count(*) FROM cvx WHERE coefficient_of_variation >= cv_value) / (SELECT count(*) FROM cvx) * 100, 6)
     AS percentage
FROM cuts""")
def q_threshold_comparison(spark, sf):
    return _round_cv(stats.threshold_comparison(_cv(spark, sf)))


BINS_SQL = """
  CASE WHEN mean_n_clicks_observed > 0 AND mean_n_clicks_observed <= 2 THEN 'Low'
       WHEN mean_n_clicks_observed > 2 AND mean_n_clicks_observed <= 3.5 THEN 'Medium'
       WHEN mean_n_clicks_observed > 3.5 AND mean_n_clicks_observed <= 5 THEN 'High' END AS engagement_level,
  CASE WHEN mean_price_mean > 0 AND mean_price_mean <= 40 THEN 'Budget'
       WHEN mean_price_mean > 40 AND mean_price_mean <= 50 THEN 'Mid-Range'
       WHEN mean_price_mean > 50 AND mean_price_mean <= 100 THEN 'Premium' END AS price_tier"""


@register("bin_segments", "I-11", BASE + SUMMARY_CTE + f"""
SELECT cluster_id, round(cluster_percentage, 6) AS cluster_percentage,
       round(mean_n_clicks_observed, 6) AS mean_n_clicks_observed, round(mean_price_mean, 6) AS mean_price_mean,
       {BINS_SQL} FROM summ""")
def q_bin_segments(spark, sf):
    return round_summary(stats.bin_segments(summary(spark, sf)))


@register("segment_summary", "I-12", BASE + SUMMARY_CTE + f""",
b AS (SELECT cluster_id, cluster_percentage, mean_n_clicks_observed, mean_price_mean, {BINS_SQL} FROM summ)
SELECT engagement_level, price_tier, count(cluster_id) AS n_clusters,
       round(sum(cluster_percentage), 6) AS total_pct_sessions, round(avg(mean_n_clicks_observed), 6) AS avg_clicks,
       round(avg(mean_price_mean), 6) AS avg_price
FROM b WHERE engagement_level IS NOT NULL AND price_tier IS NOT NULL GROUP BY 1, 2""")
def q_segment_summary(spark, sf):
    s = stats.segment_summary(stats.bin_segments(summary(spark, sf)))
    return s.select("engagement_level", "price_tier", "n_clusters", _r("total_pct_sessions"), _r("avg_clicks"),
                    _r("avg_price"))


DESC_COLS = ["cluster_size", "cluster_percentage", "mean_n_clicks_observed", "mean_price_mean"]


@register("describe_clusters_numeric", "I-13", BASE + SUMMARY_CTE + "\nSELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
    f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM summ" for c in DESC_COLS) + ")")
def q_describe_clusters_numeric(spark, sf):
    d = stats.describe_numeric(summary(spark, sf), DESC_COLS)
    return d.select("column_name", "count", *[_r(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


@register("positioning_medians", "I-14", BASE + SUMMARY_CTE + """
SELECT cluster_id, cluster_size, round(mean_n_clicks_observed, 6) AS x_clicks, round(mean_price_mean, 6) AS y_price,
       round((SELECT quantile_cont(mean_n_clicks_observed, 0.5) FROM summ), 6) AS median_clicks,
       round((SELECT quantile_cont(mean_price_mean, 0.5) FROM summ), 6) AS median_price FROM summ""")
def q_positioning_medians(spark, sf):
    p = stats.positioning_medians(summary(spark, sf))
    return p.select("cluster_id", "cluster_size", *[_r(c) for c in ["x_clicks", "y_price", "median_clicks",
                                                                      "median_price"]])


@register("engagement_comparison", "I-15", BASE + SUMMARY_CTE + "\nSELECT cluster_id, " + ", ".join(
    f"round({c}, 6) AS {c}" for c in stats.ENGAGEMENT_COLUMNS) + " FROM summ")
def q_engagement_comparison(spark, sf):
    return round_summary(stats.engagement_comparison(summary(spark, sf)))


@register("category_preferences", "I-16", BASE + SUMMARY_CTE + "\nSELECT * FROM (" + " UNION ALL ".join(
    f"SELECT cluster_id, '{c}' AS category, round(mean_category_share_{c}, 6) AS share FROM summ"
    for c in ["blouses", "sale", "skirts", "trousers"]) + ")")
def q_category_preferences(spark, sf):
    p = stats.category_preferences(summary(spark, sf))
    return p.select("cluster_id", "category", _r("share"))


# ---- J: clustering on fixed (stand-in) centroids ------------------------------

def _space(spark, sf, f=None):
    z = scaled(spark, sf, f=f)
    a = T.assigned(z, K)
    return z, a, clusters.centroids_of(z, a, SPACE)


@register("assign_clusters", "J-02", BASE + SPACE_CTE + f""",
d AS (SELECT s.session_id, c.cluster_id, {sqdist('s', 'c', SPACE)} AS d2 FROM scaled s CROSS JOIN cent c),
best AS (SELECT session_id, arg_min(cluster_id, d2) AS cluster_id, min(d2) AS d2 FROM d GROUP BY session_id)
SELECT session_id, CAST(cluster_id AS INTEGER) AS cluster_id, round(sqrt(d2), 6) AS distance_to_centroid,
       round(d2, 6) AS squared_distance FROM best""")
def q_assign_clusters(spark, sf):
    z, _, cent = _space(spark, sf)
    out = clusters.assign_clusters(z, SPACE, cent)
    return out.select("session_id", "cluster_id", _r("distance_to_centroid"), _r("squared_distance"))


@register("distance_to_centroid", "J-03", BASE + SPACE_CTE + """
SELECT session_id, cluster_id, round(sqrt(d2), 6) AS distance_to_centroid, round(d2, 6) AS squared_distance FROM own""")
def q_distance_to_centroid(spark, sf):
    z, a, cent = _space(spark, sf)
    d = clusters.distance_to_own(z, a, SPACE, cent)
    return d.select("session_id", "cluster_id", _r("distance_to_centroid"), _r("squared_distance"))


@register("cluster_inertia", "J-04", BASE + SPACE_CTE + "\nSELECT round(sum(d2), 3) AS inertia FROM own")
def q_cluster_inertia(spark, sf):
    z, a, cent = _space(spark, sf)
    return clusters.cluster_inertia(clusters.distance_to_own(z, a, SPACE, cent)).select(_r("inertia", 3))


X2 = " + ".join(f"s.{c} * s.{c}" for c in SPACE)


@register("silhouette", "J-05", BASE + SPACE_CTE + f""",
cst AS (SELECT CAST(session_id % {K} AS INTEGER) AS cluster_id, count(*) AS n, sum({X2}) AS q,
        {", ".join(f"sum(s.{c}) AS {c}" for c in SPACE)} FROM scaled s GROUP BY 1),
tt AS (
  SELECT s.session_id, CAST(s.session_id % {K} AS INTEGER) AS own_id, c.cluster_id, c.n,
         c.n * ({X2}) - 2.0 * ({" + ".join(f"s.{c} * c.{c}" for c in SPACE)}) + c.q AS total
  FROM scaled s CROSS JOIN cst c
),
per AS (
  SELECT session_id,
         max(CASE WHEN cluster_id = own_id THEN n END) AS own_n,
         max(CASE WHEN cluster_id = own_id THEN total END) AS own_total,
         min(CASE WHEN cluster_id <> own_id THEN total / n END) AS b
  FROM tt GROUP BY session_id
)
SELECT round(avg(CASE WHEN own_n <= 1 THEN 0.0 ELSE (b - own_total / (own_n - 1)) / greatest(own_total / (own_n - 1), b) END), 6)
  AS silhouette_squared_euclidean FROM per""")
def q_silhouette(spark, sf):
    z, a, _ = _space(spark, sf)
    return clusters.silhouette_squared(z, a, SPACE).select(_r("silhouette_squared_euclidean"))


@register("calinski_harabasz", "J-06", BASE + SPACE_CTE + f""",
mu AS (SELECT {", ".join(f"avg({c}) AS {c}" for c in SPACE)} FROM scaled),
bw AS (SELECT sum(n * ({sqdist('cs', 'mu', SPACE)})) AS b FROM
        (SELECT c.*, (SELECT count(*) FROM scaled s WHERE CAST(s.session_id % {K} AS INTEGER) = c.cluster_id) AS n
         FROM cent c) cs CROSS JOIN mu)
SELECT round((b / ({K} - 1)) / ((SELECT sum(d2) FROM own) / ((SELECT count(*) FROM scaled) - {K})), 3)
  AS calinski_harabasz FROM bw""")
def q_calinski_harabasz(spark, sf):
    z, a, _ = _space(spark, sf)
    return clusters.calinski_harabasz(z, a, SPACE).select(_r("calinski_harabasz", 3))


@register("davies_bouldin", "J-07", BASE + SPACE_CTE + f""",
sc AS (SELECT cluster_id, avg(sqrt(d2)) AS s FROM own GROUP BY 1),
pairs AS (SELECT a.cluster_id AS i, (sa.s + sb.s) / sqrt({sqdist('a', 'b', SPACE)}) AS r
          FROM cent a JOIN cent b ON a.cluster_id <> b.cluster_id
          JOIN sc sa ON sa.cluster_id = a.cluster_id JOIN sc sb ON sb.cluster_id = b.cluster_id)
SELECT round(avg(m), 6) AS davies_bouldin FROM (SELECT i, max(r) AS m FROM pairs GROUP BY i)""")
def q_davies_bouldin(spark, sf):
    z, a, cent = _space(spark, sf)
    return clusters.davies_bouldin(clusters.distance_to_own(z, a, SPACE, cent), cent).select(_r("davies_bouldin"))


@register("cluster_summary", "J-08", BASE + SUMMARY_CTE + "\nSELECT " + summary_select(SUMMARY_COLS) + " FROM summ")
def q_cluster_summary(spark, sf):
    return round_summary(summary(spark, sf).select(*SUMMARY_COLS))


@register("cluster_diagnostics", "J-09", BASE + f""",
sz AS (SELECT cluster_id, count(*) AS cluster_size, count(*) / (SELECT count(*) FROM assign) * 100 AS pct
       FROM assign GROUP BY 1)
SELECT cluster_id, cluster_size, round(pct, 6) AS cluster_percentage, CAST(pct < 1.0 AS INTEGER) AS small_cluster_lt_1pct,
       round(max(pct) OVER (), 6) AS largest_cluster_share_pct,
       CAST(max(pct) OVER () > 30.0 AS INTEGER) AS imbalanced_distribution_gt_30pct, 0 AS silhouette_below_0_1
FROM sz""")
def q_cluster_diagnostics(spark, sf):
    d = clusters.cluster_diagnostics(T.assignments(spark, sf, K), None)
    return d.select("cluster_id", "cluster_size", _r("cluster_percentage"), "small_cluster_lt_1pct",
                    _r("largest_cluster_share_pct"), "imbalanced_distribution_gt_30pct", "silhouette_below_0_1")


@register("fit_kmeans", "J-01")
def q_fit_kmeans(spark, sf):
    z = scaled(spark, sf)
    cent, cost = clusters.fit_kmeans(z, SPACE, K, seed=42, n_init=10)
    return clusters.assign_clusters(z, SPACE, cent)


@register("k_sweep", "J-10")
def q_k_sweep(spark, sf):
    return clusters.k_sweep(scaled(spark, sf), SPACE, n_init=10)


# ---- K: cluster labels -------------------------------------------------------

@register("manual_cluster_labels", "K-01", BASE + f""",
cmap AS ({T.CLUSTER_MAP_SQL})
SELECT a.session_id, a.cluster_id, c.intent_label FROM assign a LEFT JOIN cmap c ON a.cluster_id = c.cluster_id""")
def q_manual_cluster_labels(spark, sf):
    return clusters.manual_cluster_labels(T.assignments(spark, sf, K), T.cluster_label_map(spark))


def _event_rates(spark, sf):
    ev = event_clicks(spark, sf).select("session_id", (F.col("session_id") % K).cast("int").alias("cluster_id"),
                                        (F.col("page_1_main_category") == 3).cast("int").alias("purchase_flag"))
    return ev


EVENTS_BASE = "WITH " + EVENT_CLICKS_CTE + f""",
ev AS (SELECT session_id, CAST(session_id % {K} AS INTEGER) AS cluster_id,
              CAST(page_1_main_category = 3 AS INTEGER) AS purchase_flag FROM event_clicks),
rates AS (SELECT cluster_id, avg(purchase_flag) AS purchase_rate FROM ev GROUP BY 1),
users AS (SELECT DISTINCT session_id, cluster_id FROM ev)"""


@register("auto_cluster_labels", "K-02", EVENTS_BASE + """
SELECT u.session_id, u.cluster_id,
       CASE WHEN r.purchase_rate <= 0.19 THEN 'low_intent' WHEN r.purchase_rate >= 0.21 THEN 'high_intent'
            ELSE 'medium_intent' END AS intent_label
FROM users u LEFT JOIN rates r ON u.cluster_id = r.cluster_id""")
def q_auto_cluster_labels(spark, sf):
    ev = _event_rates(spark, sf)
    users = ev.select("session_id", "cluster_id").distinct()
    return clusters.auto_cluster_labels(users, clusters.purchase_rate(ev), high_threshold=0.21, low_threshold=0.19)


@register("default_unlabeled", "K-03", BASE + "\nSELECT session_id, cluster_id, 'unlabeled' AS intent_label FROM assign")
def q_default_unlabeled(spark, sf):
    return clusters.default_unlabeled(T.assignments(spark, sf, K))


SAVED_LABELS = {0: " Low_Intent", 1: "high intent", 2: "HIGH-INTENT", 3: "medium-intent", 4: "", 5: "low‑intent"}


def _saved(spark):
    return spark.createDataFrame([(str(k), v) for k, v in SAVED_LABELS.items()] + [("x", "low-intent")],
                                 "cluster_id STRING, intent_label STRING")


SAVED_SQL = "SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in SAVED_LABELS.items()) + \
    ", ('x', 'low-intent')) AS s(cluster_id, intent_label)"


@register("load_existing_labels", "K-05", BASE + f""",
sv AS (SELECT TRY_CAST(cluster_id AS INTEGER) AS cluster_id,
              replace(replace(replace(lower(trim(intent_label)), '_', '-'), ' ', '-'), '‑', '-') AS intent_label
       FROM ({SAVED_SQL})),
ok AS (SELECT * FROM sv WHERE cluster_id IS NOT NULL AND intent_label IN ('low-intent', 'high-intent'))
SELECT DISTINCT a.cluster_id, ok.intent_label FROM assign a LEFT JOIN ok ON a.cluster_id = ok.cluster_id""")
def q_load_existing_labels(spark, sf):
    clusters_df = T.assignments(spark, sf, K).select("cluster_id").distinct()
    return clusters.load_existing_labels(clusters_df, _saved(spark))


@register("validate_cluster_labels", "K-06", EVENTS_BASE + """
SELECT cluster_id, CASE WHEN purchase_rate >= (SELECT median(purchase_rate) FROM rates) THEN 'high-intent'
                        ELSE 'low-intent' END AS intent_label FROM rates""")
def q_validate_cluster_labels(spark, sf):
    rates = clusters.purchase_rate(_event_rates(spark, sf))
    med = rates.agg(F.median("purchase_rate")).scalar()
    lbl = rates.select("cluster_id", F.when(F.col("purchase_rate") >= med, "high-intent").otherwise("low-intent")
                       .alias("intent_label"))
    return clusters.validate_cluster_labels(lbl)


SELECTED = ["n_clicks_observed", "price_mean", "category_entropy"]


@register("selected_feature_summary", "K-07", BASE + SUMMARY_CTE + "\nSELECT cluster_id, cluster_size, "
          "round(cluster_percentage, 6) AS cluster_percentage, " + ", ".join(
              f"round(mean_{c}, 6) AS mean_{c}" for c in SELECTED) + " FROM summ")
def q_selected_feature_summary(spark, sf):
    return round_summary(clusters.selected_feature_summary(summary(spark, sf), SELECTED))


# ---- D joins that need features or summaries -----------------------------------

FEAT5 = S.features_cte("feat5", 5, "first_n")


@register("features_inner_labels", "D-04", BASE + FEAT5 + """
SELECT f.* EXCLUDE (category_entropy, mean_price_deviation), round(f.category_entropy, 6) AS category_entropy,
       round(f.mean_price_deviation, 6) AS mean_price_deviation, m.label
FROM feat5 f JOIN manual_labels m ON f.session_id = m.session_id""")
def q_features_inner_labels(spark, sf):
    from clickweave.plans.q_sessions import round_unstable

    lbl = manual_labels(spark, sf).select("session_id", "label")
    return round_unstable(joins.features_inner_labels(feats_first(spark, sf), lbl))


@register("assignments_left_features", "D-06", BASE + """
SELECT a.cluster_id, f.* EXCLUDE (category_entropy), round(f.category_entropy, 6) AS category_entropy
FROM assign a LEFT JOIN feat f ON a.session_id = f.session_id""")
def q_assignments_left_features(spark, sf):
    from clickweave.plans.q_sessions import round_unstable

    f = shared_table(feats_full(spark, sf), "features")
    return round_unstable(joins.assignments_left_features(T.assigned(f, K), f))


@register("describe_clusters", "D-09", BASE + SUMMARY_CTE + f""",
it AS ({T.INTERPRETATIONS_SQL})
SELECT s.cluster_id, s.cluster_size, round(s.cluster_percentage, 6) AS cluster_percentage,
       coalesce(it.cluster_label, 'Cluster ' || CAST(s.cluster_id AS VARCHAR)) AS cluster_label,
       coalesce(it.cluster_size_pct, printf('%.1f%%', s.cluster_percentage)) AS cluster_size_pct,
       coalesce(it.business_intent, 'Description unavailable.') AS business_intent
FROM summ s LEFT JOIN it ON s.cluster_id = it.cluster_id""")
def q_describe_clusters(spark, sf):
    d = joins.describe_clusters(summary(spark, sf), T.interpretations(spark))
    return d.withColumn("cluster_percentage", F.round("cluster_percentage", 6))


@register("features_left_labels", "D-10", BASE + """
, proxy AS (SELECT session_id, CAST(count("order") >= 8 AND avg(higher_than_average) >= 0.5 AS INTEGER) AS label
            FROM clicks GROUP BY session_id)
SELECT f.* EXCLUDE (category_entropy), round(f.category_entropy, 6) AS category_entropy, p.label
FROM feat f LEFT JOIN proxy p ON f.session_id = p.session_id""")
def q_features_left_labels(spark, sf):
    from clickweave.plans.q_sessions import round_unstable

    lbl = labels.proxy_labels(raw_clicks(spark, sf)).select("session_id", "label")
    return round_unstable(joins.features_left_labels(feats_full(spark, sf), lbl))
