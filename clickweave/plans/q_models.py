"""Registered queries: evaluation (M), explanation (N), training (L).

The score stand-in is a fixed-weight logistic function of three first-5
features, rounded to 4 digits; labels are the manual stand-in (order status
F -> 1, O -> 0). Fitted-model queries have no SQL oracle (rows-only check).
"""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from clickweave.operators import bagging, explain, grid, metrics, stacking, training
from clickweave.operators.features import build_session_features
from clickweave.operators.many_logistic import LogisticRows, Model, areas
from clickweave.plans import sql_features as S
from clickweave.plans.registry import CLICKS_CTE, MANUAL_LABELS_CTE, register
from clickweave.session import shared_table, spread
from clickweave.sources.tables import manual_labels, raw_clicks

WEIGHTS = {"n_clicks_observed": 0.25, "high_price_share_first_n": 1.5, "category_switch_rate": -0.5}
INTERCEPT = -1.0
MODEL_FEATURES = ["n_clicks_observed", "n_unique_pages", "n_unique_models", "price_mean", "price_std",
                  "high_price_share_first_n", "category_entropy", "top_category_share", "mean_model_frequency",
                  "category_switch_rate", "mean_price_diff", "exploration_velocity_models"]


def _r(c, d=6):
    return F.round(F.col(c), d).alias(c)


def labelled_features(spark, sf):
    f = build_session_features(raw_clicks(spark, sf, first_n=5), 5, "first_n")
    return f.join(manual_labels(spark, sf).select("session_id", "label"), "session_id")


def scored(spark, sf):
    f = labelled_features(spark, sf)
    logit = F.lit(INTERCEPT)
    for c, w in WEIGHTS.items():
        logit = logit + F.lit(w) * F.col(c)
    prob = F.round(1.0 / (1.0 + F.exp(-logit)), 4)
    return f.select("session_id", "label", prob.alias("probability")).withColumn(
        "prediction", (F.col("probability") >= 0.5).cast("int"))


LOGIT_SQL = f"{INTERCEPT}" + "".join(f" + {w} * {c}" for c, w in WEIGHTS.items())
BASE = ("WITH " + CLICKS_CTE + ",\n" + MANUAL_LABELS_CTE + S.features_cte("feat5", 5, "first_n") + f""",
lf AS (SELECT f.*, m.label FROM feat5 f JOIN manual_labels m ON f.session_id = m.session_id),
sc0 AS (SELECT session_id, label, round(1.0 / (1.0 + exp(-({LOGIT_SQL}))), 4) AS probability FROM lf),
sc AS (SELECT *, CAST(probability >= 0.5 AS INTEGER) AS prediction FROM sc0),
cnt AS (SELECT count_if(label = 0 AND prediction = 0) AS tn, count_if(label = 0 AND prediction = 1) AS fp,
               count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 1 AND prediction = 1) AS tp FROM sc)""")


def div(a, b):
    return f"(CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / ({b}) END)"


def metrics_sql(src="cnt", key=None):
    tn, fp, fn, tp = "CAST(tn AS DOUBLE)", "CAST(fp AS DOUBLE)", "CAST(fn AS DOUBLE)", "CAST(tp AS DOUBLE)"
    p1, r1 = div(tp, f"{tp} + {fp}"), div(tp, f"{tp} + {fn}")
    p0, r0 = div(tn, f"{tn} + {fn}"), div(tn, f"{tn} + {fp}")
    f1, f0 = div(f"2 * {p1} * {r1}", f"{p1} + {r1}"), div(f"2 * {p0} * {r0}", f"{p0} + {r0}")
    n = f"({tn} + {fp} + {fn} + {tp})"
    po = div(f"{tp} + {tn}", n)
    pe = div(f"({tp} + {fp}) * ({tp} + {fn}) + ({tn} + {fn}) * ({tn} + {fp})", f"{n} * {n}")
    k = f"{key}, " if key else ""
    return (f"SELECT {k}round({po}, 9) AS accuracy, round({p1}, 9) AS precision, round({r1}, 9) AS recall, "
            f"round({f1}, 9) AS f1, round(({f0} + {f1}) / 2, 9) AS macro_f1, "
            f"round(CASE WHEN {pe} = 1 THEN 0.0 ELSE ({po} - {pe}) / (1 - {pe}) END, 9) AS cohens_kappa FROM {src}")


def round_metrics(df, d=9):
    return df.select(*[F.round(c, d).alias(c) if c in metrics.METRIC_NAMES else F.col(c) for c in df.columns])


@register("threshold_predictions", "M-12", BASE + "\nSELECT session_id, label, probability, prediction FROM sc")
def q_threshold_predictions(spark, sf):
    return metrics.threshold_predictions(scored(spark, sf).drop("prediction"))


@register("round_probability", "B-14", BASE + """
SELECT session_id, label, probability, prediction,
       CASE prediction WHEN 0 THEN 'low-intent' WHEN 1 THEN 'high-intent' END AS label_text FROM sc""")
def q_round_probability(spark, sf):
    from clickweave.operators.clean import round_probability

    out = round_probability(scored(spark, sf).withColumnRenamed("label", "_y"))
    return out.withColumnRenamed("label", "label_text").withColumnRenamed("_y", "label")


@register("confusion_matrix", "M-01", BASE + """
, cells AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM sc GROUP BY 1, 2)
SELECT actual, predicted, n, n / sum(n) OVER (PARTITION BY actual) AS row_share FROM cells""")
def q_confusion_matrix(spark, sf):
    return metrics.confusion_matrix(scored(spark, sf))


@register("classification_metrics", "M-02", BASE + "\n" + metrics_sql())
def q_classification_metrics(spark, sf):
    return round_metrics(metrics.classification_metrics(scored(spark, sf)))


@register("roc_auc", "M-03", BASE + """
, sc2 AS (SELECT probability AS score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM sc GROUP BY 1),
u AS (SELECT pos * (coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             + neg * 0.5) AS u, pos, neg FROM sc2)
SELECT round(sum(u) / (sum(pos) * sum(neg)), 9) AS roc_auc FROM u""")
def q_roc_auc(spark, sf):
    return metrics.roc_auc(scored(spark, sf)).select(_r("roc_auc", 9))


CURVE = """
, sc2 AS (SELECT probability AS score, count_if(label = 1) AS pos, count_if(label = 0) AS neg FROM sc GROUP BY 1),
cb AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
              sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
              sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM sc2)"""


@register("roc_curve", "M-04", BASE + CURVE + "\nSELECT score AS threshold, fp / N AS fpr, tp / P AS tpr FROM cb")
def q_roc_curve(spark, sf):
    return metrics.roc_curve(scored(spark, sf))


@register("pr_curve", "M-05", BASE + CURVE + """
, pc AS (SELECT score AS threshold, tp / (tp + fp) AS precision, tp / P AS recall FROM cb),
seg AS (SELECT (recall - coalesce(lag(recall) OVER (ORDER BY recall, precision DESC), 0.0))
             * (precision + coalesce(lag(precision) OVER (ORDER BY recall, precision DESC), 1.0)) / 2 AS a FROM pc)
SELECT round(sum(a), 9) AS pr_auc, round((SELECT avg(label) FROM sc), 9) AS baseline FROM seg""")
def q_pr_curve(spark, sf):
    s = scored(spark, sf)
    return metrics.pr_auc(metrics.pr_curve(s), s).select(_r("pr_auc", 9), _r("baseline", 9))


EDGE_SQL = " + ".join(f"CAST(probability > {e!r} AS INTEGER)" for e in metrics.CALIBRATION_EDGES)


@register("calibration_curve", "M-06", BASE + f"""
SELECT {EDGE_SQL} AS bin, round(avg(probability), 9) AS mean_predicted, round(avg(label), 9) AS fraction_positive,
       count(*) AS n FROM sc GROUP BY 1""")
def q_calibration_curve(spark, sf):
    c = metrics.calibration_curve(scored(spark, sf))
    return c.select("bin", _r("mean_predicted", 9), _r("fraction_positive", 9), "n")


@register("class_report", "M-07", BASE + f"""
SELECT 1 AS class, {div('tp', 'tp + fp')} AS precision, {div('tp', 'tp + fn')} AS recall,
       {div(f"2 * {div('tp', 'tp + fp')} * {div('tp', 'tp + fn')}", f"{div('tp', 'tp + fp')} + {div('tp', 'tp + fn')}")} AS f1,
       CAST(tp + fn AS BIGINT) AS support FROM cnt
UNION ALL
SELECT 0, {div('tn', 'tn + fn')}, {div('tn', 'tn + fp')},
       {div(f"2 * {div('tn', 'tn + fn')} * {div('tn', 'tn + fp')}", f"{div('tn', 'tn + fn')} + {div('tn', 'tn + fp')}")},
       CAST(tn + fp AS BIGINT) FROM cnt""")
def q_class_report(spark, sf):
    return metrics.class_report(scored(spark, sf))




def _rank_sql(salt):
    """0-based rank inside a label in the order of md5(id, salt)."""
    return f"row_number() OVER (PARTITION BY label ORDER BY md5(CAST(session_id AS VARCHAR) || '{salt}'), session_id) - 1"


IS_TEST = f"{_rank_sql(42)} < ceil(round(0.2 * count(*) OVER (PARTITION BY label), 9))"


@register("train_test_gap", "M-08", BASE + f"""
, sp AS (SELECT *, {IS_TEST} AS is_test FROM sc),
c2 AS (SELECT is_test, count_if(label = 0 AND prediction = 0) AS tn, count_if(label = 0 AND prediction = 1) AS fp,
              count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 1 AND prediction = 1) AS tp
       FROM sp GROUP BY is_test),
m AS ({metrics_sql('c2', 'is_test')}),
l AS (UNPIVOT m ON accuracy, precision, recall, f1, macro_f1, cohens_kappa INTO NAME metric VALUE value)
SELECT a.metric, a.value AS train, b.value AS test, round(a.value - b.value, 9) AS gap
FROM l a JOIN l b ON a.metric = b.metric AND NOT a.is_test AND b.is_test""")
def q_train_test_gap(spark, sf):
    s = training.stratified_split(shared_table(scored(spark, sf), "scored"))
    g = metrics.train_test_gap(s.where("is_test = 0"), s.where("is_test = 1"))
    g = g.select("metric", _r("train", 9), _r("test", 9))
    return g.withColumn("gap", F.round(F.col("train") - F.col("test"), 9))


FOLDS = f"CAST(({_rank_sql('42:folds')}) % 5 AS INTEGER)"


@register("cv_summary", "M-09", BASE + f"""
, fs AS (SELECT *, {FOLDS} AS fold FROM sc),
c2 AS (SELECT fold, count_if(label = 0 AND prediction = 0) AS tn, count_if(label = 0 AND prediction = 1) AS fp,
              count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 1 AND prediction = 1) AS tp
       FROM fs GROUP BY fold),
m AS ({metrics_sql('c2', 'fold')}),
l AS (UNPIVOT m ON accuracy, precision, recall, f1, macro_f1, cohens_kappa INTO NAME metric VALUE value)
SELECT metric, round(avg(value), 6) AS cv_mean, round(stddev_pop(value), 6) AS cv_std FROM l GROUP BY metric""")
def q_cv_summary(spark, sf):
    f = training.stratified_folds(scored(spark, sf), 5)
    return metrics.cv_summary(metrics.metrics_per_fold(f)).select("metric", _r("cv_mean"), _r("cv_std"))


@register("linear_shap", "N-03", BASE + """
, mu AS (SELECT """ + ", ".join(f"avg({c}) AS {c}" for c in WEIGHTS) + """ FROM lf),
ma AS (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(abs({w} * (lf.{c} - mu.{c}))) AS mean_abs_shap FROM lf CROSS JOIN mu"
    for c, w in WEIGHTS.items()) + """))
SELECT feature, round(mean_abs_shap, 6) AS mean_abs_shap, round(mean_abs_shap / sum(mean_abs_shap) OVER (), 6)
  AS importance FROM ma""")
def q_linear_shap(spark, sf):
    s = explain.linear_shap(labelled_features(spark, sf), WEIGHTS)
    return s.select("feature", _r("mean_abs_shap"), _r("importance"))


@register("linear_shap_values", "N-04", BASE + """
, mu AS (SELECT """ + ", ".join(f"avg({c}) AS {c}" for c in WEIGHTS) + """ FROM lf)
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT lf.session_id, '{c}' AS feature, round({w} * (lf.{c} - mu.{c}), 6) AS shap, "
    f"CAST(lf.{c} AS DOUBLE) AS value FROM lf CROSS JOIN mu" for c, w in WEIGHTS.items()) + ")")
def q_linear_shap_values(spark, sf):
    v = explain.linear_shap_values(labelled_features(spark, sf), WEIGHTS, top=10)
    return v.select("session_id", "feature", _r("shap"), "value")


@register("training_set", "L-01", BASE + "\nSELECT session_id, CAST(label AS INTEGER) AS label, "
          + ", ".join(f"round({c}, 6) AS {c}" if c == "category_entropy" else c for c in MODEL_FEATURES) + " FROM lf")
def q_training_set(spark, sf):
    lf = labelled_features(spark, sf)
    df, _ = training.training_set(lf.select("session_id", *MODEL_FEATURES), lf.select("session_id", "label"))
    return df.withColumn("category_entropy", F.round("category_entropy", 6))


@register("stratified_split", "L-02", BASE + f"""
SELECT session_id, label, CAST({IS_TEST} AS INTEGER) AS is_test FROM sc""")
def q_stratified_split(spark, sf):
    return training.stratified_split(shared_table(scored(spark, sf).select("session_id", "label"), "labels"))


@register("stratified_folds", "L-03", BASE + f"\nSELECT session_id, label, {FOLDS} AS fold FROM sc")
def q_stratified_folds(spark, sf):
    return training.stratified_folds(scored(spark, sf).select("session_id", "label"), 5)


@register("class_weights", "L-04", BASE + """
, pc AS (SELECT label, count(*) AS n FROM sc GROUP BY label)
SELECT s.session_id, s.label, (SELECT count(*) FROM sc) / ((SELECT count(*) FROM pc) * pc.n) AS weight
FROM sc s JOIN pc ON s.label = pc.label""")
def q_class_weights(spark, sf):
    return training.class_weights(scored(spark, sf).select("session_id", "label"))


# ---- fitted models: rows-only checks ------------------------------------------

def _labelled_table(spark, sf):
    """Labelled model features, written once: splits, folds and fits read them many times."""
    lf = labelled_features(spark, sf)
    return shared_table(lf.select("session_id", F.col("label").cast("int").alias("label"), *MODEL_FEATURES), "labelled")


def _split_train_test(spark, sf):
    lf = _labelled_table(spark, sf)
    df, cols = training.training_set(lf.drop("label"), lf.select("session_id", "label"))
    # iterative fits read the training set many times: keep it cached
    df = training.right_size(training.class_weights(training.stratified_split(df))).cache()
    return df.where("is_test = 0"), df.where("is_test = 1"), cols


def _logistic(train, cols, **kw):
    return training.model_logistic(cols, n=train.count(), **kw)


def _eval(scored_df):
    m = metrics.classification_metrics(scored_df)
    auc = metrics.roc_auc(scored_df)
    return m.select("*", auc.scalar().alias("roc_auc"))


def _fitted(builder):
    def q(spark, sf):
        train, test, cols = _split_train_test(spark, sf)
        _, out = training.fit_score(builder(cols), train, test)
        return out
    return q


@register("model_logistic", "L-05")
def q_model_logistic(spark, sf):
    train, test, cols = _split_train_test(spark, sf)
    _, out = training.fit_score(_logistic(train, cols, scaled=True), train, test)
    return out


register("model_random_forest", "L-06")(_fitted(lambda cols: training.model_random_forest(cols)))
register("model_gbt_a", "L-08")(_fitted(lambda cols: training.model_gbt_a(cols)))
register("model_gbt_b", "L-09")(_fitted(lambda cols: training.model_gbt_b(cols)))
register("model_decision_tree", "L-11")(_fitted(lambda cols: training.model_decision_tree(cols)))


@register("model_bagging", "L-10")
def q_model_bagging(spark, sf):
    train, test, cols = _split_train_test(spark, sf)
    return bagging.model_bagging(train, test, cols, bagging.FAMILIES[1])


def _stack(spark, sf):
    train, test, cols = _split_train_test(spark, sf)
    return stacking.fit_stack(train, cols, k=5), train, test


@register("model_stacking", "L-12")
def q_model_stacking(spark, sf):
    stack, _, test = _stack(spark, sf)
    return training.score_rows(stack.model, test)


@register("tune_grid", "L-13")
def q_tune_grid(spark, sf):
    """Every strength and penalty of the logistic grid, and tree depths, on 5 folds: scores of test and train folds, ranks."""
    train, _, cols = _split_train_test(spark, sf)
    frame = grid.fold_frame(train, cols, 5, 42)
    lines = grid.search_logistic(frame, cols, stacking.logistic_grid(), 5).table(spark)
    trees = grid.search_trees(frame, cols, [{"maxDepth": d, "minInstancesPerNode": leaf} for d in (8, 10, 12, 30) for leaf in (2, 4, 6)], 5).table(spark)
    frame.unpersist()
    return lines.select(F.lit("logistic_regression").alias("model"), "*").unionByName(trees.select(F.lit("decision_tree").alias("model"), "*"))


@register("tune_meta", "L-14")
def q_tune_meta(spark, sf):
    """The meta model's strengths on the stack's out-of-fold scores."""
    return _stack(spark, sf)[0].meta.table(spark)


def _knn_fitter(cols):
    from clickweave.operators.knn import knn_classify

    def fit(train, test):
        known = train.select("session_id", "label", *cols)
        return [knn_classify(known, rows.select("session_id", "label", *cols), cols, k=15, weights="distance") for rows in (test, train)]
    return fit


def baseline_fitters(cols):
    """The five baseline models of L-15."""
    fitter = training.pipeline_fitter
    return {"gbt_a": fitter(lambda train: training.model_gbt_a(cols)), "gbt_b": fitter(lambda train: training.model_gbt_b(cols)),
            "random_forest": fitter(lambda train: training.model_random_forest(cols)), "knn": _knn_fitter(cols),
            "logistic_regression": fitter(lambda train: _logistic(train, cols, scaled=False))}


@register("compare_models", "L-15")
def q_compare_models(spark, sf):
    train, test, cols = _split_train_test(spark, sf)
    return training.compare_models(baseline_fitters(cols), train, test, _eval)


@register("compare_bagging", "L-16")
def q_compare_bagging(spark, sf):
    train, test, cols = _split_train_test(spark, sf)
    return bagging.compare_bagging(train, test, cols, _eval)


@register("tree_importance", "N-01")
def q_tree_importance(spark, sf):
    train, _, cols = _split_train_test(spark, sf)
    model = training.model_random_forest(cols, 50, 8).fit(train)
    return explain.tree_importance(model, cols)


@register("coefficient_importance", "N-02")
def q_coefficient_importance(spark, sf):
    train, _, cols = _split_train_test(spark, sf)
    model = _logistic(train, cols, scaled=True).fit(train)
    return explain.coefficient_importance(explain.model_coefficients(model, cols), spark)


@register("permutation_importance", "N-05")
def q_permutation_importance(spark, sf):
    train, test, cols = _split_train_test(spark, sf)
    model = _logistic(train, cols, scaled=True).fit(train)
    return explain.permutation_importance(model, test, cols, explain.RocArea(), n_repeats=5)


@register("learning_curve", "M-10")
def q_learning_curve(spark, sf):
    train, _, cols = _split_train_test(spark, sf)
    folded = training.stratified_folds(train, 5).withColumn("part", training.unit_hash("session_id", 7))
    fractions, rows = [i / 10 for i in range(1, 11)], []
    models = [Model(fold=f, below=frac) for frac in fractions for f in range(5)]
    with LogisticRows(folded, cols, weighted=True) as data:  # all fractions and folds learn in the same passes
        found = {r["model"]: r["roc_auc"] for r in data.areas(models, data.fit(models), sides=(1,)).collect()}
    for i, frac in enumerate(fractions):
        scores = [found[5 * i + f] for f in range(5)]
        m = sum(scores) / len(scores)
        rows.append((frac, m, math.sqrt(sum((s - m) ** 2 for s in scores) / len(scores))))
    return spark.createDataFrame(rows, "train_fraction DOUBLE, mean_roc_auc DOUBLE, std_roc_auc DOUBLE")


@register("validation_curve", "M-11")
def q_validation_curve(spark, sf):
    """Train and test areas over 5 folds for each step limit, and for each inverse strength of the penalty."""
    train, _, cols = _split_train_test(spark, sf)
    frame = grid.fold_frame(train, cols, 5, 42)
    limits = [{"max_iter": i} for i in (50, 100, 200, 300, 500, 1000, 2000)]
    strengths = [{"c": c} for c in (0.001, 0.01, 0.1, 1.0, 10.0, 100.0)]
    found = grid.search_logistic(frame, cols, limits + strengths, 5)
    frame.unpersist()
    return found.table(spark).drop("rank_test_roc_auc")


def _knn_sql(k):
    z = ", ".join(f"round((round({c}, 6) - m.m{i}) / (CASE WHEN m.s{i} = 0 THEN 1 ELSE m.s{i} END), 9) AS c{i}" for i, c in enumerate(MODEL_FEATURES))
    moments = ", ".join(f"avg(round({c}, 6)) AS m{i}, stddev_pop(round({c}, 6)) AS s{i}" for i, c in enumerate(MODEL_FEATURES))
    gap = " + ".join(f"(t.c{i} - r.c{i}) * (t.c{i} - r.c{i})" for i in range(len(MODEL_FEATURES)))
    return BASE + f"""
, kf AS (SELECT *, {IS_TEST} AS is_test FROM lf),
mo AS (SELECT {moments} FROM kf WHERE NOT is_test),
kz AS (SELECT kf.session_id, kf.label, kf.is_test, {z} FROM kf, mo AS m),
near AS (SELECT t.session_id, t.label, r.label AS other, sqrt({gap}) AS d,
                row_number() OVER (PARTITION BY t.session_id ORDER BY sqrt({gap}), r.session_id) AS rk
         FROM kz t JOIN kz r ON t.is_test AND NOT r.is_test),
w AS (SELECT session_id, label, other, CASE WHEN min(d) OVER (PARTITION BY session_id) = 0 THEN CAST(d = 0 AS DOUBLE) ELSE 1 / d END AS w
      FROM near WHERE rk <= {k})
SELECT session_id, label, round(sum(w * other) / sum(w), 9) AS probability, CAST(round(sum(w * other) / sum(w), 9) > 0.5 AS INTEGER) AS prediction
FROM w GROUP BY session_id, label"""


@register("model_knn", "L-07", _knn_sql(15))
def q_model_knn(spark, sf):
    from clickweave.operators.knn import knn_classify

    train, test, cols = _split_train_test(spark, sf)
    plain = [F.round(F.col(c).cast("double"), 6).alias(c) for c in cols]
    out = knn_classify(train.select("session_id", "label", *plain), test.select("session_id", "label", *plain), cols, k=15, weights="distance")
    return out.select("session_id", "label", _r("probability", 9)).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))


# ---- model choice over fixed scorers: the same operators with an SQL oracle ----

SCORERS = {"all_three": WEIGHTS, "clicks": {"n_clicks_observed": 0.25}, "prices": {"high_price_share_first_n": 1.5}, "switches": {"category_switch_rate": -0.5}}


def _scorer_sql(weights):
    return "round(1.0 / (1.0 + exp(-(" + f"{INTERCEPT}" + "".join(f" + {w} * {c}" for c, w in weights.items()) + "))), 4)"


# area under the curve from average ranks, per group
def _area_sql(source, *keys):
    by = ", ".join(keys)
    return (f"SELECT {by}, (sum(CASE WHEN label = 1 THEN rk END) - count_if(label = 1) * (count_if(label = 1) + 1) / 2.0) "
            f"/ (count_if(label = 1) * count_if(label = 0)) AS roc_auc FROM (SELECT *, rank() OVER (PARTITION BY {by} ORDER BY score) "
            f"+ (count(*) OVER (PARTITION BY {by}, score) - 1) / 2.0 AS rk FROM {source}) GROUP BY {by}")


@register("rank_scorers", "E-07", BASE + """
, sm AS (""" + " UNION ALL ".join(f"SELECT '{m}' AS model, label, {_scorer_sql(w)} AS score FROM lf" for m, w in SCORERS.items()) + f"""),
au AS ({_area_sql('sm', 'model')})
SELECT model, round(roc_auc, 9) AS test_roc_auc FROM au ORDER BY test_roc_auc DESC, model LIMIT 1""")
def q_rank_scorers(spark, sf):
    """The best of several fixed-weight scorers by ROC AUC."""
    from clickweave.operators import ordering

    names = list(SCORERS)
    lf = labelled_features(spark, sf)
    told = [F.round(1.0 / (1.0 + F.exp(-sum((F.lit(w) * F.col(c) for c, w in SCORERS[m].items()), F.lit(INTERCEPT)))), 4) for m in names]
    scores = lf.select("label", F.posexplode(F.array(*told)).alias("model", "score")).withColumn("side", F.lit(1))
    found = areas(scores).select(F.element_at(F.array(*map(F.lit, names)), F.col("model") + 1).alias("model"), _r_as("roc_auc", "test_roc_auc"))
    return ordering.best_model(found)


def _r_as(column, name, d=9):
    return F.round(F.col(column), d).alias(name)


@register("best_n_scorer", "E-08", "WITH " + CLICKS_CTE + ",\n" + MANUAL_LABELS_CTE + f"""
, nb AS (SELECT session_id, higher_than_average, row_number() OVER (PARTITION BY session_id ORDER BY "order") AS rn FROM clicks),
ns AS (SELECT CAST(n AS INTEGER) AS n_clicks FROM range(2, 11) r(n)),
se AS (SELECT n_clicks, session_id, round(avg(higher_than_average), 9) AS score FROM nb JOIN ns ON rn <= n_clicks GROUP BY 1, 2),
fo AS (SELECT session_id, label, {FOLDS} AS fold FROM manual_labels WHERE session_id IN (SELECT session_id FROM clicks)),
sm AS (SELECT se.n_clicks, fo.fold, fo.label, se.score FROM se JOIN fo ON se.session_id = fo.session_id),
au AS ({_area_sql('sm', 'n_clicks', 'fold')}),
cv AS (SELECT n_clicks, round(avg(roc_auc), 9) AS a FROM au GROUP BY 1)
SELECT n_clicks AS best_n_clicks, a AS best_cv_mean_test_roc_auc FROM cv ORDER BY a DESC, n_clicks LIMIT 1""")
def q_best_n_scorer(spark, sf):
    """N in 2 .. 10 whose share of dear clicks ranks sessions best, by the mean area over 5 folds."""
    from clickweave.operators import ordering
    from clickweave.operators.clean import prepare_clickstream
    from clickweave.operators.sequences import _folds

    clicks = shared_table(prepare_clickstream(raw_clicks(spark, sf, first_n=10)), "first-clicks")
    folds = _folds(clicks, manual_labels(spark, sf), 5, 42)
    numbered = spread(clicks, "session_id").select("session_id", "higher_than_average", F.row_number().over(
        Window.partitionBy("session_id").orderBy("order")).alias("rn")).withColumn("n_clicks", F.explode(F.sequence(F.greatest("rn", F.lit(2)), F.lit(10))))
    per = numbered.groupBy("n_clicks", "session_id").agg(F.round(F.avg("higher_than_average"), 9).alias("score"))
    found = areas(per.join(folds, "session_id").select(F.col("n_clicks").cast("int").alias("model"), F.col("fold").alias("side"), "label", "score"))
    cv = found.groupBy(F.col("model").alias("n_clicks")).agg(F.round(F.avg("roc_auc"), 9).alias("cv_mean_test_roc_auc"))
    return ordering.best_n_clicks(cv, "cv_mean_test_roc_auc")


@register("correlation_importance", "N-02", BASE + """
, cw AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(coalesce(corr(round({c}, 6), label), 0), 6) AS coefficient FROM lf" for c in MODEL_FEATURES) + """)
SELECT feature, coefficient, round(abs(coefficient) / (SELECT sum(abs(coefficient)) FROM cw), 6) AS importance FROM cw""")
def q_correlation_importance(spark, sf):
    """Coefficient importances of the linear scorer that weighs each feature by its correlation with the label."""
    lf = labelled_features(spark, sf)
    row = lf.agg(*[F.round(F.coalesce(F.corr(F.round(F.col(c).cast("double"), 6), F.col("label").cast("double")), F.lit(0.0)), 6).alias(c)
                   for c in MODEL_FEATURES]).first()
    out = explain.coefficient_importance(row.asDict(), spark)
    return out.select("feature", "coefficient", _r("importance"))
