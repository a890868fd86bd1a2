"""Evaluation tables (M-01 .. M-12) over a scored DataFrame
``(session_id, label, prediction, probability)``.

Counting metrics are one aggregation. Rank metrics (ROC AUC, ROC and PR
curves) aggregate to one row per distinct score first; running sums over
that table are distributed prefix sums (score ranges with fixed bounds, a
running sum inside each, plus the totals of all ranges before it), so no
window ever holds the whole table in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.session import shared_table

METRIC_NAMES = ["accuracy", "precision", "recall", "f1", "macro_f1", "cohens_kappa"]
# Inner edges of 10 equal-width bins on [0, 1] as a float grid produces them
# (0.1 * i), so scores equal to an edge fall in the lower bin.
CALIBRATION_EDGES = [0.1 * i for i in range(1, 10)]


def _div(a: Column, b: Column) -> Column:
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


# M-12
def threshold_predictions(df: DataFrame, prob: str = "probability", threshold: float = 0.5) -> DataFrame:
    return df.withColumn("prediction", (F.col(prob) >= threshold).cast("int"))


# M-01
def confusion_counts(df: DataFrame) -> DataFrame:
    y, p = F.col("label"), F.col("prediction")
    return df.agg(F.count_if((y == 0) & (p == 0)).alias("tn"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                  F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 1) & (p == 1)).alias("tp"))


def confusion_matrix(df: DataFrame) -> DataFrame:
    """Long form (actual, predicted, n, row_share)."""
    cells = df.groupBy(F.col("label").alias("actual"), F.col("prediction").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("actual"))  # a few cells per class
    return cells.select("actual", "predicted", "n", (F.col("n") / total).alias("row_share"))


def metrics_of_counts(c: DataFrame, *keys: str) -> DataFrame:
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    prec1, rec1 = _div(tp, tp + fp), _div(tp, tp + fn)
    prec0, rec0 = _div(tn, tn + fn), _div(tn, tn + fp)
    f1_1 = _div(2 * prec1 * rec1, prec1 + rec1)
    f1_0 = _div(2 * prec0 * rec0, prec0 + rec0)
    po = _div(tp + tn, n)
    pe = _div((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp), n * n)
    kappa = F.when(pe == 1, F.lit(0.0)).otherwise((po - pe) / (1 - pe))
    return c.select(*keys, po.alias("accuracy"), prec1.alias("precision"), rec1.alias("recall"),
                    f1_1.alias("f1"), ((f1_0 + f1_1) / 2).alias("macro_f1"), kappa.alias("cohens_kappa"))


# M-02
def classification_metrics(df: DataFrame) -> DataFrame:
    return metrics_of_counts(confusion_counts(df))


def score_counts(df: DataFrame, prob: str = "probability") -> DataFrame:
    return df.groupBy(F.col(prob).alias("score")).agg(F.count_if(F.col("label") == 1).alias("pos"),
                                                     F.count_if(F.col("label") == 0).alias("neg"))


RANGE_ROWS = 100_000  # about as many rows of the per-score table in one range


def range_bounds(df: DataFrame, order_col: str, rows_per_range: int = RANGE_ROWS) -> list[float]:
    """Inner bounds of ranges of about ``rows_per_range`` rows, from the row
    count and approximate quantiles (one value per range on the driver)."""
    n = df.count()
    parts = -(-n // rows_per_range)
    if parts < 2:
        return []
    found = df.agg(F.percentile_approx(order_col, [i / parts for i in range(1, parts)], 100 * parts)).first()[0]
    return sorted(set(found))


def prefix_sums(df: DataFrame, order_col: str, cols: list[str], descending: bool = False,
                rows_per_range: int = RANGE_ROWS) -> DataFrame:
    """Inclusive running sums ``cum_<c>`` of ``cols`` in ``order_col`` order.

    The bounds of the ranges are computed once and every row is put into its
    range by comparison with them, so running sums and range totals agree on
    the ranges however the plan is executed. Each range computes its own
    running sum and adds the totals of all ranges before it, read from a table
    with one row per range."""
    key = F.col(order_col).desc() if descending else F.col(order_col).asc()
    bounds = range_bounds(df, order_col, rows_per_range)
    above = F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col(order_col)) if bounds else None
    ranged = df.withColumn("_pid", F.size(above) if bounds else F.lit(0))
    w = Window.partitionBy("_pid").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.select("*", *[F.sum(c).over(w).alias(f"_l_{c}") for c in cols])
    totals = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    pid = F.col("_pid").desc() if descending else F.col("_pid").asc()
    before = Window.orderBy(pid).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}")
                                      for c in cols])
    out = local.join(offsets, "_pid")
    return out.select(*df.columns, *[(F.col(f"_l_{c}") + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in cols])


# M-03
def roc_auc(df: DataFrame, prob: str = "probability") -> DataFrame:
    """Mann-Whitney AUC, ties counted one half."""
    sc = prefix_sums(shared_table(score_counts(df, prob), "scores"), "score", ["neg"])
    below = F.col("cum_neg") - F.col("neg")
    per = sc.select("pos", "neg", (F.col("pos") * (below + F.col("neg") * 0.5)).alias("_u"))
    return per.agg((F.sum("_u") / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def _curve_base(df: DataFrame, prob: str) -> DataFrame:
    sc = shared_table(score_counts(df, prob), "scores")
    total_pos = sc.agg(F.sum("pos")).scalar()
    total_neg = sc.agg(F.sum("neg")).scalar()
    cum = prefix_sums(sc, "score", ["pos", "neg"], descending=True)
    return cum.select("score", "pos", "neg", F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
                      total_pos.alias("P"), total_neg.alias("N"))


# M-04
def roc_curve(df: DataFrame, prob: str = "probability") -> DataFrame:
    b = _curve_base(df, prob)
    return b.select(F.col("score").alias("threshold"), (F.col("fp") / F.col("N")).alias("fpr"),
                    (F.col("tp") / F.col("P")).alias("tpr"))


# M-05
def pr_curve(df: DataFrame, prob: str = "probability") -> DataFrame:
    """(threshold, precision, recall, pos, neg, tp, fp, P) per distinct score."""
    b = _curve_base(df, prob)
    return b.select(F.col("score").alias("threshold"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
                    (F.col("tp") / F.col("P")).alias("recall"), "pos", "neg", "tp", "fp", "P")


def pr_auc(curve: DataFrame, baseline_from: DataFrame | None = None) -> DataFrame:
    """Trapezoid area under (recall, precision) from (0, 1), in threshold
    order. Each segment needs only its own row: the previous point is the
    same running counts without this score's rows."""
    tp0 = F.col("tp") - F.col("pos")
    n0 = tp0 + F.col("fp") - F.col("neg")
    prev_p = F.when(n0 == 0, F.lit(1.0)).otherwise(tp0 / n0)
    seg = curve.select((F.col("pos") / F.col("P") * (F.col("precision") + prev_p) / 2).alias("a"))
    out = seg.agg(F.sum("a").alias("pr_auc"))
    if baseline_from is not None:
        out = out.select("pr_auc", baseline_from.agg(F.avg(F.col("label").cast("double"))).scalar().alias("baseline"))
    return out


# M-06
def calibration_curve(df: DataFrame, prob: str = "probability") -> DataFrame:
    p = F.col(prob)
    bin_id = sum(((p > F.lit(e)).cast("int") for e in CALIBRATION_EDGES), F.lit(0))
    return df.groupBy(bin_id.alias("bin")).agg(F.avg(p).alias("mean_predicted"),
                                               F.avg(F.col("label").cast("double")).alias("fraction_positive"),
                                               F.count(F.lit(1)).alias("n"))


# M-07
def class_report(df: DataFrame) -> DataFrame:
    c = confusion_counts(df)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    rows = []
    for cls, (hit, pred_other, true_other) in {1: (tp, fp, fn), 0: (tn, fn, fp)}.items():
        prec, rec = _div(hit, hit + pred_other), _div(hit, hit + true_other)
        rows.append(c.select(F.lit(cls).alias("class"), prec.alias("precision"), rec.alias("recall"),
                             _div(2 * prec * rec, prec + rec).alias("f1"), (hit + true_other).alias("support")))
    return rows[0].unionByName(rows[1])


def metrics_long(m: DataFrame) -> DataFrame:
    return m.unpivot([], METRIC_NAMES, "metric", "value")


# M-08
def train_test_gap(train: DataFrame, test: DataFrame) -> DataFrame:
    a = metrics_long(classification_metrics(train)).withColumnRenamed("value", "train")
    b = metrics_long(classification_metrics(test)).withColumnRenamed("value", "test")
    return a.join(b, "metric").withColumn("gap", F.col("train") - F.col("test"))


# M-09
def cv_summary(per_fold: DataFrame, metrics: list[str] = METRIC_NAMES) -> DataFrame:
    """Mean and population std of each metric over folds."""
    long = per_fold.unpivot(["fold"], metrics, "metric", "value")
    return long.groupBy("metric").agg(F.avg("value").alias("cv_mean"), F.stddev_pop("value").alias("cv_std"))


def metrics_per_fold(scored: DataFrame, fold_col: str = "fold") -> DataFrame:
    y, p = F.col("label"), F.col("prediction")
    c = scored.groupBy(fold_col).agg(F.count_if((y == 0) & (p == 0)).alias("tn"),
                                    F.count_if((y == 0) & (p == 1)).alias("fp"),
                                    F.count_if((y == 1) & (p == 0)).alias("fn"),
                                    F.count_if((y == 1) & (p == 1)).alias("tp"))
    return metrics_of_counts(c, fold_col)
