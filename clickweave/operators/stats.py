"""Column statistics and feature pruning (I-01 .. I-16).

Statistics over sessions are single aggregations (partial aggregation before
the shuffle). Only O(p) / O(p^2) results (means, standard deviations, the
correlation matrix) ever reach the driver, never rows.
Cluster-level tables (the cluster summary) have one row per cluster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.functions.values import CLUSTER_EXCLUDED, CLUSTER_FEATURES, DEFAULT_CORRELATION_THRESHOLD

CV_PERCENTILES = {"50th percentile (median)": 0.50, "67th percentile (top third)": 0.67,
                  "75th percentile (top quartile) [CURRENT]": 0.75, "80th percentile (top quintile)": 0.80,
                  "90th percentile (top decile)": 0.90}


def _q(c: str) -> Column:
    return F.col(f"`{c}`")


def _stack(wide: DataFrame, names: list[str], cols: list[list[str]], out: list[str]) -> DataFrame:
    """Unpivot a one-row table: row i = (names[i], *cols[i])."""
    body = ", ".join(", ".join([f"'{n}'"] + [f"`{c}`" for c in cs]) for n, cs in zip(names, cols))
    return wide.selectExpr(f"stack({len(names)}, {body}) AS ({', '.join(out)})")


# I-01
def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r for every pair (a before b in ``cols``), long form
    (feature_a, feature_b, pos_a, pos_b, corr); undefined r (constant column)
    is null.

    Null-free columns: one distributed Gram-matrix pass
    (``pyspark.ml.stat.Correlation``), p x p values to the driver. With
    nulls: pairwise-complete ``corr`` aggregates, like the reference."""
    cols = list(cols)
    nulls = df.agg(*[F.count_if(_q(c).isNull() | F.isnan(_q(c).cast("double"))).alias(f"n{i}")
                     for i, c in enumerate(cols)]).first()
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    if not any(nulls):
        from pyspark.ml.feature import VectorAssembler
        from pyspark.ml.stat import Correlation

        vec = VectorAssembler(inputCols=cols, outputCol="_v").transform(
            df.select(*[_q(c).cast("double").alias(c) for c in cols]))
        m = Correlation.corr(vec, "_v").first()[0].toArray()
        rows = [(cols[i], cols[j], i, j, None if m[i, j] != m[i, j] else float(m[i, j])) for i, j in pairs]
        return df.sparkSession.createDataFrame(
            rows, "feature_a STRING, feature_b STRING, pos_a INT, pos_b INT, corr DOUBLE")
    aggs = [F.corr(_q(cols[i]).cast("double"), _q(cols[j]).cast("double")).alias(f"c_{i}_{j}") for i, j in pairs]
    wide = df.agg(*aggs)
    body = ", ".join(f"'{cols[i]}', '{cols[j]}', {i}, {j}, `c_{i}_{j}`" for i, j in pairs)
    long = wide.selectExpr(f"stack({len(pairs)}, {body}) AS (feature_a, feature_b, pos_a, pos_b, corr)")
    return long.withColumn("corr", F.when(~F.isnan("corr"), F.col("corr")))


# I-02
def high_corr_pairs(corr: DataFrame, threshold: float = DEFAULT_CORRELATION_THRESHOLD) -> DataFrame:
    return corr.where(F.abs("corr") > threshold).withColumn("abs_corr", F.abs("corr"))


# I-03
def drop_correlated(corr: DataFrame, cols: Sequence[str], threshold: float = DEFAULT_CORRELATION_THRESHOLD,
                    strict: bool = True) -> DataFrame:
    """(feature, position, dropped): a column is dropped when |r| with any
    earlier column (dropped or not) exceeds the threshold (``>=`` when not strict)."""
    cond = F.abs("corr") > threshold if strict else F.abs("corr") >= threshold
    hits = corr.where(cond).groupBy(F.col("feature_b").alias("feature")).agg(F.count(F.lit(1)).alias("_n"))
    spark = corr.sparkSession
    names = spark.createDataFrame([(c, i) for i, c in enumerate(cols)], "feature STRING, position INT")
    return names.join(hits, "feature", "left").select(
        "feature", "position", F.col("_n").isNotNull().cast("int").alias("dropped"))


def kept_features(pruned: DataFrame) -> list[str]:
    """Driver-side list of kept columns (p values)."""
    return [r.feature for r in pruned.where("dropped = 0").orderBy("position").collect()]


# I-04
def drop_low_variance(df: DataFrame, cols: Sequence[str], min_variance: float = 1e-8) -> DataFrame:
    wide = df.agg(*[F.var_samp(_q(c).cast("double")).alias(f"v_{i}") for i, c in enumerate(cols)])
    long = _stack(wide, list(cols), [[f"v_{i}"] for i in range(len(cols))], ["feature", "variance"])
    return long.withColumn("dropped", (F.col("variance") <= min_variance).cast("int"))


# I-05
def select_cluster_features(df: DataFrame, whitelist: Sequence[str] = CLUSTER_FEATURES) -> dict:
    from clickweave.operators.clean import numeric_feature_columns

    numeric = [c for c in numeric_feature_columns(df, exclude=tuple(CLUSTER_EXCLUDED))]
    selected = [c for c in whitelist if c in numeric]
    if not selected:
        raise ValueError("none of the listed cluster features is a numeric column here")
    return {"features": selected,
            "ignored_extra_numeric_features": [c for c in numeric if c not in whitelist],
            "missing_whitelisted_features": [c for c in whitelist if c not in df.columns]}


def column_moments(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population std) per column: 2p numbers to the driver."""
    row = df.agg(*[F.avg(_q(c)).alias(f"m{i}") for i, c in enumerate(cols)],
                 *[F.stddev_pop(_q(c)).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


# I-06
def standardize(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ("session_id",),
                moments: dict | None = None) -> DataFrame:
    """z-score with the population standard deviation; zero std divides by 1."""
    moments = moments or column_moments(df, cols)
    out = [F.col(k) for k in keep]
    for c in cols:
        m, s = moments[c]
        s = s if s else 1.0
        out.append(((_q(c) - F.lit(m)) / F.lit(s)).alias(c))
    return df.select(*out)


# I-07
def pca_project(scaled: DataFrame, cols: Sequence[str], n_components: int | float, keep=("session_id",)) -> DataFrame:
    """PCA on the scaled features; a float keeps the smallest number of
    components whose explained variance share reaches it."""
    from pyspark.ml.feature import PCA, VectorAssembler

    vec = VectorAssembler(inputCols=list(cols), outputCol="_x").transform(scaled)
    k = n_components if isinstance(n_components, int) else len(cols)
    model = PCA(k=k, inputCol="_x", outputCol="pca").fit(vec)
    if isinstance(n_components, float):
        total, k = 0.0, 0
        for v in model.explainedVariance.toArray():
            total += v
            k += 1
            if total >= n_components:
                break
        model = PCA(k=k, inputCol="_x", outputCol="pca").fit(vec)
    from pyspark.ml.functions import vector_to_array

    return model.transform(vec).select(*keep, vector_to_array("pca").alias("pca"))


# I-08
def feature_cv(summary: DataFrame) -> DataFrame:
    """Coefficient of variation of every ``mean_*`` column over clusters
    (sample std / mean; 0 when the mean is 0)."""
    cols = [c for c, t in summary.dtypes if c.startswith("mean_") and t in ("double", "bigint", "int", "float")]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(_q(c)).alias(f"m{i}"), F.stddev_samp(_q(c)).alias(f"s{i}")]
    wide = summary.agg(*aggs)
    long = _stack(wide, cols, [[f"s{i}", f"m{i}"] for i in range(len(cols))], ["feature", "std_dev", "mean"])
    cv = F.when(F.col("mean") != 0, F.col("std_dev") / F.col("mean")).otherwise(F.lit(0.0))
    return long.select("feature", cv.alias("coefficient_of_variation"), "std_dev", "mean")


# I-09
def select_discriminative(cv: DataFrame, percentile: float = 0.75) -> DataFrame:
    threshold = cv.agg(F.percentile("coefficient_of_variation", percentile)).scalar()
    return cv.where(F.col("coefficient_of_variation") >= threshold).withColumn("threshold_value", threshold)


# I-10
def threshold_comparison(cv: DataFrame, options: dict[str, float] = CV_PERCENTILES) -> DataFrame:
    """Cut value, number and share of features kept for each percentile option.
    The cuts are scalar subqueries over the (one row per feature) CV table."""
    x = F.col("coefficient_of_variation")
    cuts = [cv.agg(F.percentile(x, p)).scalar() for p in options.values()]
    wide = cv.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(x >= c).alias(f"k{i}") for i, c in enumerate(cuts)])
    wide = wide.select("*", *[c.alias(f"c{i}") for i, c in enumerate(cuts)],
                       *[F.lit(p).alias(f"p{i}") for i, p in enumerate(options.values())])
    long = _stack(wide, list(options), [[f"p{i}", f"c{i}", f"k{i}", "n"] for i in range(len(options))],
                  ["threshold", "percentile", "cv_value", "features_selected", "n"])
    return long.select("threshold", "percentile", "cv_value", "features_selected",
                       (F.col("features_selected") / F.col("n") * 100).alias("percentage"))


def _bins(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    expr = F.lit(None).cast("string")
    for lo, hi, lab in reversed(list(zip(edges[:-1], edges[1:], labels))):
        expr = F.when((col > lo) & (col <= hi), F.lit(lab)).otherwise(expr)
    return expr


# I-11
def bin_segments(summary: DataFrame) -> DataFrame:
    """Right-closed bins; values outside every bin get null."""
    return summary.select(
        "cluster_id", "cluster_percentage", "mean_n_clicks_observed", "mean_price_mean",
        _bins(F.col("mean_n_clicks_observed"), [0, 2, 3.5, 5], ["Low", "Medium", "High"]).alias("engagement_level"),
        _bins(F.col("mean_price_mean"), [0, 40, 50, 100], ["Budget", "Mid-Range", "Premium"]).alias("price_tier"))


# I-12
def segment_summary(binned: DataFrame) -> DataFrame:
    return (binned.where(F.col("engagement_level").isNotNull() & F.col("price_tier").isNotNull())
            .groupBy("engagement_level", "price_tier")
            .agg(F.count("cluster_id").alias("n_clusters"), F.sum("cluster_percentage").alias("total_pct_sessions"),
                 F.avg("mean_n_clicks_observed").alias("avg_clicks"), F.avg("mean_price_mean").alias("avg_price")))


# I-13
def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles (linear interpolation), max per column."""
    aggs = []
    for i, c in enumerate(cols):
        x = _q(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"), F.stddev_samp(x).alias(f"s{i}"),
                 F.min(x).alias(f"lo{i}"), F.percentile(x, 0.25).alias(f"a{i}"), F.percentile(x, 0.5).alias(f"b{i}"),
                 F.percentile(x, 0.75).alias(f"c{i}"), F.max(x).alias(f"hi{i}")]
    wide = df.agg(*aggs)
    return _stack(wide, list(cols), [[f"n{i}", f"m{i}", f"s{i}", f"lo{i}", f"a{i}", f"b{i}", f"c{i}", f"hi{i}"]
                                     for i in range(len(cols))],
                  ["column_name", "count", "mean", "std", "min", "q25", "q50", "q75", "max"])


# I-14
def positioning_medians(summary: DataFrame) -> DataFrame:
    med_x = summary.agg(F.percentile("mean_n_clicks_observed", 0.5)).scalar()
    med_y = summary.agg(F.percentile("mean_price_mean", 0.5)).scalar()
    return summary.select("cluster_id", "cluster_size", F.col("mean_n_clicks_observed").alias("x_clicks"),
                          F.col("mean_price_mean").alias("y_price"), med_x.alias("median_clicks"),
                          med_y.alias("median_price"))


ENGAGEMENT_COLUMNS = ["mean_n_clicks_observed", "mean_n_unique_pages", "mean_price_mean", "mean_category_entropy"]


# I-15
def engagement_comparison(summary: DataFrame) -> DataFrame:
    missing = [c for c in ENGAGEMENT_COLUMNS if c not in summary.columns]
    if missing:
        raise ValueError(f"Missing columns for engagement comparison: {missing}")
    return summary.select("cluster_id", *ENGAGEMENT_COLUMNS)


# I-16
def category_preferences(summary: DataFrame) -> DataFrame:
    cols = [c for c in summary.columns if c.startswith("mean_category_share_")]
    return summary.unpivot("cluster_id", cols, "category", "share").withColumn(
        "category", F.regexp_replace("category", "^mean_category_share_", ""))


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession
