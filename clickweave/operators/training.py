"""Training-set assembly and models (L-01 .. L-16) with ``pyspark.ml``.

Splits and folds follow the order of md5(session id, seed) inside each class,
with exact quotas, and are reproducible in SQL. No task sorts a class: the
hash space is cut into ``HASH_BUCKETS`` buckets, a histogram of them says how
many rows of the class lie before each, and rows are ranked inside a bucket
only. A split needs one cut per class, so only the bucket with the cut is
ranked and every row is then compared with the cut, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.operators.clean import numeric_feature_columns


def unit_hash(key: str = "session_id", seed: int | str = 42) -> Column:
    """Uniform [0, 1) from md5(id || seed) (first 32 bits)."""
    h = F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


# L-01
def training_set(features: DataFrame, labels: DataFrame, label: str = "label", check: bool = True) -> tuple[DataFrame, list[str]]:
    """Labelled feature rows and the numeric columns; no rows or one class only are errors."""
    joined = features.join(labels.select("session_id", label), "session_id").na.drop(subset=[label])
    if check:
        check_training_set(joined.select(F.col(label).alias("label")))
    cols = numeric_feature_columns(joined, exclude=("session_id", label, "cluster_id"))
    if not cols:
        raise ValueError("training needs at least one numeric feature column")
    return joined.select("session_id", F.col(label).cast("int").alias("label"), *cols), cols


def check_training_set(df: DataFrame) -> None:
    n_classes = df.select("label").distinct().limit(3).count()
    if n_classes == 0:
        raise ValueError("no labelled session has features")
    if n_classes < 2:
        raise ValueError("only one class is labelled")


def right_size(df: DataFrame, rows_per_partition: int = 50000) -> DataFrame:
    """Coalesce a (cached, iterated-over) training table to about
    ``rows_per_partition`` rows per partition: iterative learners run one
    job per tree level or iteration, so tiny partitions cost more in task
    overhead than they give in parallelism; large tables keep their width."""
    import math

    n = df.count()
    parts = max(1, min(df.rdd.getNumPartitions(), math.ceil(n / rows_per_partition)))
    return df.coalesce(parts)


HASH_BUCKETS = 65_536


def _hashed(df: DataFrame, salt: int | str) -> DataFrame:
    """``_h``: the md5 that orders a class (ties: the id); ``_b``: its first 4 hex digits."""
    h = F.md5(F.concat(F.col("session_id").cast("string"), F.lit(str(salt))))
    return df.withColumn("_h", h).withColumn("_b", F.substring("_h", 1, 4))


def label_rank(df: DataFrame, salt: int | str, name: str = "rank") -> DataFrame:
    """0-based rank of each row inside its label in md5 order. The window runs
    over (label, bucket); the rows before a bucket come from the histogram,
    which joins on the same keys."""
    keyed = _hashed(df, salt)
    counts = keyed.groupBy("label", "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("label").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)  # HASH_BUCKETS rows a label
    before = counts.select("label", "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("label", "_b").orderBy("_h", "session_id"))
    ranked = keyed.withColumn("_inside", inside).join(before, ["label", "_b"])
    return ranked.select(*df.columns, (F.col("_before") + F.col("_inside") - 1).alias(name))


def quota_cuts(df: DataFrame, fractions: Sequence[float], salt: int | str) -> list[dict]:
    """For each fraction, per label, the (md5, id) of the last of the first
    ceil(fraction * n) rows in md5 order; labels of a zero quota are left out."""
    import math

    keyed = _hashed(df.select("session_id", "label"), salt)
    counts: dict = {}
    for r in keyed.groupBy("label", "_b").count().collect():  # HASH_BUCKETS rows a label at most
        counts.setdefault(r["label"], []).append((r["_b"], r["count"]))
    wanted = []  # (position in fractions, label, bucket, rank inside it)
    for label, found in counts.items():
        total = sum(n for _, n in found)
        for at, fraction in enumerate(fractions):
            left = min(math.ceil(round(fraction * total, 9)), total)
            for bucket, n in sorted(found):
                if 0 < left <= n:
                    wanted.append((at, label, bucket, left))
                left -= n
    out: list[dict] = [{} for _ in fractions]
    if wanted:
        buckets = df.sparkSession.createDataFrame(sorted({(w[1], w[2]) for w in wanted}), keyed.select("label", "_b").schema)
        some = keyed.join(buckets, ["label", "_b"], "left_semi")
        inside = F.row_number().over(Window.partitionBy("label", "_b").orderBy("_h", "session_id"))
        asked = df.sparkSession.createDataFrame(wanted, "at INT, label " + dict(df.dtypes)["label"] + ", _b STRING, _r INT")
        for r in some.withColumn("_r", inside).join(asked, ["label", "_b", "_r"]).collect():  # one row a cut
            out[r["at"]][r["label"]] = (r["_h"], r["session_id"])
    return out


def _up_to(cuts: dict, salt: int | str) -> Column:
    """Whether a row stands at or before its label's cut."""
    h = F.md5(F.concat(F.col("session_id").cast("string"), F.lit(str(salt))))
    out = F.lit(False)
    for label, (digest, row) in cuts.items():
        here = (h < digest) | ((h == digest) & (F.col("session_id") <= row))
        out = F.when(F.col("label") == label, here).otherwise(out)
    return out


# L-02
def stratified_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """``is_test``: the first ceil(test_fraction * n) rows of each class in md5 order."""
    cuts, = quota_cuts(df, [test_fraction], seed)
    return df.withColumn("is_test", _up_to(cuts, seed).cast("int"))


# L-03
def stratified_folds(df: DataFrame, k: int = 5, seed: int = 42, check: bool = True) -> DataFrame:
    """``fold``: rank in md5 order modulo k, per class, so folds differ by one row of a class at most."""
    if k < 2:
        raise ValueError(f"at least 2 folds are needed, got {k}")
    if check:
        smallest = df.groupBy("label").count().agg(F.min("count")).first()[0]
        if smallest is None or smallest < k:
            raise ValueError(f"{k} folds need as many rows of every class, the smallest has {smallest}")
    # own salt: independent of the train/test split drawn with the same seed
    return label_rank(df, f"{seed}:folds", "fold").withColumn("fold", (F.col("fold") % k).cast("int"))


# L-04
def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """balanced weight n / (n_classes * n_class); the per-class table has one
    row per class (bounded), so it is broadcast."""
    total = df.agg(F.count(F.lit(1))).scalar()
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    n_classes = per.agg(F.count(F.lit(1))).scalar()
    per = per.select(label, (total / (n_classes * F.col("_n"))).alias("weight"))
    return df.join(F.broadcast(per), label)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def scaler_stage(cols: Sequence[str]):
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    return [VectorAssembler(inputCols=list(cols), outputCol="_raw", handleInvalid="keep"),
            StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True)]


# L-05 .. L-11: estimators (balanced class weights through ``weight``)
def model_logistic(cols, scaled: bool = True, c: float = 1.0, *, n: int, max_iter: int = 1000):
    """Balanced logistic model with the penalty |w|^2 / (2 c) beside the summed loss of ``n`` training rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    lr = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=max_iter,
                            regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False)
    stages = scaler_stage(cols) if scaled else [VectorAssembler(inputCols=list(cols), outputCol="features")]
    return Pipeline(stages=stages + [lr])


def _tree_pipeline(cols, est):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep"), est])


def model_random_forest(cols, n_trees: int = 100, max_depth: int = 10, seed: int = 42):
    from pyspark.ml.classification import RandomForestClassifier

    return _tree_pipeline(cols, RandomForestClassifier(labelCol="label", weightCol="weight", numTrees=n_trees,
                                                       maxDepth=max_depth, seed=seed))


def model_gbt_a(cols, n_trees: int = 250, max_depth: int = 6, lr: float = 0.05, subsample: float = 0.9,
                colsample: float = 0.9, seed: int = 42):
    from pyspark.ml.classification import GBTClassifier

    return _tree_pipeline(cols, GBTClassifier(labelCol="label", weightCol="weight", maxIter=n_trees,
                                              maxDepth=max_depth, stepSize=lr, subsamplingRate=subsample,
                                              featureSubsetStrategy=str(colsample), seed=seed))


def model_gbt_b(cols, n_trees: int = 250, lr: float = 0.05, seed: int = 42):
    """Leaf-wise growth with 31 leaves has no Spark analogue; depth 5 bounds
    a tree at 32 leaves."""
    from pyspark.ml.classification import GBTClassifier

    return _tree_pipeline(cols, GBTClassifier(labelCol="label", weightCol="weight", maxIter=n_trees, maxDepth=5,
                                              stepSize=lr, seed=seed))


def model_decision_tree(cols, max_depth: int = 10, min_leaf: int = 1, seed: int = 42):
    from pyspark.ml.classification import DecisionTreeClassifier

    return _tree_pipeline(cols, DecisionTreeClassifier(labelCol="label", weightCol="weight", maxDepth=max_depth,
                                                       minInstancesPerNode=min_leaf, seed=seed))


def tree_estimator(max_depth: int, min_leaf: int, seed: int = 42):
    """Decision tree over assembled ``features``."""
    from pyspark.ml.classification import DecisionTreeClassifier

    return DecisionTreeClassifier(labelCol="label", weightCol="weight", maxDepth=max_depth, minInstancesPerNode=min_leaf, seed=seed)


def probability_of_one(pred: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    return pred.withColumn("probability", vector_to_array("probability")[1])


def fit_score(pipeline, train: DataFrame, test: DataFrame) -> tuple[object, DataFrame]:
    model = pipeline.fit(train)
    return model, score_rows(model, test)


def score_rows(model, rows: DataFrame) -> DataFrame:
    return probability_of_one(model.transform(rows)).select(
        "session_id", "label", F.col("prediction").cast("int").alias("prediction"), "probability")


# L-15
def compare_models(fitters: dict, train: DataFrame, test: DataFrame, evaluate, parallelism: int = 8) -> DataFrame:
    """One row per model with its test and train metrics, best test ROC AUC
    first. A fitter takes (train, test) and gives the scored rows of both;
    models are fitted side by side, metric rows are single-row aggregates."""
    from clickweave.operators.grid import side_by_side

    def run(name: str) -> tuple:
        told, learned = fitters[name](train, test)
        return name, evaluate(told).first().asDict(), evaluate(learned).first().asDict()

    found = side_by_side(train.sparkSession, run, list(fitters), parallelism)
    names = list(found[0][1])
    rows = [(name, *[float(te[k]) for k in names], *[float(tr[k]) for k in names]) for name, te, tr in found]
    schema = ", ".join(["model STRING"] + [f"test_{k} DOUBLE" for k in names] + [f"train_{k} DOUBLE" for k in names])
    return train.sparkSession.createDataFrame(rows, schema).orderBy(F.col("test_roc_auc").desc())


def pipeline_fitter(make):
    """Fitter of ``compare_models`` from a function train -> pipeline."""
    def fit(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
        model = make(train).fit(train)
        return score_rows(model, test), score_rows(model, train)
    return fit
