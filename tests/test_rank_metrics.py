import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.operators import metrics


def _scored(spark, n):
    """n distinct scores; the label is likelier for large ones."""
    u = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1_000_003)) / 1_000_003
    return spark.range(n).select(((F.col("id") * 7919) % n / n).alias("probability"), u.alias("u")).select(
        "probability", (F.col("u") < 0.2 + 0.6 * F.col("probability")).cast("int").alias("label"))


def _auc(label, score):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    pos = label == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("n", [20_000, 1_000_000])
def test_auc_of_many_distinct_scores(spark, n):
    df = _scored(spark, n)
    table = df.toPandas()
    want = _auc(table.label.to_numpy(), table.probability.to_numpy())
    assert [abs(metrics.roc_auc(df).first()[0] - want) < 1e-12 for _ in range(2)] == [True, True]


def test_prefix_sums_over_many_ranges(spark):
    df = _scored(spark, 5_000).groupBy(F.col("probability").alias("score")).agg(F.sum("label").alias("pos"))
    table = df.toPandas().sort_values("score")
    for descending in (False, True):
        got = metrics.prefix_sums(df, "score", ["pos"], descending, rows_per_range=300).toPandas().sort_values("score")
        side = table.pos[::-1].cumsum()[::-1] if descending else table.pos.cumsum()
        assert got.cum_pos.tolist() == side.tolist()


def test_confusion_shares(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (0, 0), (0, 0), (1, 1)], "label int, prediction int")
    got = {(r.actual, r.predicted): (r.n, r.row_share) for r in metrics.confusion_matrix(df).collect()}
    assert got == {(0, 0): (3, 0.75), (0, 1): (1, 0.25), (1, 1): (1, 1.0)}
