"""Queries that read session features several times build them once, in tasks of bounded size."""

import pytest
from pyspark.sql import functions as F

from clickweave import session
from clickweave.operators import features
from clickweave.plans import q_clusters
from clickweave.plans.catalog import REGISTRY
from clickweave.session import shared_table, spread


@pytest.fixture
def built(spark, tmp_path, monkeypatch):
    """A folder of own tables, and how often session features were built of them."""
    part = spark.range(40).select(F.col("id").alias("p_partkey"), F.concat(F.lit("Brand#"), F.col("id") % 30 + 11).alias("p_brand"),
                                  F.when(F.col("id") % 2 == 0, "ECONOMY").otherwise("STANDARD").alias("p_type"), (F.col("id") % 50 + 1).cast("int").alias("p_size"))
    orders = spark.range(300).select(F.col("id").alias("o_orderkey"), (F.col("id") % 7).alias("o_custkey"), F.date_add(F.lit("1995-01-01").cast("date"), F.col("id").cast("int")).alias("o_orderdate"))
    customer = spark.range(7).select(F.col("id").alias("c_custkey"), F.col("id").cast("int").alias("c_nationkey"))
    lines = spark.range(2000).select((F.col("id") * 7 % 300).alias("l_orderkey"), (F.col("id") * 11 % 40).alias("l_partkey"), (F.col("id") % 9).alias("l_suppkey"),
                                     F.col("id").cast("int").alias("l_linenumber"), (F.col("id") * 37 % 90 * 1000.0).alias("l_extendedprice"))
    for name, df in (("part", part), ("orders", orders), ("customer", customer), ("lineitem", lines)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    calls, clicks = [], q_clusters.raw_clicks
    monkeypatch.setattr(q_clusters, "raw_clicks", lambda *a, **k: calls.append(1) or clicks(*a, **k))
    monkeypatch.setattr("clickweave.plans.standins.raw_clicks", lambda *a, **k: calls.append(1) or clicks(*a, **k))
    return str(tmp_path), calls


@pytest.mark.parametrize("key", ["silhouette", "write_cluster_outputs"])
def test_clicks_are_built_once(spark, built, key):
    sf, calls = built
    assert REGISTRY[key].build(spark, sf).count() and len(calls) == 1


def test_features_are_written_before_they_are_read_again(spark, built):
    sf, _ = built
    plan = q_clusters.scaled(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_statistics_read_written_features(spark, built, monkeypatch):
    sf, _ = built
    seen = []
    for name in ("correlation_matrix", "standardize"):
        monkeypatch.setattr(q_clusters.stats, name, lambda df, cols, name=name, real=getattr(q_clusters.stats, name): (seen.append((name, plan(df))), real(df, cols))[1])
    for key in ("correlation_matrix", "high_corr_pairs", "standardize"):
        assert REGISTRY[key].build(spark, sf).count()
    assert [name for name, _ in seen] == ["correlation_matrix", "correlation_matrix", "standardize"]
    assert not any(step in text for _, text in seen for step in ("Join", "Aggregate", "Window"))


def test_a_large_table_is_spread_over_more_tasks(spark, monkeypatch):
    table = shared_table(spark.range(5000).select((F.col("id") % 900).alias("session_id"), "id"), "rows")
    assert spread(table, "session_id") is table
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    wide = spread(table, "session_id")
    assert wide.rdd.getNumPartitions() == 50 and wide.select(F.spark_partition_id().alias("p"), "session_id").distinct().count() == 900
    clicks = spark.range(900).select((F.col("id") % 200).alias("session_id"), F.col("id").cast("int").alias("order"), F.lit(2.0).alias("price"), (F.col("id") % 2).cast("int").alias("higher_than_average"),
                                     F.col("id").cast("int").alias("page"), F.lit("a").alias("page_2_model"), F.lit("sale").alias("main_category"), F.lit(1).alias("colour"))
    many = sorted(map(str, features.build_session_features(clicks, 3).collect()))
    monkeypatch.setattr(session, "TASK_ROWS", 1 << 20)
    assert many == sorted(map(str, features.build_session_features(clicks, 3).collect()))
