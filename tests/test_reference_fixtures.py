"""Expected values taken from the reference's own tests (see FIXTURES.md)."""

import pytest
from pyspark.sql import functions as F

from clickweave.operators import clusters, metrics, online
from clickweave.operators.clean import prepare_clickstream
from clickweave.operators.features import build_session_features

RAW_SCHEMA = ("year INT, month INT, day INT, `order` INT, country INT, `session ID` BIGINT, "
              "`page 1 (main category)` INT, `page 2 (clothing model)` STRING, colour INT, location INT, "
              "`model photography` INT, price DOUBLE, `price 2` INT, page INT")


@pytest.fixture
def raw_session(spark):
    models = ["A13", "A16", "B4", "B17", "C1"]
    cats = [1, 1, 2, 2, 3]
    colours = [1, 1, 10, 6, 14]
    prices = [28.0, 33.0, 52.0, 38.0, 65.0]
    p2 = [2, 2, 1, 2, 1]
    pages = [1, 1, 1, 2, 2]
    rows = [(2008, 4, 1, i + 1, 29, 1001, cats[i], models[i], colours[i], 1, 1, prices[i], p2[i], pages[i])
            for i in range(5)]
    return spark.createDataFrame(rows, RAW_SCHEMA)


@pytest.fixture
def stored_freqs(spark):
    rows = ([("model_freq", m, f) for m, f in (("A13", .2), ("A16", .1), ("B4", .3), ("B17", .15), ("C1", .25))]
            + [("category_freq", c, f) for c, f in (("trousers", .5), ("skirts", .3), ("blouses", .2))]
            + [("colour_freq", c, .2) for c in ("1", "10", "6", "14")])
    return spark.createDataFrame(rows, "dim STRING, value STRING, freq DOUBLE")


def test_stored_frequencies_replace_in_batch(raw_session, stored_freqs):
    f = build_session_features(raw_session, 5, "first_n", freqs=stored_freqs).first()
    assert f.n_clicks_observed == 5
    assert f.mean_model_frequency == pytest.approx(0.2)
    assert (f.max_model_frequency, f.min_model_frequency) == (0.3, 0.1)
    assert (f.first_model_frequency, f.last_model_frequency) == (0.2, 0.25)
    assert (f.last_category_frequency, f.last_colour_frequency) == (0.2, 0.2)


def test_fake_model_scores_high_intent_on_five_clicks(raw_session):
    f = build_session_features(raw_session, 5, "first_n")
    prob = f.select(F.least(F.col("n_clicks_observed") / 5, F.lit(1.0)).alias("probability"))
    scored = prob.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))
    from clickweave.operators.clean import round_probability

    r = round_probability(scored).first()
    assert (r.label, r.probability) == ("high-intent", 1.0)


def test_cluster_summary_shape_and_representatives(spark):
    rows = [(i, 2 if i <= 6 else 9, 10.0 if i <= 6 else 80.0, 1, 0.1 * (i % 3), 1, "t") for i in range(1, 13)]
    feats = spark.createDataFrame(rows, "session_id BIGINT, n_clicks_observed INT, price_mean DOUBLE, "
                                        "n_unique_pages INT, category_entropy DOUBLE, last_page INT, non_numeric_tag STRING")
    cols = ["n_clicks_observed", "price_mean", "category_entropy"]
    from clickweave.operators.stats import standardize

    z = standardize(feats, cols)
    cent, _ = clusters.fit_kmeans(z, cols, k=2, n_init=10)
    assigned = clusters.assign_clusters(z, cols, cent)
    assert assigned.select("session_id").distinct().count() == 12
    summary = clusters.cluster_summary(assigned.select("session_id", "cluster_id"), feats)
    extra = [c for c in summary.columns if c not in ("cluster_id", "cluster_size", "cluster_percentage")]
    assert extra and all(c.startswith("mean_") for c in extra)
    assert sum(r.cluster_size for r in summary.collect()) == 12
    from clickweave.operators.ordering import cluster_representatives

    reps = cluster_representatives(assigned, top_n=1)
    assert reps.agg(F.max("rank_within_cluster")).first()[0] == 1


def test_metric_keys(spark):
    df = spark.createDataFrame([(1, 1, 1, 0.9), (2, 0, 0, 0.2), (3, 1, 0, 0.4), (4, 0, 1, 0.6)],
                               "session_id BIGINT, label INT, prediction INT, probability DOUBLE")
    m = metrics.classification_metrics(df).first().asDict()
    assert set(m) == {"accuracy", "precision", "recall", "f1", "macro_f1", "cohens_kappa"}
    assert metrics.roc_auc(df).first()[0] == pytest.approx(0.75)


def test_sequences_are_cut_to_n(spark):
    rows = [(1, 1, 10, 1, "A", "skirts", "red", 1, 1), (1, 2, 20, 1, "B", "skirts", "red", 1, 1),
            (1, 3, 999, 1, "C", "skirts", "red", 1, 1), (2, 1, 5, 2, "D", "sale", "red", 1, 1)]
    clicks = prepare_clickstream(spark.createDataFrame(
        rows, "`session ID` BIGINT, `order` INT, price INT, `price 2` INT, `page 2 (clothing model)` STRING, "
              "main_category STRING, colour STRING, page INT, location INT"))
    labels = spark.createDataFrame([(1, 1), (2, 0)], "session_id BIGINT, label INT")
    seq = {r.session_id: r for r in online.session_sequences(clicks, labels, 2, ["price"]).collect()}
    assert [s.x[0] for s in seq[1].steps] == [10.0, 20.0]
    assert len(seq[2].steps) == 1
