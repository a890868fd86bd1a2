import json
import os
import tempfile

import pytest

from clickweave.operators import clean, online, stats
from clickweave.sources import files


def test_require_and_numeric_columns(spark):
    df = spark.createDataFrame([(1, 2.0, "x", 1)], "session_id BIGINT, a DOUBLE, tag STRING, label INT")
    with pytest.raises(ValueError, match="Missing required columns"):
        clean.require_columns(df, ["session_id", "order"])
    assert clean.numeric_feature_columns(df) == ["a"]


def test_select_cluster_features_reports_extra_and_missing(spark):
    df = spark.createDataFrame([(1, 3, 2.0, 5.0, "t", 1)],
                               "session_id BIGINT, n_clicks_observed INT, price_mean DOUBLE, extra DOUBLE, "
                               "non_numeric_tag STRING, purchase_flag INT")
    out = stats.select_cluster_features(df)
    assert out["features"] == ["n_clicks_observed", "price_mean"]
    assert out["ignored_extra_numeric_features"] == ["extra"]
    assert "category_entropy" in out["missing_whitelisted_features"]


def test_single_session_validation(spark):
    two = spark.createDataFrame([(1, 1), (2, 1)], "session_id BIGINT, `order` INT")
    assert any("exactly one" in r.problem for r in online.validate_single_session(two).collect())
    one = spark.createDataFrame([(1, 1)], "session_id BIGINT, `order` INT")
    assert online.validate_single_session(one).count() == 0


def test_writers_and_readers_round_trip(spark):
    base = tempfile.mkdtemp(prefix="cw-io-")
    f = spark.createDataFrame([(1, 2.0)], "session_id BIGINT, x DOUBLE")
    paths = files.write_session_tables(f, f, f, base)
    assert spark.read.parquet(paths["session_labels"]).count() == 1
    out = files.write_cluster_outputs({"assignments": f}, {"k": 8}, os.path.join(base, "clusters"))
    assert json.loads(spark.read.text(out["metrics"]).first()[0]) == {"k": 8}
    labels = spark.createDataFrame([(3, "low-intent"), (1, "high-intent")], "cluster_id INT, intent_label STRING")
    p = files.write_cluster_labels(labels, os.path.join(base, "labels"))
    back = spark.read.option("header", True).csv(p).collect()
    assert [r.cluster_id for r in back] == ["1", "3"]


def test_selected_features_and_interpretations(spark):
    base = tempfile.mkdtemp(prefix="cw-io-")
    sel = os.path.join(base, "sel.json")
    with open(sel, "w") as fh:
        json.dump({"features": [{"feature": "mean_a"}, {"feature": "mean_b"}]}, fh)
    df, msg = files.read_selected_features(spark, sel)
    assert msg is None and [r.feature for r in df.orderBy("position").collect()] == ["mean_a", "mean_b"]
    df, msg = files.read_selected_features(spark, os.path.join(base, "missing.json"))
    assert df is None and "not found" in msg
    bad = os.path.join(base, "bad.csv")
    with open(bad, "w") as fh:
        fh.write("cluster_id,cluster_label\n1,x\n")
    df, msg = files.read_interpretations(spark, bad)
    assert df.count() == 0 and "missing columns" in msg
    good = os.path.join(base, "good.csv")
    with open(good, "w") as fh:
        fh.write("cluster_id,cluster_label,cluster_size_pct,business_intent\n2,b,1%,y\nx,a,2%,z\n0,a,3%,w\n")
    df, msg = files.read_interpretations(spark, good)
    assert msg is None and [r.cluster_id for r in df.collect()] == [0, 2]


def test_describe_clusters_defaults(spark):
    from clickweave.operators.joins import describe_clusters

    summary = spark.createDataFrame([(0, 10, 80.0), (1, 2, 20.0)], "cluster_id INT, cluster_size BIGINT, cluster_percentage DOUBLE")
    interp = spark.createDataFrame([(0, "Zero", "80.0%", "desc")],
                                   "cluster_id INT, cluster_label STRING, cluster_size_pct STRING, business_intent STRING")
    out = {r.cluster_id: r for r in describe_clusters(summary, interp).collect()}
    assert (out[1].cluster_label, out[1].cluster_size_pct, out[1].business_intent) == \
        ("Cluster 1", "20.0%", "Description unavailable.")


def test_correlation_paths_agree_with_pandas(spark):
    import pandas as pd

    rows = [(1, 1.0, 2.0, 5.0), (2, 2.0, 4.1, None), (3, 3.0, 5.9, 1.0), (4, 4.0, 8.2, 2.0), (5, 5.0, 9.7, 0.5)]
    df = spark.createDataFrame(rows, "session_id BIGINT, a DOUBLE, b DOUBLE, c DOUBLE")
    pdf = pd.DataFrame(rows, columns=["session_id", "a", "b", "c"]).drop(columns="session_id")
    want = pdf.corr()
    for cols in (["a", "b"], ["a", "b", "c"]):  # null-free (Gram pass) and with nulls (pairwise)
        got = {(r.feature_a, r.feature_b): r.corr for r in stats.correlation_matrix(df, cols).collect()}
        for (x, y), v in got.items():
            assert abs(v - want.loc[x, y]) < 1e-9


def test_malformed_click_lines_go_to_a_second_table(spark, tmp_path):
    from clickweave.sources import files
    from clickweave.sources.tables import RAW_CLICK_COLUMNS

    good = ["2008", "4", "1", "1", "29", "1", "1", "A13", "1", "5", "1", "28.5", "2", "1"]
    for sep in (";", ","):
        place = tmp_path / ("semicolon" if sep == ";" else "comma")
        place.mkdir()
        bad = [good[:6], [*good, "extra"], ["x", *good[1:]], [*good[:11], "dear", *good[12:]]]
        lines = [RAW_CLICK_COLUMNS, good, *bad, good]
        (place / "clicks.csv").write_text("\n".join(sep.join(line) for line in lines) + "\n")
        rows = files.quarantine(files.read_clicks(spark, str(place / "clicks.csv"), sep=sep, malformed="_malformed"), str(place / "bad"))
        assert rows.columns == list(RAW_CLICK_COLUMNS) and rows.count() == 2
        assert {r["page 2 (clothing model)"] for r in rows.collect()} == {"A13"} and rows.first()["price"] == 28.5
        assert sorted(r["line"] for r in spark.read.parquet(str(place / "bad")).collect()) == sorted(sep.join(b) for b in bad)
        assert files.read_clicks(spark, str(place / "clicks.csv"), sep=sep).count() == 6
