"""File sources and sinks (A-01 .. A-15).

Readers declare schemas (no inference on large inputs) and add a file-order
column where keep-last semantics need it. Writers are plain DataFrame
writers; one-row metric tables are written as JSON.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.session import shared_table
from clickweave.sources.tables import RAW_CLICK_COLUMNS

RAW_CLICK_SCHEMA = ", ".join(
    f"`{c}` {'STRING' if c == 'page 2 (clothing model)' else 'DOUBLE' if c == 'price' else 'BIGINT' if c == 'session ID' else 'INT'}"
    for c in RAW_CLICK_COLUMNS)


# A-01
def read_clicks(spark: SparkSession, path: str, fmt: str = "csv", sep: str = ";", schema: str | None = None, malformed: str | None = None) -> DataFrame:
    """Click table from Parquet or delimited files with a header line. ``malformed`` names a column that keeps the whole
    line of rows with too few or too many fields or a field of another type (null for good rows)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    read = spark.read.option("header", True).option("sep", sep).option("enforceSchema", True)
    schema = schema or RAW_CLICK_SCHEMA
    if malformed is None:
        return read.schema(schema).csv(path)
    return read.schema(f"{schema}, `{malformed}` STRING").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", malformed).csv(path)


def quarantine(clicks: DataFrame, path: str, malformed: str = "_malformed") -> DataFrame:
    """Writes the malformed lines to ``path`` (one text column, ``line``) and gives the good rows without that column.
    The files are parsed once: both parts come from the written result."""
    parsed = shared_table(clicks, "parsed-clicks")
    parsed.where(F.col(malformed).isNotNull()).select(F.col(malformed).alias("line")).write.mode("overwrite").parquet(path)
    return parsed.where(F.col(malformed).isNull()).drop(malformed)


# A-02
def read_external_labels(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Label file with a file-order column ``_row`` for keep-last de-duplication:
    (file, start of the block read, number within the task). A task reads its
    blocks in order, so the triple ascends with the place in the file."""
    df = spark.read.option("header", True).csv(path) if fmt == "csv" else spark.read.parquet(path)
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    return df.withColumn("_row", F.struct(*place))


TEXT_COLUMNS = ("intent_label", "cluster_label", "business_intent", "cluster_size_pct", "label")


# A-03
def read_cluster_files(spark: SparkSession, features_path: str, assignments_path: str, labels_path: str):
    out = []
    for path, need in ((features_path, {"session_id"}), (assignments_path, {"session_id", "cluster_id"}),
                       (labels_path, {"cluster_id", "intent_label"})):
        # every column as text from the header line alone, then numbers where the whole column is one: no inference pass over large files
        df = spark.read.option("header", True).csv(path)
        names = [c for c in df.columns if c not in TEXT_COLUMNS]
        df = df.select(*[(F.col(f"`{c}`").cast("int") if c == "cluster_id" else F.col(f"`{c}`").cast("long") if c == "session_id" else
                          F.col(f"`{c}`").cast("double")).alias(c) if c in names else F.col(f"`{c}`") for c in df.columns])
        missing = need - set(df.columns)
        if missing:
            raise ValueError(f"{path} is missing required columns: {sorted(missing)}")
        out.append(df)
    return tuple(out)


# A-04
def read_frequencies(spark: SparkSession, path: str) -> DataFrame:
    """Stored frequencies: either the long table (dim, value, freq) as JSON
    lines, or one JSON object {dim: {value: freq}} (multi-line)."""
    raw = spark.read.option("multiLine", True).json(path)
    if "dim" in raw.columns:
        return spark.read.json(path).select("dim", F.col("value").cast("string"), F.col("freq").cast("double"))
    parts = []
    for dim in raw.columns:
        m = F.from_json(F.to_json(F.col(dim)), "map<string,double>")
        parts.append(raw.select(F.lit(dim).alias("dim"), F.explode(m).alias("value", "freq")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# A-05
def write_session_tables(first_n: DataFrame, full: DataFrame, labels: DataFrame, out_dir: str,
                         fmt: str = "parquet") -> dict[str, str]:
    paths = {}
    for name, df in (("session_features_first_n", first_n), ("session_features_full", full),
                     ("session_labels", labels)):
        paths[name] = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").format(fmt).option("header", True).save(paths[name])
    return paths


# A-06
def write_cluster_outputs(tables: dict[str, DataFrame], metrics: dict, out_dir: str) -> dict[str, str]:
    spark = next(iter(tables.values())).sparkSession
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{out_dir.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(paths[name])
    paths["metrics"] = f"{out_dir.rstrip('/')}/clustering_metrics"
    spark.createDataFrame([(json.dumps(metrics, sort_keys=True),)], "value STRING").coalesce(1) \
        .write.mode("overwrite").text(paths["metrics"])
    return paths


# A-07
def write_cluster_labels(labels: DataFrame, path: str) -> str:
    from clickweave.operators.clusters import validate_cluster_labels

    validate_cluster_labels(labels).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


# A-08 / A-09 / A-13
def write_model_report(model, metrics: DataFrame, out_dir: str, comparison: DataFrame | None = None,
                       cv_results: DataFrame | None = None) -> dict[str, str]:
    """Saved model, metrics (JSON), and if given the comparison table and the cross-validation results (CSV)."""
    paths = {"model": f"{out_dir.rstrip('/')}/model", "metrics": f"{out_dir.rstrip('/')}/metrics"}
    model.write().overwrite().save(paths["model"])
    metrics.write.mode("overwrite").json(paths["metrics"])
    if comparison is not None:
        paths["comparison"] = f"{out_dir.rstrip('/')}/comparison"
        comparison.write.mode("overwrite").option("header", True).csv(paths["comparison"])
    if cv_results is not None:
        paths["cv_results"] = f"{out_dir.rstrip('/')}/cv_results"
        cv_results.write.mode("overwrite").option("header", True).csv(paths["cv_results"])
    return paths


def load_model(path: str):
    """A-09: fitted pipeline and its expected feature list."""
    from pyspark.ml import PipelineModel

    model = PipelineModel.load(path)
    first = model.stages[0]
    cols = first.getInputCols() if hasattr(first, "getInputCols") else []
    return model, list(cols)


# A-12
def selected_features_sink(selected: DataFrame, path: str, percentile: float = 0.75) -> str:
    out = selected.select(F.lit("coefficient_of_variation").alias("method"), F.lit(percentile).alias("threshold_percentile"),
                          "feature", F.round("coefficient_of_variation", 4).alias("coefficient_of_variation"),
                          F.round("std_dev", 4).alias("std_dev"), F.round("mean", 4).alias("mean"))
    out.write.mode("overwrite").json(path)
    return path


# A-14
def read_selected_features(spark: SparkSession, path: str) -> tuple[DataFrame | None, str | None]:
    """(features, message): a missing file, a bad shape or an empty list
    gives a message, not a failure."""
    try:
        raw = spark.read.option("multiLine", True).json(path)
    except Exception:  # noqa: BLE001 - a missing file is a message
        return None, f"Selected features file not found: {path}"
    if "features" in raw.columns:
        out = raw.select(F.posexplode("features").alias("position", "f")).select("position", "f.feature")
    elif "feature" in raw.columns:
        out = raw.select(F.monotonically_increasing_id().alias("position"), "feature")
    else:
        return None, "Selected features file has an unexpected format."
    if out.limit(1).count() == 0:
        return None, "Selected features list is empty."
    return out, None


# A-15
def read_interpretations(spark: SparkSession, path: str) -> tuple[DataFrame, str | None]:
    need = ["cluster_id", "cluster_label", "cluster_size_pct", "business_intent"]
    raw = spark.read.option("header", True).csv(path)
    missing = [c for c in need if c not in raw.columns]
    if missing:
        return spark.createDataFrame([], ", ".join(f"{c} STRING" for c in need)), f"missing columns: {missing}"
    out = raw.select(F.col("cluster_id").try_cast("double").try_cast("int").alias("cluster_id"), *need[1:])
    return out.where(F.col("cluster_id").isNotNull()).orderBy("cluster_id"), None
