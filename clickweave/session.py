"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: AQE re-plans joins from runtime sizes
# (a data-derived side is only broadcast when its *measured* size is under
# the threshold), coalesces small shuffle partitions and splits skewed ones.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "clickweave", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is set by the operator of the cluster and is read, never
    replaced. When it is unset a fresh folder is made if all tasks run in this
    process (``local[..]``); on a cluster that folder would not be shared, so
    an unset folder is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="clickweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed
    once, short lineage, and nothing is held in executor memory."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/clickweave-tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


TASK_ROWS = 250_000  # of wide rows that a task sorts or aggregates at once


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """A written table, shuffled by ``keys`` into parts of about ``TASK_ROWS`` rows, so that a task's memory
    doesn't grow with the table; one of fewer rows than the cluster's cores take at that size stays as it is."""
    parts = -(-df.count() // TASK_ROWS)
    return df.repartition(parts, *keys) if parts > df.sparkSession.sparkContext.defaultParallelism else df


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``clickweave`` importable in Python workers (pandas UDFs,
    ``applyInPandas`` state functions) by adding a zip of the package with
    ``SparkContext.addPyFile``; Spark distributes it to every executor.
    Done once per SparkContext."""
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out_dir = tempfile.mkdtemp(prefix="clickweave-pyfiles-")
    zpath = os.path.join(out_dir, "clickweave.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg):
            if "__pycache__" in dirpath:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(key)
