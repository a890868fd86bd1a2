"""Shared helpers: scratch tables in the cluster's shared folder, connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NULL_KEY = 2**63 - 1  # stands for a null id in keys and comparisons: larger than every id


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: ``spark.checkpoint.dir``; an own one only where it is unset and all tasks run in this process."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = "file://" + tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def bounded_batches(spark: SparkSession) -> None:
    """Batches of few rows from Parquet, and of about 4 MB at most to Python, so long texts don't pile up in one batch."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "512")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


class Scratch:
    """Tables of one run, written as Parquet below the shared folder.

    A written table cuts lineage and survives lost executors. ``drop`` removes
    a table that no later plan reads.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        bounded_batches(spark)
        self.root = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark.sparkContext._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            fs.delete(path, True)


def key_of(column: str) -> F.Column:
    """Id column as a non-null long key."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_KEY))


def masked(docs: DataFrame, *kept: str) -> tuple[DataFrame, list[str]]:
    """``docs`` with all columns but ``kept`` renamed, and the new names in order, so that helper columns clash with none."""
    names = [n if n in kept else f"_column_{i}" for i, n in enumerate(docs.columns)]
    return docs.toDF(*names), names


def arrow_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the texts of a slice hold about ``limit`` bytes (one text at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = text_buffer(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(off, off[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offset of each row (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def components(scratch: Scratch, edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of the undirected ``edges`` (a, b long): rows (node, comp), comp the smallest node.

    Minimum labels move along edges and are then replaced by their label's
    label, so chains shorten geometrically. Minima aggregate before the
    shuffle; every round is a written table; only a change flag is collected.
    No edges: no rows.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = scratch.table(both, f"{name}-edges")
    labels = scratch.table(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("comp")), f"{name}-0")
    for turn in range(1, 200):
        near = both.join(labels.select(F.col("node").alias("b"), "comp"), "b").groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        step = labels.join(near, "node").select("node", F.col("comp").alias("was"), F.least("comp", "m").alias("comp"))
        step = scratch.table(step, f"{name}-{turn}-step")
        jump = step.select(F.col("node").alias("comp"), F.col("comp").alias("further"))
        new = step.join(jump, "comp", "left").select("node", "was", F.least("comp", F.coalesce("further", "comp")).alias("comp"))
        new = scratch.table(new, f"{name}-{turn}")
        changed = not new.where("comp <> was").isEmpty()
        scratch.drop(f"{name}-{turn}-step", f"{name}-{turn - 1}")
        labels = new.select("node", "comp")
        if not changed:
            return labels
    raise RuntimeError("components did not settle")
