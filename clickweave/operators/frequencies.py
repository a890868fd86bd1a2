"""Value frequencies over a click batch (A-16) and their mapping (D-08).

``freq(v) = count(v) / count(non-null values)`` over the batch.

All dimensions are counted in one pass (one scan, one partially aggregated
shuffle of ``(dim, value)`` keys). The result has one row per distinct value;
it is written before it is joined back, so the planner sees its true size: it
is broadcast only when that size is under the broadcast threshold, and joined
by a shuffle otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# dimension name -> click column (the stored table uses these names)
FREQUENCY_DIMENSIONS = [("model_freq", "page_2_model"), ("category_freq", "main_category"),
                        ("colour_freq", "colour")]


def batch_frequencies(batch: DataFrame, dims: Sequence[tuple[str, str]] = FREQUENCY_DIMENSIONS) -> DataFrame:
    """Long table (dim, value, cnt, total, freq); values as strings."""
    pairs = F.array(*[F.struct(F.lit(d).alias("dim"), F.col(c).cast("string").alias("value")) for d, c in dims])
    long = batch.select(F.explode(pairs).alias("p")).select("p.dim", "p.value").where(F.col("value").isNotNull())
    counts = long.groupBy("dim", "value").agg(F.count(F.lit(1)).alias("cnt"))
    # one row per dimension: broadcast size is bounded by len(dims)
    totals = counts.groupBy("dim").agg(F.sum("cnt").alias("total"))
    return (counts.join(F.broadcast(totals), "dim")
            .select("dim", "value", "cnt", "total", (F.col("cnt") / F.col("total")).alias("freq")))


def materialize(df: DataFrame) -> DataFrame:
    """A small derived table, written once, so later joins are planned from its real size."""
    from clickweave.session import shared_table

    return shared_table(df, "frequencies")


# A-16
def frequency_table(clicks: DataFrame, n_clicks: int | None = 5, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Model, category and colour frequencies over the first ``n_clicks``
    clicks of all sessions (``None``: all clicks)."""
    from clickweave.operators.windows import first_n_clicks

    batch = first_n_clicks(clicks, n_clicks, tiebreak) if n_clicks else clicks
    return batch_frequencies(batch)


def dimension(freqs: DataFrame, dim: str) -> DataFrame:
    return freqs.where(F.col("dim") == dim).drop("dim")


# D-08
def map_frequency(df: DataFrame, col: str, freqs: DataFrame, out: str, keep_count: bool = False) -> DataFrame:
    """Left-join a (value, freq[, cnt]) table on ``col``; missing -> 0.0."""
    right = freqs.select(F.col("value").alias("_fv"), F.col("freq").alias("_ff"),
                         *([F.col("cnt").alias("_fc")] if keep_count else []))
    same_type = dict(df.dtypes)[col] == dict(freqs.dtypes)["value"]
    key = df[col] if same_type else df[col].cast("string")
    joined = df.join(right, key == right["_fv"], "left")
    joined = joined.withColumn(out, F.coalesce(F.col("_ff"), F.lit(0.0)))
    if keep_count:
        joined = joined.withColumn(f"{out}_cnt", F.coalesce(F.col("_fc"), F.lit(0).cast("bigint")))
    return joined.drop("_fv", "_ff", *(["_fc"] if keep_count else []))


def attach_frequencies(df: DataFrame, batch: DataFrame, pairs: list[tuple[str, str]],
                       keep_count: bool = False) -> DataFrame:
    """Per-click frequency columns over ``batch`` (in-batch form)."""
    freqs = materialize(batch_frequencies(batch, [(out, col) for col, out in pairs]))
    for col, out in pairs:
        df = map_frequency(df, col, dimension(freqs, out), out, keep_count)
    return df


def stored_frequencies(freq_table: DataFrame, dim: str) -> DataFrame:
    """One dimension of a stored long frequency table (A-04 output)."""
    return freq_table.where(F.col("dim") == dim).select("value", "freq")
