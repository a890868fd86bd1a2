"""Per-click sequence features (E-01, F-01 .. F-13).

Shared spec: ``partitionBy(session_id).orderBy(order, *tiebreak)``. Clicks
arrive hash-partitioned by ``session_id`` (the click adapter joins on the
session key), so every window here sorts inside partitions and never
shuffles: ``HashPartitioning(session_id)`` also satisfies the
``(session_id, value)`` partitioning of the first-occurrence windows.

Ties in (session_id, order) have no input order in Spark: callers that may
have ties pass ``tiebreak`` columns (Q12).

Null rules (fixed by the reference's behaviour):
* change flags: a null on either side counts as a change (null != null);
* running distinct counts count null as one value; ``count(distinct)`` in
  session aggregates does not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from clickweave.operators.frequencies import attach_frequencies


def click_window(tiebreak: Sequence[str] = (), session: str = "session_id", order: str = "order") -> WindowSpec:
    return Window.partitionBy(session).orderBy(order, *tiebreak)


def _running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _whole(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


# E-01
def first_n_clicks(clicks: DataFrame, n: int = 5, tiebreak: Sequence[str] = ()) -> DataFrame:
    """First ``n`` clicks of every session. ``row_number() <= n`` is planned
    as a WindowGroupLimit, applied before the sort/shuffle as well as after."""
    if n <= 0:
        raise ValueError(f"a session cannot be cut to its first {n} clicks")
    w = click_window(tiebreak)
    return clicks.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def changed_vs_previous(col: str, w: WindowSpec, position: Column) -> Column:
    """1 when the value differs from the previous click's (null on either
    side counts as different); 0 on the first click (F-01)."""
    prev = F.lag(F.col(col)).over(w)
    return F.when(position == 1, F.lit(0)).otherwise(F.coalesce(F.col(col) != prev, F.lit(True)).cast("int"))


def first_occurrence(col: str, tiebreak: Sequence[str] = (), session: str = "session_id") -> Column:
    """1 on the first click of the session showing this value (null is a value)."""
    w = Window.partitionBy(session, col).orderBy("order", *tiebreak)
    return (F.row_number().over(w) == 1).cast("int")


def first_in_window(col: str, w: WindowSpec) -> Column:
    """First-occurrence flag from the clicks before this one in the session
    window (null is one value). Quadratic in the session length, so only used
    where sessions are bounded (after the first-N cut); it needs no extra
    sort, unlike a window partitioned by (session, value)."""
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    seen = F.collect_list(col).over(before)
    nulls_before = F.coalesce(F.sum(F.col(col).isNull().cast("int")).over(before), F.lit(0))
    first = F.when(F.col(col).isNull(), nulls_before == 0).otherwise(~F.array_contains(seen, F.col(col)))
    return first.cast("int")


def same_value_count(col: str, w: WindowSpec) -> Column:
    """Clicks of the session sharing this click's value (bounded sessions)."""
    values = F.collect_list(col).over(_whole(w))
    return F.size(F.filter(values, lambda x: x == F.col(col)))


# F-01 .. F-08 (F-12 is all of them together)
def enrich_clicks(clicks: DataFrame, tiebreak: Sequence[str] = (), keep_internal: bool = False,
                  bounded: int | None = None) -> DataFrame:
    """F-12. ``keep_internal`` keeps the first-occurrence flags (``_new_*``)
    and the per-(session, category) click count ``_cat_cnt`` for the session
    aggregation, so it does not sort for them a second time.

    ``bounded``: the caller guarantees at most this many clicks per session
    (first-N output). All flags are then computed inside the one
    (session, order) window, whose sort the first-N cut already produced."""
    w = click_window(tiebreak)
    pos = F.row_number().over(w)
    if bounded:
        df = clicks.select(
            "*",
            first_in_window("main_category", w).alias("_new_category"),
            same_value_count("main_category", w).alias("_cat_cnt"),
            first_in_window("page_2_model", w).alias("_new_model"),
            first_in_window("colour", w).alias("_new_colour"),
            first_in_window("page", w).alias("_new_page"),
        )
    else:
        wcat = Window.partitionBy("session_id", "main_category").orderBy("order", *tiebreak)
        df = clicks.select(
            "*",
            (F.row_number().over(wcat) == 1).cast("int").alias("_new_category"),
            F.count(F.lit(1)).over(_whole(wcat)).alias("_cat_cnt"),
            first_occurrence("page_2_model", tiebreak).alias("_new_model"),
            first_occurrence("colour", tiebreak).alias("_new_colour"),
            first_occurrence("page", tiebreak).alias("_new_page"),
        )
    run = _running(w)
    df = df.select(
        "*",
        pos.alias("click_position"),
        F.count(F.lit(1)).over(_whole(w)).alias("_session_len"),
        F.lag("price").over(w).alias("_prev_price"),
        F.sum("_new_category").over(run).cast("int").alias("cumul_unique_categories"),
        F.sum("_new_model").over(run).cast("int").alias("cumul_unique_models"),
        F.sum("_new_colour").over(run).cast("int").alias("cumul_unique_colours"),
        F.avg("price").over(run).alias("cumul_mean_price"),
    )
    df = df.select(
        "*",
        changed_vs_previous("main_category", w, F.col("click_position")).alias("category_changed"),
        changed_vs_previous("colour", w, F.col("click_position")).alias("colour_changed"),
        changed_vs_previous("page_2_model", w, F.col("click_position")).alias("model_changed"),
    )
    price_diff = F.when(F.col("click_position") == 1, F.lit(0.0)).otherwise(F.col("price") - F.col("_prev_price"))
    df = df.withColumn("price_diff", price_diff)
    return (df.withColumn("price_direction", F.signum("price_diff").cast("int"))
              .withColumn("price_vs_cumul_mean", F.col("price") - F.col("cumul_mean_price"))
              .withColumn("is_category_revisit", 1 - F.col("_new_category"))
              .withColumn("is_model_revisit", 1 - F.col("_new_model"))
              .withColumn("is_colour_revisit", 1 - F.col("_new_colour"))
              .withColumn("click_position_norm",
                          F.when(F.col("_session_len") > 1,
                                 (F.col("click_position") - 1) / (F.col("_session_len") - 1)).otherwise(F.lit(0.0)))
              .drop("_prev_price", "_session_len",
                    *([] if keep_internal else ["_new_category", "_new_model", "_new_colour", "_new_page", "_cat_cnt"])))


SEQUENTIAL_CLICK_COLUMNS = [
    "category_changed", "colour_changed", "model_changed", "price_diff", "price_direction",
    "cumul_unique_categories", "cumul_unique_models", "cumul_unique_colours",
    "cumul_mean_price", "price_vs_cumul_mean", "is_category_revisit", "is_model_revisit",
    "is_colour_revisit", "click_position_norm",
]

# F-13 output columns after the prepared click columns.
CLICK_LEVEL_COLUMNS = [
    "click_position", "n_clicks_observed", "is_first_click", "is_last_observed_click",
    "running_high_price_count", "running_high_price_share", "running_unique_pages",
    "running_unique_models", "running_unique_categories", "running_unique_colours",
    "price_delta_from_prev", "category_changed_from_prev", "category_frequency",
    "colour_frequency", "model_frequency",
]


# F-13 (with F-09, F-10, F-11 inside)
def click_level_features(clicks: DataFrame, n_clicks: int = 5, tiebreak: Sequence[str] = ()) -> DataFrame:
    from clickweave.operators.clean import prepare_clickstream

    selected = first_n_clicks(prepare_clickstream(clicks), n_clicks, tiebreak)
    w = click_window(tiebreak)
    run = _running(w)
    # at most n_clicks clicks per session: flags from the one session window
    df = selected.select(
        "*",
        first_in_window("page", w).alias("_new_page"),
        first_in_window("page_2_model", w).alias("_new_model"),
        first_in_window("main_category", w).alias("_new_category"),
        first_in_window("colour", w).alias("_new_colour"),
    )
    pos = F.row_number().over(w)
    df = df.select(
        "*",
        pos.alias("click_position"),
        F.count("order").over(_whole(w)).alias("n_clicks_observed"),
        F.sum("higher_than_average").over(run).alias("running_high_price_count"),
        F.sum("_new_page").over(run).alias("running_unique_pages"),
        F.sum("_new_model").over(run).alias("running_unique_models"),
        F.sum("_new_category").over(run).alias("running_unique_categories"),
        F.sum("_new_colour").over(run).alias("running_unique_colours"),
        F.coalesce(F.col("price") - F.lag("price").over(w), F.lit(0.0)).alias("price_delta_from_prev"),
    )
    df = df.select(
        "*",
        changed_vs_previous("main_category", w, F.col("click_position")).alias("category_changed_from_prev"),
    )
    df = (df.withColumn("is_first_click", (F.col("click_position") == 1).cast("int"))
            .withColumn("is_last_observed_click", (F.col("click_position") == F.col("n_clicks_observed")).cast("int"))
            .withColumn("running_high_price_share", F.col("running_high_price_count") / F.col("click_position"))
            .drop("_new_page", "_new_model", "_new_category", "_new_colour"))
    df = attach_frequencies(df, df, [("main_category", "category_frequency"),
                                     ("colour", "colour_frequency"),
                                     ("page_2_model", "model_frequency")])
    base = [c for c in selected.columns]
    return df.select(*base, *CLICK_LEVEL_COLUMNS)


ORDER_BUCKET = 1024


def bucketed_rank(df: DataFrame, session: str, order_cols: Sequence[str], bucket: Column,
                  out: str = "click_count") -> DataFrame:
    """Exact 1-based rank of every row in its session by ``order_cols``
    without a window over a whole session: row number inside (session,
    bucket) plus the row count of the session's earlier buckets (a window over
    per-bucket counts, one row per bucket). ``bucket`` must be monotone in
    the order (e.g. ``order // 1024`` or the day of a timestamp), so a hot
    session is spread over its buckets."""
    d = df.withColumn("_bucket", bucket)
    w = Window.partitionBy(session, "_bucket").orderBy(*order_cols)
    local = d.withColumn("_local", F.row_number().over(w))
    counts = d.groupBy(session, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(session).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(session, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (local.join(offsets, [session, "_bucket"])
            .withColumn(out, (F.col("_local") + F.col("_off")).cast("int"))
            .drop("_bucket", "_local", "_off"))


def click_rank(clicks: DataFrame, tiebreak: Sequence[str] = (), bucket: int = ORDER_BUCKET,
               out: str = "click_count") -> DataFrame:
    """Position of every click in its session (see ``bucketed_rank``)."""
    return bucketed_rank(clicks, "session_id", ["order", *tiebreak],
                         F.floor(F.col("order") / bucket).cast("bigint"), out)
