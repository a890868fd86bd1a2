"""Driver tables and their mapping onto click-shaped data.

The click data set of the reference is not available here; the driver tables
are mapped onto it (one order = one session, one line item = one click):

* session = ``l_orderkey``; click number = row_number over
  (``l_linenumber``, ``l_partkey``, ``l_suppkey``, ``l_extendedprice``),
* price = floor(extendedprice / 1000); category from ``p_type``; colour from
  the brand number; clothing model = category letter || partkey mod 54;
  page from ``p_size``; location / photography from ``l_suppkey``;
  country = nation + 1; date from ``o_orderdate``;
  ``price 2`` = 1 when price is above the mean price of its category.

Only the columns used are read (column pruning reaches the Parquet scan).
Part attributes are derived on ``part`` before the join so the per-row work
on ``lineitem`` is the join and one window. The join to ``orders`` is on the
session key, so its output is already hash-partitioned by session and every
per-session window / aggregate downstream reuses that exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

RAW_CLICK_COLUMNS = [
    "year", "month", "day", "order", "country", "session ID",
    "page 1 (main category)", "page 2 (clothing model)", "colour", "location",
    "model photography", "price", "price 2", "page",
]

MODEL_NUMBERS = 54


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def _category_code(p_type: F.Column) -> F.Column:
    expr = F.when(p_type == "ECONOMY", 1).when(p_type == "STANDARD", 2).when(p_type == "MEDIUM", 3)
    return expr.otherwise(4)


def _part_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_brand", "p_type", "p_size"])
    cat = _category_code(F.col("p_type"))
    letter = F.when(cat == 1, "A").when(cat == 2, "B").when(cat == 3, "C").otherwise("P")
    return part.select(
        "p_partkey",
        cat.alias("cat_code"),
        (F.substring("p_brand", 7, 10).cast("int") % 14 + 1).alias("colour"),
        F.concat(letter, (F.col("p_partkey") % MODEL_NUMBERS).cast("string")).alias("model"),
        (F.expr("(p_size - 1) div 10") + 1).cast("int").alias("page"),
    )


def raw_clicks(spark: SparkSession, sf_dir: str, first_n: int | None = None) -> DataFrame:
    """Clicks in the raw data-set schema (raw column names, raw codes).

    ``first_n``: keep only the first N clicks of every session, cut on
    ``lineitem`` before any join (a partial top-N runs before the shuffle,
    so a hot order contributes at most N rows per map task and the joins
    never see more than N rows of one session). The source has no nulls in
    the columns the cleaning step checks, so cutting before cleaning keeps
    exactly the clicks a cut after cleaning keeps."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"])
    parts = _part_attributes(spark, sf_dir)
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])

    line_order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    if first_n:
        # row_number() <= n is planned as a partial top-n before the shuffle
        w = Window.partitionBy("l_orderkey").orderBy(*line_order)
        numbered = li.withColumn("order", F.row_number().over(w)).where(F.col("order") <= first_n)
    else:
        from clickweave.operators.windows import bucketed_rank

        # monotone in the line order and fine enough to split an order of any size
        bucket = F.col("l_linenumber").cast("bigint") * (1 << 32) + F.floor(F.col("l_partkey") / 4096)
        numbered = bucketed_rank(li, "l_orderkey", line_order, bucket, "order")
    price = F.floor(F.col("l_extendedprice") / 1000).cast("int")

    # Mean price per category over all line items: summed per part first
    # (partial aggregation absorbs hot parts), then per category. At most 4
    # rows (category is a 4-way CASE), so broadcasting it is bounded.
    per_part = li.groupBy("l_partkey").agg(F.sum(price).alias("_s"), F.count(F.lit(1)).alias("_n"))
    cat_mean = (per_part.join(parts.select("p_partkey", "cat_code"), per_part.l_partkey == parts.p_partkey)
                .groupBy("cat_code").agg((F.sum("_s") / F.sum("_n")).alias("cat_mean_price")))

    priced = (numbered.join(parts, numbered.l_partkey == parts.p_partkey).withColumn("price", price)
              .join(F.broadcast(cat_mean), "cat_code"))
    order_info = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", "o_orderdate", "c_nationkey")
    clicks = priced.join(order_info, priced.l_orderkey == order_info.o_orderkey)
    return clicks.select(
        F.year("o_orderdate").alias("year"),
        F.month("o_orderdate").alias("month"),
        F.dayofmonth("o_orderdate").alias("day"),
        F.col("order"),
        (F.col("c_nationkey") + 1).cast("int").alias("country"),
        F.col("l_orderkey").alias("session ID"),
        F.col("cat_code").cast("int").alias("page 1 (main category)"),
        F.col("model").alias("page 2 (clothing model)"),
        F.col("colour").cast("int").alias("colour"),
        (F.col("l_suppkey") % 6 + 1).cast("int").alias("location"),
        (F.col("l_suppkey") % 2 + 1).cast("int").alias("model photography"),
        F.col("price").cast("double").alias("price"),
        F.when(F.col("price") > F.col("cat_mean_price"), 1).otherwise(2).alias("price 2"),
        F.col("page"),
    )


# SQL text of the same mapping, prepended to every DuckDB oracle query.
# Produces ``raw_clicks`` (raw names) and ``clicks`` (prepared, snake-case,
# with ``higher_than_average`` and ``main_category`` resolved).
CLICKS_CTE = """
parts_attr AS (
  SELECT p_partkey,
         CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'STANDARD' THEN 2 WHEN 'MEDIUM' THEN 3 ELSE 4 END AS cat_code,
         CAST(CAST(substring(p_brand, 7, 10) AS INTEGER) % 14 + 1 AS INTEGER) AS colour,
         (CASE p_type WHEN 'ECONOMY' THEN 'A' WHEN 'STANDARD' THEN 'B' WHEN 'MEDIUM' THEN 'C' ELSE 'P' END)
           || CAST(p_partkey % 54 AS VARCHAR) AS model,
         CAST((p_size - 1) // 10 + 1 AS INTEGER) AS page
  FROM part
),
priced AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_extendedprice,
         pa.cat_code, pa.colour, pa.model, pa.page,
         CAST(floor(l.l_extendedprice / 1000) AS INTEGER) AS price
  FROM lineitem l JOIN parts_attr pa ON l.l_partkey = pa.p_partkey
),
cat_mean AS (SELECT cat_code, avg(price) AS cat_mean_price FROM priced GROUP BY cat_code),
raw_clicks AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS "year",
         CAST(month(o.o_orderdate) AS INTEGER) AS "month",
         CAST(day(o.o_orderdate) AS INTEGER) AS "day",
         CAST(row_number() OVER (PARTITION BY p.l_orderkey
              ORDER BY p.l_linenumber, p.l_partkey, p.l_suppkey, p.l_extendedprice) AS INTEGER) AS "order",
         CAST(c.c_nationkey + 1 AS INTEGER) AS country,
         p.l_orderkey AS "session ID",
         CAST(p.cat_code AS INTEGER) AS "page 1 (main category)",
         p.model AS "page 2 (clothing model)",
         p.colour AS colour,
         CAST(p.l_suppkey % 6 + 1 AS INTEGER) AS location,
         CAST(p.l_suppkey % 2 + 1 AS INTEGER) AS "model photography",
         CAST(p.price AS DOUBLE) AS price,
         CASE WHEN p.price > m.cat_mean_price THEN 1 ELSE 2 END AS "price 2",
         p.page AS page
  FROM priced p JOIN cat_mean m ON p.cat_code = m.cat_code
  JOIN orders o ON p.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
),
clicks AS (
  SELECT "year", "month", "day", "order", country, "session ID" AS session_id,
         "page 1 (main category)" AS page_1_main_category,
         "page 2 (clothing model)" AS page_2_model,
         colour, location, "model photography" AS model_photography,
         price, "price 2" AS price_2, page,
         CAST(CASE "price 2" WHEN 1 THEN 1 WHEN 2 THEN 0 END AS INTEGER) AS higher_than_average,
         CASE "page 1 (main category)" WHEN 1 THEN 'trousers' WHEN 2 THEN 'skirts'
              WHEN 3 THEN 'blouses' WHEN 4 THEN 'sale' END AS main_category
  FROM raw_clicks
)"""

def event_clicks(spark: SparkSession, sf_dir: str, high_price_cut: float = 56.0) -> DataFrame:
    """The ``events`` table as an arriving click stream in the stream schema.

    session = ``user_id``; click number by (``ts``, ``event_id``); product
    fields are derived from the event deterministically; ``price 2`` uses the
    event producer's fixed cut (B-17).
    """
    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    cat = (F.when(F.col("event_type") == "view", 1).when(F.col("event_type") == "click", 2)
           .when(F.col("event_type") == "purchase", 3).otherwise(4))
    letter = F.when(cat == 1, "A").when(cat == 2, "B").when(cat == 3, "C").otherwise("P")
    price = F.floor(F.col("value")).cast("int")
    from clickweave.operators.windows import bucketed_rank

    # click number by (ts, event_id), bucketed by hour: no window over a whole user or day
    ev = bucketed_rank(ev, "user_id", ["ts", "event_id"], F.date_trunc("hour", "ts"), "order")
    return ev.select(
        F.col("user_id").alias("session_id"),
        F.col("order"),
        F.col("ts"), F.col("event_id"),
        F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("day"),
        (F.col("user_id") % 47 + 1).cast("int").alias("country"),
        cat.cast("int").alias("page_1_main_category"),
        F.concat(letter, (F.col("event_id") % MODEL_NUMBERS).cast("string")).alias("page_2_clothing_model"),
        (F.col("event_id") % 14 + 1).cast("int").alias("colour"),
        (F.col("event_id") % 6 + 1).cast("int").alias("location"),
        (F.col("event_id") % 2 + 1).cast("int").alias("model_photography"),
        price.cast("double").alias("price"),
        F.when(price >= high_price_cut, 1).otherwise(2).alias("price_2"),
        (F.col("event_id") % 5 + 1).cast("int").alias("page"),
    )


EVENT_CLICKS_CTE = """
event_clicks AS (
  SELECT user_id AS session_id,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS "order",
         ts, event_id,
         CAST(year(ts) AS INTEGER) AS "year", CAST(month(ts) AS INTEGER) AS "month", CAST(day(ts) AS INTEGER) AS "day",
         CAST(user_id % 47 + 1 AS INTEGER) AS country,
         CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS INTEGER) AS page_1_main_category,
         (CASE event_type WHEN 'view' THEN 'A' WHEN 'click' THEN 'B' WHEN 'purchase' THEN 'C' ELSE 'P' END)
            || CAST(event_id % 54 AS VARCHAR) AS page_2_clothing_model,
         CAST(event_id % 14 + 1 AS INTEGER) AS colour,
         CAST(event_id % 6 + 1 AS INTEGER) AS location,
         CAST(event_id % 2 + 1 AS INTEGER) AS model_photography,
         CAST(CAST(floor(value) AS INTEGER) AS DOUBLE) AS price,
         CASE WHEN CAST(floor(value) AS INTEGER) >= 56 THEN 1 ELSE 2 END AS price_2,
         CAST(event_id % 5 + 1 AS INTEGER) AS page
  FROM events
)"""


def manual_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partial manual-label file stand-in: order status F -> 1, O -> 0, P -> no label;
    confidence = priority digit / 5. Session id and label columns use raw names."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderstatus", "o_orderpriority"])
    return o.select(
        F.col("o_orderkey").alias("session_id"),
        F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 0).alias("label"),
        (F.substring("o_orderpriority", 1, 1).cast("int") / 5.0).alias("confidence"),
    ).where(F.col("label").isNotNull())


MANUAL_LABELS_CTE = """
manual_labels AS (
  SELECT o_orderkey AS session_id,
         CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS label,
         CAST(substring(o_orderpriority, 1, 1) AS INTEGER) / 5.0 AS confidence
  FROM orders WHERE o_orderstatus IN ('F', 'O')
)"""


# Text intent labels derived from order priority: exercises label text
# normalisation (several spellings per class).
PRIORITY_TEXT_LABEL = {
    "1-URGENT": " High-Intent", "2-HIGH": "high_intent", "3-MEDIUM": "low intent",
    "4-NOT SPECIFIED": "LOW-INTENT ", "5-LOW": "0",
}


def text_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderpriority"])
    expr = F.lit(None).cast("string")
    for k, v in reversed(list(PRIORITY_TEXT_LABEL.items())):
        expr = F.when(F.col("o_orderpriority") == k, v).otherwise(expr)
    return o.select(F.col("o_orderkey").alias("session_id"), expr.alias("intent_label"))


TEXT_LABELS_CTE = """
text_labels AS (
  SELECT o_orderkey AS session_id,
         CASE o_orderpriority WHEN '1-URGENT' THEN ' High-Intent' WHEN '2-HIGH' THEN 'high_intent'
              WHEN '3-MEDIUM' THEN 'low intent' WHEN '4-NOT SPECIFIED' THEN 'LOW-INTENT ' WHEN '5-LOW' THEN '0' END
           AS intent_label
  FROM orders
)"""
