"""Registered queries: sources (A-01), cleaning and decoding (B)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from clickweave.functions.values import CATEGORIES, COLOURS, COUNTRIES, LOCATIONS, PHOTOGRAPHY, sql_case
from clickweave.operators import clean
from clickweave.plans.registry import CLICKS_CTE, EVENT_CLICKS_CTE, register
from clickweave.session import checkpoint_dir
from clickweave.sources import files
from clickweave.sources.tables import TEXT_LABELS_CTE, event_clicks, raw_clicks, text_labels

W = "WITH " + CLICKS_CTE


@register("read_clicks", "A-01", W + "\nSELECT * FROM raw_clicks")
def q_read_clicks(spark, sf):
    """The clicks as delimited files, read back by their schema; malformed lines would go to a second table."""
    base = os.path.join(checkpoint_dir(spark), "clickweave-io", f"clicks_{uuid.uuid4().hex}")
    raw_clicks(spark, sf).write.option("header", True).option("sep", ";").csv(f"{base}/csv")
    return files.quarantine(files.read_clicks(spark, f"{base}/csv", sep=";", malformed="_malformed"), f"{base}/malformed")


NORMALIZED_SQL = """
SELECT "year", "month", "day", "order", country, "session ID" AS session_id,
       "page 1 (main category)" AS page_1_main_category, "page 2 (clothing model)" AS page_2_clothing_model,
       colour, location, "model photography" AS model_photography, price, "price 2" AS price_2, page
FROM raw_clicks"""


@register("normalize_columns", "B-01", W + NORMALIZED_SQL)
def q_normalize_columns(spark, sf):
    return clean.normalize_columns(raw_clicks(spark, sf))


@register("resolve_aliases", "B-02", W + """
SELECT "year", "month", "day", "order", country, session_id, page_1_main_category, page_2_model,
       colour, location, model_photography, price, price_2, page, higher_than_average, main_category
FROM clicks""")
def q_resolve_aliases(spark, sf):
    return clean.resolve_aliases(clean.normalize_columns(raw_clicks(spark, sf)))


@register("prepare_clickstream", "B-06", W + "\nSELECT * FROM clicks")
def q_prepare_clickstream(spark, sf):
    return clean.prepare_clickstream(raw_clicks(spark, sf))


DECODE_SQL = f"""
SELECT "month", "day", "order", {sql_case('country', COUNTRIES)} AS country, "session ID",
       "page 2 (clothing model)", {sql_case('colour', COLOURS)} AS colour, location,
       {sql_case('"model photography"', PHOTOGRAPHY)} AS "model photography",
       CAST(price AS INTEGER) AS price, page,
       {sql_case('"page 1 (main category)"', CATEGORIES)} AS main_category,
       CASE "price 2" WHEN 1 THEN 1 WHEN 2 THEN 0 END AS higher_than_average
FROM raw_clicks"""


@register("decode_clicks", "B-04", W + DECODE_SQL)
def q_decode_clicks(spark, sf):
    return clean.decode_clicks(raw_clicks(spark, sf))


@register("decode_location", "B-05", W + f"""
SELECT session_id, "order", location, {sql_case('location', LOCATIONS)} AS location_name FROM clicks""")
def q_decode_location(spark, sf):
    return clean.decode_location(clean.prepare_clickstream(raw_clicks(spark, sf))).select(
        "session_id", "order", "location", "location_name")


def _rules_sql() -> str:
    parts = [f"CASE WHEN NOT coalesce({rule}, false) THEN '{name}' END" for name, rule in clean.CLICK_RULES.items()]
    return "concat_ws(',', " + ", ".join(parts) + ")"


@register("validate_clicks", "B-07", W + f"""
, v AS (SELECT session_id, "order", {_rules_sql()} AS failed_rules FROM (
  SELECT "year", "month", "day", "order", country, "session ID" AS session_id,
       "page 1 (main category)" AS page_1_main_category, "page 2 (clothing model)" AS page_2_clothing_model,
       colour, location, "model photography" AS model_photography, price, "price 2" AS price_2, page
  FROM raw_clicks))
SELECT session_id, "order", failed_rules, CAST(failed_rules = '' AS INTEGER) AS is_valid FROM v""")
def q_validate_clicks(spark, sf):
    v = clean.validate_clicks(clean.normalize_columns(raw_clicks(spark, sf)))
    return v.select("session_id", "order", "failed_rules", "is_valid")


@register("one_hot_country", "B-08", W + ", d AS (" + DECODE_SQL + ")\nSELECT \"session ID\", \"order\", country, "
          + ", ".join(f"CAST(country = '{n}' AS INTEGER) AS \"country_{n}\"" for n in COUNTRIES.values())
          + " FROM d")
def q_one_hot_country(spark, sf):
    d = clean.decode_clicks(raw_clicks(spark, sf)).select("session ID", "order", "country")
    return clean.one_hot_country(d)


@register("to_raw_rows", "B-09", "WITH " + EVENT_CLICKS_CTE + """
SELECT "year", "month", "day", "order", country, session_id AS "session ID",
       page_1_main_category AS "page 1 (main category)", page_2_clothing_model AS "page 2 (clothing model)",
       colour, location, model_photography AS "model photography", price, price_2 AS "price 2", page
FROM event_clicks""")
def q_to_raw_rows(spark, sf):
    return clean.to_raw_rows(event_clicks(spark, sf))


@register("normalize_intent_label", "B-10", "WITH " + TEXT_LABELS_CTE + """
SELECT session_id, intent_label,
       CASE lower(trim(intent_label)) WHEN 'low-intent' THEN 0 WHEN 'low_intent' THEN 0 WHEN 'low intent' THEN 0
            WHEN '0' THEN 0 WHEN 'high-intent' THEN 1 WHEN 'high_intent' THEN 1 WHEN 'high intent' THEN 1
            WHEN '1' THEN 1 END AS label
FROM text_labels""")
def q_normalize_intent_label(spark, sf):
    return clean.normalize_intent_label(text_labels(spark, sf))


@register("normalize_intent_label_text", "B-11", "WITH " + TEXT_LABELS_CTE + """
, t AS (SELECT session_id, intent_label,
        replace(replace(replace(lower(trim(intent_label)), '_', '-'), ' ', '-'), '‑', '-') AS s FROM text_labels)
SELECT session_id, intent_label, CASE WHEN s IN ('', 'nan', '<na>') THEN NULL ELSE s END AS intent_label_norm
FROM t""")
def q_normalize_intent_label_text(spark, sf):
    t = text_labels(spark, sf)
    return t.select("session_id", "intent_label",
                    clean.normalize_intent_label_text("intent_label").alias("intent_label_norm"))


@register("value_profile", "B-15", W + """
SELECT * FROM (
  SELECT 'session_id' AS column_name, count(DISTINCT session_id) AS n_distinct, CAST(count_if(session_id IS NULL) AS BIGINT) AS n_null FROM clicks
  UNION ALL SELECT 'page_2_model', count(DISTINCT page_2_model), CAST(count_if(page_2_model IS NULL) AS BIGINT) FROM clicks
  UNION ALL SELECT 'main_category', count(DISTINCT main_category), CAST(count_if(main_category IS NULL) AS BIGINT) FROM clicks
  UNION ALL SELECT 'colour', count(DISTINCT colour), CAST(count_if(colour IS NULL) AS BIGINT) FROM clicks
  UNION ALL SELECT 'country', count(DISTINCT country), CAST(count_if(country IS NULL) AS BIGINT) FROM clicks
  UNION ALL SELECT 'page', count(DISTINCT page), CAST(count_if(page IS NULL) AS BIGINT) FROM clicks
  UNION ALL SELECT 'price', count(DISTINCT price), CAST(count_if(price IS NULL) AS BIGINT) FROM clicks)""")
def q_value_profile(spark, sf):
    return clean.value_profile(clean.prepare_clickstream(raw_clicks(spark, sf)),
                               ["session_id", "page_2_model", "main_category", "colour", "country", "page", "price"])


@register("high_price_flag", "B-17", "WITH " + EVENT_CLICKS_CTE + """
SELECT session_id, "order", price, CASE WHEN price >= 56 THEN 1 ELSE 2 END AS price_2 FROM event_clicks""")
def q_high_price_flag(spark, sf):
    ev = event_clicks(spark, sf)
    return ev.select("session_id", "order", "price", clean.high_price_flag("price", 56.0).alias("price_2"))
