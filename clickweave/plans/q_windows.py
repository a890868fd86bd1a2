"""Registered queries: first-N cut, ordering (E) and per-click window features (F),
frequency table (A-16) and frequency mapping (D-08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickweave.operators import ordering, windows
from clickweave.operators.clean import prepare_clickstream
from clickweave.operators.frequencies import frequency_table, map_frequency
from clickweave.plans import sql_features as S
from clickweave.plans.registry import CLICKS_CTE, register
from clickweave.plans.q_sessions import prepared
from clickweave.sources.tables import raw_clicks

W = "WITH " + CLICKS_CTE


@register("first_n_clicks", "E-01", W + S.selected_cte(5) + "\nSELECT * FROM sel")
def q_first_n_clicks(spark, sf):
    return windows.first_n_clicks(prepared(spark, sf, 5), 5)


@register("last_click", "E-02", W + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY "order" DESC) AS rn FROM clicks)
WHERE rn = 1""")
def q_last_click(spark, sf):
    return ordering.last_click(prepared(spark, sf))


@register("first_last_model", "E-03", W + """
SELECT session_id, arg_min_null(page_2_model, "order") AS first_model, arg_max_null(page_2_model, "order") AS last_model
FROM clicks GROUP BY session_id""")
def q_first_last_model(spark, sf):
    return ordering.first_last_model(prepared(spark, sf))


@register("sessions_distinct", "E-10", W + "\nSELECT DISTINCT session_id FROM clicks")
def q_sessions_distinct(spark, sf):
    return ordering.sessions_distinct(prepared(spark, sf))


def _enriched(spark, sf):
    return windows.enrich_clicks(windows.first_n_clicks(prepared(spark, sf, 5), 5), bounded=5)


ENRICH_BODY = S.selected_cte(5) + S.ENRICH_CTE


def _enrich_part(key, sid, cols, round_cols=()):
    sel = ", ".join(f"round({c}, 6) AS {c}" if c in round_cols else c for c in cols)

    @register(key, sid, W + ENRICH_BODY + f'\nSELECT session_id, "order", {sel} FROM enr')
    def q(spark, sf):
        df = _enriched(spark, sf)
        return df.select("session_id", "order",
                         *[F.round(c, 6).alias(c) if c in round_cols else F.col(c) for c in cols])
    return q


_enrich_part("change_flags", "F-01", ["category_changed", "colour_changed", "model_changed"])
_enrich_part("price_diff", "F-02", ["price_diff"])
_enrich_part("price_direction", "F-03", ["price_direction"])
_enrich_part("cumul_unique", "F-04", ["cumul_unique_categories", "cumul_unique_models", "cumul_unique_colours"])
_enrich_part("cumul_mean_price", "F-05", ["cumul_mean_price"])
_enrich_part("price_vs_cumul_mean", "F-06", ["price_vs_cumul_mean"])
_enrich_part("revisit_flags", "F-07", ["is_category_revisit", "is_model_revisit", "is_colour_revisit"])
_enrich_part("click_position_norm", "F-08", ["click_position_norm"])
_enrich_part("enrich_clicks", "F-12", windows.SEQUENTIAL_CLICK_COLUMNS)

CLICK_LEVEL_BODY = S.selected_cte(5) + f""",
c0 AS (
  SELECT *,
    CAST(row_number() OVER ({S.WS}) AS INTEGER) AS click_position,
    count("order") OVER (PARTITION BY session_id) AS n_clicks_observed,
    {S.first_flag('page')} AS new_page, {S.first_flag('page_2_model')} AS new_model,
    {S.first_flag('main_category')} AS new_category, {S.first_flag('colour')} AS new_colour,
    lag(price) OVER ({S.WS}) AS prev_price, lag(main_category) OVER ({S.WS}) AS prev_category
  FROM sel
),
c1 AS (
  SELECT *,
    CAST(sum(higher_than_average) OVER {S.RUN} AS BIGINT) AS running_high_price_count,
    CAST(sum(new_page) OVER {S.RUN} AS BIGINT) AS running_unique_pages,
    CAST(sum(new_model) OVER {S.RUN} AS BIGINT) AS running_unique_models,
    CAST(sum(new_category) OVER {S.RUN} AS BIGINT) AS running_unique_categories,
    CAST(sum(new_colour) OVER {S.RUN} AS BIGINT) AS running_unique_colours,
    coalesce(price - prev_price, 0.0) AS price_delta_from_prev,
    {S.changed('main_category', 'prev_category')} AS category_changed_from_prev
  FROM c0
),
fm AS (SELECT page_2_model AS v, count(*) AS cnt FROM sel WHERE page_2_model IS NOT NULL GROUP BY 1),
fc AS (SELECT main_category AS v, count(*) AS cnt FROM sel WHERE main_category IS NOT NULL GROUP BY 1),
fo AS (SELECT colour AS v, count(*) AS cnt FROM sel WHERE colour IS NOT NULL GROUP BY 1),
tot AS (SELECT count(page_2_model) AS tm, count(main_category) AS tc, count(colour) AS tco FROM sel),
cl AS (
  SELECT c1.* EXCLUDE (new_page, new_model, new_category, new_colour, prev_price, prev_category),
    CAST(click_position = 1 AS INTEGER) AS is_first_click,
    CAST(click_position = n_clicks_observed AS INTEGER) AS is_last_observed_click,
    running_high_price_count / click_position AS running_high_price_share,
    coalesce(fc.cnt / tot.tc, 0.0) AS category_frequency,
    coalesce(fo.cnt / tot.tco, 0.0) AS colour_frequency,
    coalesce(fm.cnt / tot.tm, 0.0) AS model_frequency
  FROM c1 CROSS JOIN tot LEFT JOIN fm ON c1.page_2_model = fm.v LEFT JOIN fc ON c1.main_category = fc.v
  LEFT JOIN fo ON c1.colour = fo.v
)"""


def _cl_part(key, sid, cols):
    @register(key, sid, W + CLICK_LEVEL_BODY + "\nSELECT session_id, \"order\", " + ", ".join(cols) + " FROM cl")
    def q(spark, sf):
        return windows.click_level_features(raw_clicks(spark, sf, first_n=5), 5).select("session_id", "order", *cols)
    return q


_cl_part("click_position", "F-09", ["click_position", "n_clicks_observed", "is_first_click", "is_last_observed_click"])
_cl_part("running_high_price", "F-10", ["running_high_price_count", "running_high_price_share"])
_cl_part("click_frequencies", "F-11", ["category_frequency", "colour_frequency", "model_frequency"])


@register("click_level_features", "F-13", W + CLICK_LEVEL_BODY + "\nSELECT * FROM cl")
def q_click_level_features(spark, sf):
    return windows.click_level_features(raw_clicks(spark, sf, first_n=5), 5)


FREQ_SQL = S.selected_cte(5) + """,
d AS (
  SELECT 'model_freq' AS dim, page_2_model AS value FROM sel
  UNION ALL SELECT 'category_freq', main_category FROM sel
  UNION ALL SELECT 'colour_freq', CAST(colour AS VARCHAR) FROM sel
),
c AS (SELECT dim, value, count(*) AS cnt FROM d WHERE value IS NOT NULL GROUP BY dim, value),
ft AS (SELECT dim, value, cnt, CAST(sum(cnt) OVER (PARTITION BY dim) AS BIGINT) AS total FROM c)"""


@register("frequency_table", "A-16", W + FREQ_SQL + "\nSELECT dim, value, cnt, total, cnt / total AS freq FROM ft")
def q_frequency_table(spark, sf):
    return frequency_table(prepared(spark, sf, 5), 5)


@register("map_frequency", "D-08", W + FREQ_SQL + """
SELECT s.session_id, s."order", s.page_2_model, coalesce(ft.cnt / ft.total, 0.0) AS model_frequency
FROM clicks s LEFT JOIN ft ON ft.dim = 'model_freq' AND s.page_2_model = ft.value""")
def q_map_frequency(spark, sf):
    clicks = prepared(spark, sf)
    ft = frequency_table(clicks, 5).where(F.col("dim") == "model_freq")
    return map_frequency(clicks.select("session_id", "order", "page_2_model"), "page_2_model", ft, "model_frequency")
