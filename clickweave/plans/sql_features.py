"""DuckDB oracle SQL for the per-click and per-session feature operators.

Written independently of the Spark code from the operator definitions;
``clicks`` is the prepared click view from ``CLICKS_CTE``.
"""

from __future__ import annotations

import re

WS = 'PARTITION BY session_id ORDER BY "order"'
RUN = f'({WS} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)'


def selected_cte(n: int | None, source: str = "clicks") -> str:
    if n is None:
        return f",\nsel AS (SELECT * FROM {source})"
    return f""",
sel AS (SELECT * FROM {source} QUALIFY row_number() OVER ({WS}) <= {n})"""


def first_flag(col: str) -> str:
    return f'CASE WHEN row_number() OVER (PARTITION BY session_id, {col} ORDER BY "order") = 1 THEN 1 ELSE 0 END'


def changed(col: str, prev: str) -> str:
    return f"CASE WHEN click_position = 1 THEN 0 ELSE CAST(coalesce({col} <> {prev}, true) AS INTEGER) END"


ENRICH_CTE = f""",
enr0 AS (
  SELECT *,
    CAST(row_number() OVER ({WS}) AS INTEGER) AS click_position,
    count(*) OVER (PARTITION BY session_id) AS session_len,
    {first_flag('main_category')} AS new_category,
    {first_flag('page_2_model')} AS new_model,
    {first_flag('colour')} AS new_colour,
    {first_flag('page')} AS new_page,
    count(*) OVER (PARTITION BY session_id, main_category) AS cat_cnt,
    count(main_category) OVER (PARTITION BY session_id) AS cat_nn,
    lag(price) OVER ({WS}) AS prev_price,
    lag(main_category) OVER ({WS}) AS prev_category,
    lag(colour) OVER ({WS}) AS prev_colour,
    lag(page_2_model) OVER ({WS}) AS prev_model,
    avg(price) OVER {RUN} AS cumul_mean_price
  FROM sel
),
enr AS (
  SELECT *,
    {changed('main_category', 'prev_category')} AS category_changed,
    {changed('colour', 'prev_colour')} AS colour_changed,
    {changed('page_2_model', 'prev_model')} AS model_changed,
    CASE WHEN click_position = 1 THEN 0.0 ELSE price - prev_price END AS price_diff,
    CAST(sign(CASE WHEN click_position = 1 THEN 0.0 ELSE price - prev_price END) AS INTEGER) AS price_direction,
    CAST(sum(new_category) OVER {RUN} AS INTEGER) AS cumul_unique_categories,
    CAST(sum(new_model) OVER {RUN} AS INTEGER) AS cumul_unique_models,
    CAST(sum(new_colour) OVER {RUN} AS INTEGER) AS cumul_unique_colours,
    price - cumul_mean_price AS price_vs_cumul_mean,
    1 - new_category AS is_category_revisit,
    1 - new_model AS is_model_revisit,
    1 - new_colour AS is_colour_revisit,
    CASE WHEN session_len > 1 THEN (click_position - 1) / (session_len - 1) ELSE 0.0 END AS click_position_norm
  FROM enr0
)"""

FREQ_CTE = """,
fm AS (SELECT page_2_model AS v, count(*) AS cnt FROM sel WHERE page_2_model IS NOT NULL GROUP BY 1),
fc AS (SELECT main_category AS v, count(*) AS cnt FROM sel WHERE main_category IS NOT NULL GROUP BY 1),
fo AS (SELECT colour AS v, count(*) AS cnt FROM sel WHERE colour IS NOT NULL GROUP BY 1),
tot AS (SELECT count(page_2_model) AS tm, count(main_category) AS tc, count(colour) AS tco FROM sel),
fx AS (
  SELECT e.*, coalesce(fm.cnt, 0) AS model_cnt, coalesce(fc.cnt, 0) AS category_cnt, coalesce(fo.cnt, 0) AS colour_cnt
  FROM enr e LEFT JOIN fm ON e.page_2_model = fm.v LEFT JOIN fc ON e.main_category = fc.v
  LEFT JOIN fo ON e.colour = fo.v
)"""


def std(x: str) -> str:
    n = f"count({x})"
    return (f"CASE WHEN {n} > 1 THEN sqrt(greatest(({n} * sum({x} * {x}) - sum({x}) * sum({x})) "
            f"/ ({n} * ({n} - 1)), 0.0)) ELSE 0.0 END")


def base_aggregates(round_unstable: bool = True) -> str:
    ent = ("CASE WHEN count(main_category) > 0 THEN 0.0 - sum(CASE WHEN main_category IS NOT NULL "
           "THEN log2(cat_cnt / cat_nn) END) / count(main_category) ELSE 0.0 END")
    if round_unstable:
        ent = f"round({ent}, 6)"
    shares = ",\n  ".join(
        f"count_if(main_category = '{c}') / count(main_category) AS category_share_{c}"
        for c in ["blouses", "sale", "skirts", "trousers"])
    return f"""
  count("order") AS n_clicks_observed,
  CAST(sum(CASE WHEN page IS NOT NULL THEN new_page ELSE 0 END) AS BIGINT) AS n_unique_pages,
  CAST(sum(CASE WHEN page_2_model IS NOT NULL THEN new_model ELSE 0 END) AS BIGINT) AS n_unique_models,
  CAST(sum(CASE WHEN main_category IS NOT NULL THEN new_category ELSE 0 END) AS BIGINT) AS n_unique_categories,
  CAST(sum(CASE WHEN colour IS NOT NULL THEN new_colour ELSE 0 END) AS BIGINT) AS n_unique_colours,
  avg(price) AS price_mean,
  min(price) AS price_min,
  max(price) AS price_max,
  {std('price')} AS price_std,
  avg(higher_than_average) AS high_price_share_first_n,
  CAST(sum(higher_than_average) AS BIGINT) AS high_price_count_first_n,
  {ent} AS category_entropy,
  {shares},
  coalesce(max(CASE WHEN main_category IS NOT NULL THEN cat_cnt END) / count(main_category), 0.0) AS top_category_share,
  sum(model_cnt) / (max(tm) * count("order")) AS mean_model_frequency,
  max(model_cnt) / max(tm) AS max_model_frequency,
  min(model_cnt) / max(tm) AS min_model_frequency,
  arg_max_null(page, click_position) AS last_page,
  arg_max_null(location, click_position) AS last_location,
  arg_min_null(model_cnt, click_position) / max(tm) AS first_model_frequency,
  arg_max_null(model_cnt, click_position) / max(tm) AS last_model_frequency,
  arg_max_null(category_cnt, click_position) / max(tc) AS last_category_frequency,
  arg_max_null(colour_cnt, click_position) / max(tco) AS last_colour_frequency,
  CAST(sum(category_changed) AS BIGINT) AS category_transition_count"""


def sequential_aggregates(round_unstable: bool = True) -> str:
    dev = "avg(price_vs_cumul_mean)"
    if round_unstable:
        dev = f"round({dev}, 6)"
    return f""",
  avg(category_changed) AS category_switch_rate,
  avg(colour_changed) AS colour_switch_rate,
  avg(model_changed) AS model_switch_rate,
  avg(price_diff) AS mean_price_diff,
  {std('price_diff')} AS std_price_diff,
  {dev} AS mean_price_deviation,
  avg(is_category_revisit) AS category_revisit_rate,
  avg(is_model_revisit) AS model_revisit_rate,
  avg(is_colour_revisit) AS colour_revisit_rate,
  max(abs(price_diff)) AS max_abs_price_diff,
  CAST(count_if(price_direction > 0) AS BIGINT) AS n_price_increases,
  CAST(count_if(price_direction < 0) AS BIGINT) AS n_price_decreases,
  CASE WHEN max(cumul_unique_categories) > 0 THEN avg(cumul_unique_categories) / max(cumul_unique_categories) ELSE 0.0 END AS exploration_velocity_categories,
  CASE WHEN max(cumul_unique_models) > 0 THEN avg(cumul_unique_models) / max(cumul_unique_models) ELSE 0.0 END AS exploration_velocity_models"""


def session_features_body(n: int | None = 5, mode: str = "first_n", source: str = "clicks",
                          columns: list[str] | None = None, round_unstable: bool = True) -> str:
    """Body (after the shared CTEs) computing G-12 (first_n) or G-13 (full)."""
    aggs = base_aggregates(round_unstable) + (sequential_aggregates(round_unstable) if mode == "first_n" else "")
    select = f"""
SELECT session_id,{aggs}
FROM fx CROSS JOIN tot
GROUP BY session_id"""
    body = selected_cte(n if mode == "first_n" else None, source) + ENRICH_CTE + FREQ_CTE
    if columns is None:
        return body + select
    return body + ",\nfeat AS (" + select + "\n)\nSELECT session_id, " + ", ".join(columns) + " FROM feat"


def features_cte(name: str = "feat", n: int | None = None, mode: str = "full_session") -> str:
    """``, <name> AS (...)`` holding unrounded session features (sel/enr/fx
    CTE names are suffixed so two feature CTEs can coexist)."""
    body = session_features_body(n, mode, round_unstable=False)
    sfx = "_" + name
    for cte in ("sel", "enr0", "enr", "fm", "fc", "fo", "tot", "fx"):
        body = re.sub(rf"\b{cte}\b", cte + sfx, body)
    head, select = body.split("\nSELECT session_id,", 1)
    return head + f",\n{name} AS (\nSELECT session_id," + select + "\n)"
