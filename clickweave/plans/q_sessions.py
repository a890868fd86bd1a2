"""Registered queries: cleaning (B), first-N and window features (E-01, F),
session aggregations (G). Each reads the full driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.operators import clean, features, windows
from clickweave.operators.frequencies import frequency_table
from clickweave.plans import sql_features as S
from clickweave.plans.registry import clicks_sql, events_sql, register
from clickweave.sources.tables import event_clicks, raw_clicks

UNSTABLE = ("category_entropy", "mean_price_deviation")


def prepared(spark: SparkSession, sf_dir: str, first_n: int | None = None) -> DataFrame:
    return clean.prepare_clickstream(raw_clicks(spark, sf_dir, first_n))


def round_unstable(df: DataFrame, cols=UNSTABLE, digits: int = 6) -> DataFrame:
    """Round doubles whose last bits depend on summation order (both sides)."""
    return df.select(*[F.round(F.col(c), digits).alias(c) if c in cols else F.col(c) for c in df.columns])


# ---- flagship and its parts --------------------------------------------------

@register("session_features_first_n", "G-12", clicks_sql(S.session_features_body(5, "first_n")))
def q_session_features_first_n(spark, sf_dir):
    return round_unstable(features.build_session_features(raw_clicks(spark, sf_dir, first_n=5), 5, "first_n"))


@register("session_features_full", "G-13", clicks_sql(S.session_features_body(None, "full_session")))
def q_session_features_full(spark, sf_dir):
    return round_unstable(features.build_session_features(raw_clicks(spark, sf_dir), 5, "full_session"))


def _part(key, sid, fn, cols):
    @register(key, sid, clicks_sql(S.session_features_body(5, "first_n", columns=cols)))
    def q(spark, sf_dir):
        return round_unstable(fn(features.build_session_features(raw_clicks(spark, sf_dir, first_n=5), 5, "first_n")))
    return q


_part("session_counts", "G-01", features.session_counts,
      ["n_clicks_observed", "n_unique_pages", "n_unique_models", "n_unique_categories", "n_unique_colours"])
_part("session_price_stats", "G-02", features.session_price_stats,
      ["price_mean", "price_min", "price_max", "price_std"])
_part("session_high_price", "G-03", features.session_high_price,
      ["high_price_share_first_n", "high_price_count_first_n"])
_part("category_entropy", "G-04", features.category_entropy, ["category_entropy"])
_part("category_shares", "G-05", features.category_shares,
      ["category_share_blouses", "category_share_sale", "category_share_skirts", "category_share_trousers",
       "top_category_share"])
_part("model_frequency_stats", "G-06", features.model_frequency_stats,
      ["mean_model_frequency", "max_model_frequency", "min_model_frequency"])
_part("boundary_features", "G-07", features.boundary_features,
      ["last_page", "last_location", "first_model_frequency", "last_model_frequency",
       "last_category_frequency", "last_colour_frequency"])
_part("category_transitions", "G-08", features.category_transitions, ["category_transition_count"])
_part("switch_revisit_rates", "G-09", features.switch_revisit_rates,
      ["category_switch_rate", "colour_switch_rate", "model_switch_rate", "category_revisit_rate",
       "model_revisit_rate", "colour_revisit_rate"])
_part("price_movement", "G-10", features.price_movement,
      ["mean_price_diff", "std_price_diff", "max_abs_price_diff", "n_price_increases", "n_price_decreases",
       "mean_price_deviation"])
_part("exploration_velocity", "G-11", features.exploration_velocity,
      ["exploration_velocity_categories", "exploration_velocity_models"])
