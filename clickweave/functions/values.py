"""Fixed value dictionaries of the click data set and label vocabularies.

These values must equal the source data set's code books for decoded output
to be right; they are stated here as plain data.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: code books of the click data set -------------------------
COUNTRIES = {
    1: "Australia", 2: "Austria", 3: "Belgium", 4: "British Virgin Islands",
    5: "Cayman Islands", 6: "Christmas Island", 7: "Croatia", 8: "Cyprus",
    9: "Czech Republic", 10: "Denmark", 11: "Estonia", 12: "unidentified",
    13: "Faroe Islands", 14: "Finland", 15: "France", 16: "Germany",
    17: "Greece", 18: "Hungary", 19: "Iceland", 20: "India", 21: "Ireland",
    22: "Italy", 23: "Latvia", 24: "Lithuania", 25: "Luxembourg", 26: "Mexico",
    27: "Netherlands", 28: "Norway", 29: "Poland", 30: "Portugal",
    31: "Romania", 32: "Russia", 33: "San Marino", 34: "Slovakia",
    35: "Slovenia", 36: "Spain", 37: "Sweden", 38: "Switzerland",
    39: "Ukraine", 40: "United Arab Emirates", 41: "United Kingdom", 42: "USA",
    43: "biz (*.biz)", 44: "com (*.com)", 45: "int (*.int)", 46: "net (*.net)",
    47: "org (*.org)",
}
CATEGORIES = {1: "trousers", 2: "skirts", 3: "blouses", 4: "sale"}
COLOURS = {
    1: "beige", 2: "black", 3: "blue", 4: "brown", 5: "burgundy", 6: "gray",
    7: "green", 8: "navy blue", 9: "of many colors", 10: "olive", 11: "pink",
    12: "red", 13: "violet", 14: "white",
}
LOCATIONS = {
    1: "top left", 2: "top in the middle", 3: "top right", 4: "bottom left",
    5: "bottom in the middle", 6: "bottom right",
}
PHOTOGRAPHY = {1: "en face", 2: "profile"}
PRICE_2_TO_HIGH = {1: 1, 2: 0}
# Category share columns are a fixed list (sorted names), absent share = 0.0.
CATEGORY_SHARE_NAMES = ["blouses", "sale", "skirts", "trousers"]
# Prediction class id -> label text.
PREDICTION_LABELS = {0: "low-intent", 1: "high-intent"}
# Training-label vocabulary: text forms accepted for 0 and 1.
LOW_INTENT_TEXT = ["low-intent", "low_intent", "low intent", "0"]
HIGH_INTENT_TEXT = ["high-intent", "high_intent", "high intent", "1"]
# Labels a cluster may carry in the labelling step.
ALLOWED_CLUSTER_LABELS = ["low-intent", "high-intent"]
# Cluster-feature whitelist, in walk order for correlation pruning.
CLUSTER_FEATURES = [
    "n_clicks_observed", "n_unique_pages", "n_unique_models", "n_unique_categories",
    "n_unique_colours", "price_mean", "price_min", "price_max", "price_std",
    "high_price_share_first_n", "high_price_count_first_n", "category_entropy",
    "category_share_blouses", "category_share_sale", "category_share_skirts",
    "category_share_trousers", "top_category_share", "mean_model_frequency",
    "max_model_frequency", "min_model_frequency", "last_page", "last_location",
    "first_model_frequency", "last_model_frequency", "last_category_frequency",
    "last_colour_frequency", "category_transition_count",
]
CLUSTER_EXCLUDED = ["session_id", "purchase_flag", "revenue"]
DEFAULT_K = 8
DEFAULT_CORRELATION_THRESHOLD = 0.7
DEFAULT_MIN_VARIANCE = 1e-8
# -----------------------------------------------------------------------------


def map_literal(mapping: dict) -> Column:
    """A literal MAP column; ``map_literal(d)[col]`` is null for unknown keys."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def decode(col: Column | str, mapping: dict) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return map_literal(mapping)[c]


def sql_case(expr: str, mapping: dict, quote_values: bool = True) -> str:
    """The same lookup as SQL text (used by the DuckDB oracle strings)."""
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v) if quote_values else v}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} END)"

# ---- fixed values: published cluster -> intent label file (k = 8) -----------
CLUSTER_LABEL_MAP = {
    0: "low-intent", 1: "high-intent", 2: "high-intent", 3: "low-intent",
    4: "high-intent", 5: "low-intent", 6: "low-intent", 7: "low-intent",
}
# -----------------------------------------------------------------------------


def cluster_label_values_sql() -> str:
    rows = ", ".join(f"({k}, '{v}')" for k, v in CLUSTER_LABEL_MAP.items())
    return f"(VALUES {rows}) AS cl(cluster_id, intent_label)"
