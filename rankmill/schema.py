"""Schema of a search-impression log and the fixed column lists.

The names below are fixed values: they must equal the data dictionary of the
hotel-search log so that a user's files load unchanged.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: key, label and column names of the impression log ----
GROUP_COL = "srch_id"
ITEM_COL = "prop_id"
LABEL_COL = "relevance"
CLICK_COL = "click_bool"
BOOKING_COL = "booking_bool"

TRAIN_ONLY_COLS = ["position", "click_bool", "booking_bool", "gross_bookings_usd"]

# Features averaged / std / median per hotel (first eight) and per search (all ten).
CONTEXT_COLS = [
    "price_usd",
    "prop_starrating",
    "prop_review_score",
    "prop_location_score1",
    "prop_location_score2",
    "prop_log_historical_price",
    "srch_query_affinity_score",
    "promotion_flag",
    "prop_brand_bool",
    "orig_destination_distance",
]
PROP_COLS = CONTEXT_COLS[:8]

# Columns never used as model features (both spellings of the booking value).
EXCLUDED_FEATURE_COLS = [
    "click_bool",
    "booking_bool",
    "gross_bookings_usd",
    "gross_booking_usd",
    "position",
    "date_time",
    "srch_id",
    "relevance",
]

# Categorical candidates handed to the ranker.
CATEGORICAL_COLS = [
    "site_id",
    "visitor_location_country_id",
    "prop_country_id",
    "prop_brand_bool",
    "promotion_flag",
    "srch_destination_id",
    "srch_saturday_night_bool",
    "random_bool",
    "prop_starrating",
    "prop_review_score",
    "search_hour_of_day",
    "search_day_of_week",
    "search_month",
    "is_weekend_search",
] + [f"comp{i}_{s}" for i in range(1, 9) for s in ("rate", "inv")]
# ---- end of fixed values ----


def _competitor_fields() -> list[T.StructField]:
    out = []
    for i in range(1, 9):
        out += [
            T.StructField(f"comp{i}_rate", T.IntegerType()),
            T.StructField(f"comp{i}_inv", T.IntegerType()),
            T.StructField(f"comp{i}_rate_percent_diff", T.DoubleType()),
        ]
    return out


def impression_schema(train: bool = True) -> T.StructType:
    """Explicit schema of the log (54 columns for train, 50 for test)."""
    i, d, l = T.IntegerType(), T.DoubleType(), T.LongType()
    fields = [
        T.StructField("srch_id", l),
        T.StructField("date_time", T.TimestampType()),
        T.StructField("site_id", i),
        T.StructField("visitor_location_country_id", i),
        T.StructField("visitor_hist_starrating", d),
        T.StructField("visitor_hist_adr_usd", d),
        T.StructField("prop_country_id", i),
        T.StructField("prop_id", l),
        T.StructField("prop_starrating", i),
        T.StructField("prop_review_score", d),
        T.StructField("prop_brand_bool", i),
        T.StructField("prop_location_score1", d),
        T.StructField("prop_location_score2", d),
        T.StructField("prop_log_historical_price", d),
        T.StructField("price_usd", d),
        T.StructField("promotion_flag", i),
        T.StructField("srch_destination_id", i),
        T.StructField("srch_length_of_stay", i),
        T.StructField("srch_booking_window", i),
        T.StructField("srch_adults_count", i),
        T.StructField("srch_children_count", i),
        T.StructField("srch_room_count", i),
        T.StructField("srch_saturday_night_bool", i),
        T.StructField("srch_query_affinity_score", d),
        T.StructField("orig_destination_distance", d),
        T.StructField("random_bool", i),
    ] + _competitor_fields()
    if train:
        fields += [
            T.StructField("position", i),
            T.StructField("click_bool", i),
            T.StructField("booking_bool", i),
            T.StructField("gross_bookings_usd", d),
        ]
    return T.StructType(fields)
