"""Helpers shared by the registered queries and their SQL twins.

Floating results are compared after a cast to single precision on both sides:
engines sum in different orders, so doubles can differ in the last bits, and a
relative (float32) grid is robust for money-sized and unit-sized values alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.schema import CONTEXT_COLS

# double-typed columns of the impression view
BRIDGE_DOUBLES = {
    "visitor_hist_starrating",
    "visitor_hist_adr_usd",
    "prop_review_score",
    "prop_location_score1",
    "prop_location_score2",
    "prop_log_historical_price",
    "price_usd",
    "srch_query_affinity_score",
    "orig_destination_distance",
    "gross_bookings_usd",
} | {f"comp{i}_rate_percent_diff" for i in range(1, 9)}

FEATURE_DOUBLES = {
    "price_rank_within_search",
    "value_for_money_score",
    "booking_window_weeks",
    "price_deviation_from_search_avg",
    "price_ratio_to_search_avg",
    "starrating_deviation_from_search_avg",
    "price_deviation_from_prop_hist_avg",
    "price_ratio_to_prop_hist_avg",
    "normalized_price_in_search",
}


def is_double(name: str) -> bool:
    if name in BRIDGE_DOUBLES or name in FEATURE_DOUBLES:
        return True
    for p in ("avg_", "stddev_", "median_"):
        if name.startswith(p):
            return True
    for p in ("min_", "max_"):
        if name.startswith(p):
            base = name[len(p):].replace("_in_search", "")
            return base in BRIDGE_DOUBLES
    return False


def norm_df(df: DataFrame, doubles=None) -> DataFrame:
    """Cast the double columns (by name rule or explicit set) to float."""
    dset = set(doubles) if doubles is not None else {c for c in df.columns if is_double(c)}
    return df.select(*[F.col(c).cast("float").alias(c) if c in dset else F.col(c) for c in df.columns])


def norm_sql(cols: list[str], doubles=None) -> str:
    dset = set(doubles) if doubles is not None else {c for c in cols if is_double(c)}
    return ", ".join(f"CAST({c} AS FLOAT) AS {c}" if c in dset else c for c in cols)


__all__ = ["CONTEXT_COLS", "is_double", "norm_df", "norm_sql"]
