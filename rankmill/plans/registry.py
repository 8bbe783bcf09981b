"""Registered queries: each maps to a Spark builder ``(spark, sf_dir) -> DataFrame``
and, when SQL can express it, a DuckDB twin over the same parquet tables.

All queries read the whole impression view derived from the given tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.operators.features import engineer_features, price_rank, prop_table, row_features
from rankmill.operators.impute import handle_missing_values
from rankmill.plans.oracle import norm_df, norm_sql
from rankmill.schema import CONTEXT_COLS, PROP_COLS
from rankmill.operators import groupstats as G
from rankmill.session import shuffles_freed
from rankmill.sources import bridge
from rankmill.sources.bridge import bridge_sql, impressions, oracle_cte, read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _imp(spark, sf, deal="srch_id"):
    return handle_missing_values(impressions(spark, sf, deal))[0]


# --------------------------------------------------------------- SQL pieces
IMP_CTE = (
    ", imp AS (SELECT * REPLACE (COALESCE(prop_review_score, 0.0) AS prop_review_score, "
    "COALESCE(srch_query_affinity_score, (SELECT min(srch_query_affinity_score) FROM impressions) - 100.0) "
    "AS srch_query_affinity_score) FROM impressions)\n"
)


def _row_feature_sql() -> list[str]:
    return [
        "CASE WHEN price_usd IS NOT NULL THEN rank() OVER (PARTITION BY srch_id ORDER BY price_usd ASC NULLS LAST) "
        "+ (count(price_usd) OVER (PARTITION BY srch_id, price_usd) - 1) / 2.0 END AS price_rank_within_search",
        "COALESCE(CASE WHEN price_usd > 0 THEN prop_review_score / price_usd "
        "WHEN price_usd = 0 AND prop_review_score > 0 THEN 100.0 ELSE 0.0 END, 0.0) AS value_for_money_score",
        "COALESCE(CAST(visitor_location_country_id = prop_country_id AS INTEGER), 0) AS is_domestic_travel",
        "CAST(hour(date_time) AS INTEGER) AS search_hour_of_day",
        "CAST(isodow(date_time) - 1 AS INTEGER) AS search_day_of_week",
        "CAST(month(date_time) AS INTEGER) AS search_month",
        "CASE WHEN isodow(date_time) >= 6 THEN 1 ELSE 0 END AS is_weekend_search",
        "CAST(round_even(srch_booking_window / 7.0, 0) AS DOUBLE) AS booking_window_weeks",
        "CASE WHEN visitor_hist_starrating IS NOT NULL OR visitor_hist_adr_usd IS NOT NULL THEN 1 ELSE 0 END "
        "AS is_recurring_customer",
    ]


def _key_feature_sql(full: bool) -> list[str]:
    out = []
    for c in PROP_COLS:
        out.append(f"avg({c}) OVER (PARTITION BY prop_id) AS avg_{c}_for_prop")
    for c in PROP_COLS:
        out.append(f"COALESCE(stddev_samp({c}) OVER (PARTITION BY prop_id), 0.0) AS stddev_{c}_for_prop")
    for c in PROP_COLS:
        out.append(f"median(CAST({c} AS DOUBLE)) OVER (PARTITION BY prop_id) AS median_{c}_for_prop")
    out.append("count(*) OVER (PARTITION BY srch_id) AS num_options_in_search")
    for c in CONTEXT_COLS:
        out.append(f"avg({c}) OVER (PARTITION BY srch_id) AS avg_{c}_in_search")
    for c in CONTEXT_COLS:
        out.append(f"COALESCE(stddev_samp({c}) OVER (PARTITION BY srch_id), 0.0) AS stddev_{c}_in_search")
    for c in CONTEXT_COLS:
        out.append(f"median(CAST({c} AS DOUBLE)) OVER (PARTITION BY srch_id) AS median_{c}_in_search")
    if full:
        for c in CONTEXT_COLS:
            out.append(f"min({c}) OVER (PARTITION BY srch_id) AS min_{c}_in_search")
        for c in CONTEXT_COLS:
            out.append(f"max({c}) OVER (PARTITION BY srch_id) AS max_{c}_in_search")
    return out


def _relative_sql(full: bool) -> list[str]:
    out = [
        "price_usd - avg_price_usd_in_search AS price_deviation_from_search_avg",
        "CASE WHEN avg_price_usd_in_search <> 0 THEN price_usd / avg_price_usd_in_search END AS price_ratio_to_search_avg",
        "prop_starrating - avg_prop_starrating_in_search AS starrating_deviation_from_search_avg",
        "price_usd - avg_price_usd_for_prop AS price_deviation_from_prop_hist_avg",
        "CASE WHEN avg_price_usd_for_prop <> 0 THEN price_usd / avg_price_usd_for_prop END AS price_ratio_to_prop_hist_avg",
    ]
    if full:
        out.append(
            "CASE WHEN max_price_usd_in_search - min_price_usd_in_search <> 0 THEN (price_usd - min_price_usd_in_search) "
            "/ (max_price_usd_in_search - min_price_usd_in_search) ELSE 0.5 END AS normalized_price_in_search"
        )
    return out


def _alias(e: str) -> str:
    return e.rsplit(" AS ", 1)[1].strip()


def _features_sql(full: bool, base_cols: list[str]) -> str:
    rowf = _row_feature_sql()
    keyf = _key_feature_sql(full)
    rel = _relative_sql(full)
    out_cols = base_cols + [_alias(e) for e in rowf + keyf + rel]
    return (
        oracle_cte()
        + IMP_CTE
        + ", f AS (SELECT *, "
        + ", ".join(rowf + keyf)
        + " FROM imp)\n, g AS (SELECT *, "
        + ", ".join(rel)
        + " FROM f)\nSELECT "
        + norm_sql(out_cols)
        + " FROM g"
    )


def _bridge_cols() -> list[str]:
    return re.findall(r" AS ([a-z0-9_]+)(?:,|\n)", bridge_sql().split("FROM")[0])


BASE = _bridge_cols()


# ------------------------------------------------------------------ features
@register(
    "k01_price_rank",
    oracle_cte()
    + "SELECT srch_id, prop_id, CAST(price_usd AS FLOAT) AS price_usd, CAST(CASE WHEN price_usd IS NOT NULL THEN "
    "rank() OVER (PARTITION BY srch_id ORDER BY price_usd ASC NULLS LAST) + (count(price_usd) OVER "
    "(PARTITION BY srch_id, price_usd) - 1) / 2.0 END AS FLOAT) AS price_rank_within_search FROM impressions",
)
def q_k01(spark, sf):
    df = price_rank(impressions(spark, sf))
    return norm_df(df.select("srch_id", "prop_id", "price_usd", "price_rank_within_search"))


_ROWF = [_alias(e) for e in _row_feature_sql()[1:]]


@register(
    "k02_row_features",
    oracle_cte()
    + IMP_CTE
    + ", f AS (SELECT srch_id, prop_id, "
    + ", ".join(_row_feature_sql()[1:])
    + " FROM imp)\nSELECT srch_id, prop_id, "
    + norm_sql(_ROWF)
    + " FROM f",
)
def q_k02(spark, sf):
    df = row_features(_imp(spark, sf))
    return norm_df(df.select("srch_id", "prop_id", *_ROWF))


_PROP_OUT = (
    [f"avg_{c}_for_prop" for c in PROP_COLS]
    + [f"stddev_{c}_for_prop" for c in PROP_COLS]
    + [f"median_{c}_for_prop" for c in PROP_COLS]
)


@register(
    "k10_prop_stats",
    oracle_cte()
    + IMP_CTE
    + "SELECT prop_id, "
    + norm_sql(_PROP_OUT)
    + " FROM (SELECT prop_id, "
    + ", ".join(
        [f"avg({c}) AS avg_{c}_for_prop" for c in PROP_COLS]
        + [f"COALESCE(stddev_samp({c}), 0.0) AS stddev_{c}_for_prop" for c in PROP_COLS]
        + [f"median(CAST({c} AS DOUBLE)) AS median_{c}_for_prop" for c in PROP_COLS]
    )
    + " FROM imp GROUP BY prop_id)",
)
def q_k10(spark, sf):
    return norm_df(prop_table(_imp(spark, sf)).select("prop_id", *_PROP_OUT))


_SEARCH_OUT = (
    ["num_options_in_search"]
    + [f"avg_{c}_in_search" for c in CONTEXT_COLS]
    + [f"stddev_{c}_in_search" for c in CONTEXT_COLS]
    + [f"median_{c}_in_search" for c in CONTEXT_COLS]
    + [f"min_{c}_in_search" for c in CONTEXT_COLS]
    + [f"max_{c}_in_search" for c in CONTEXT_COLS]
)


@register(
    "k13_search_stats",
    oracle_cte()
    + IMP_CTE
    + "SELECT srch_id, "
    + norm_sql(_SEARCH_OUT)
    + " FROM (SELECT srch_id, count(*) AS num_options_in_search, "
    + ", ".join(
        [f"avg({c}) AS avg_{c}_in_search" for c in CONTEXT_COLS]
        + [f"COALESCE(stddev_samp({c}), 0.0) AS stddev_{c}_in_search" for c in CONTEXT_COLS]
        + [f"median(CAST({c} AS DOUBLE)) AS median_{c}_in_search" for c in CONTEXT_COLS]
        + [f"min({c}) AS min_{c}_in_search" for c in CONTEXT_COLS]
        + [f"max({c}) AS max_{c}_in_search" for c in CONTEXT_COLS]
    )
    + " FROM imp GROUP BY srch_id)",
)
def q_k13(spark, sf):
    imp = _imp(spark, sf)
    specs = [("num_options_in_search", "size", None)]
    for fn, p in (("avg", "avg"), ("std", "stddev"), ("min", "min"), ("max", "max")):
        specs += [(f"{p}_{c}_in_search", fn, c) for c in CONTEXT_COLS]
    medians = [(f"median_{c}_in_search", c) for c in CONTEXT_COLS]
    table = G.key_table(imp, "srch_id", specs, medians, dealt=True)
    # a median of negative zeros is zero
    return norm_df(table.withColumns({m: F.col(m) + F.lit(0.0) for m, _ in medians}).select("srch_id", *_SEARCH_OUT))


@register("k26_imputation", oracle_cte() + IMP_CTE + "SELECT " + norm_sql(BASE) + " FROM imp")
def q_k26(spark, sf):
    return norm_df(_imp(spark, sf).select(*BASE))


_DEFAULT_SQL = _features_sql(False, BASE)
_FULL_SQL = _features_sql(True, BASE)


def _log_features(spark, sf, profile: str):
    lines = read_table(spark, sf, "lineitem").count()
    if lines <= bridge.COUNTED_ROWS:
        return engineer_features(_imp(spark, sf, "prop_id"), profile)
    with shuffles_freed(spark):
        imp = _imp(spark, sf, "prop_id")
    return engineer_features(imp, profile, long_rows=lines)


@register("k27_features_default", _DEFAULT_SQL)
def q_k27(spark, sf):
    return norm_df(_log_features(spark, sf, "default"))


@register("k27_features_full", _FULL_SQL)
def q_k27_full(spark, sf):
    return norm_df(_log_features(spark, sf, "full"))


# ------------------------------------------------------------------ ranking
from rankmill.operators import ranking as R  # noqa: E402

_REL_SQL = "CASE WHEN booking_bool = 1 THEN 5 WHEN click_bool = 1 THEN 1 ELSE 0 END"
_SCORED_CTE = (
    ", s AS (SELECT srch_id, prop_id, position, -price_usd AS score, "
    + _REL_SQL
    + " AS relevance FROM impressions)\n"
    ", r AS (SELECT *, row_number() OVER (PARTITION BY srch_id ORDER BY score DESC NULLS LAST, prop_id ASC NULLS LAST, "
    "position ASC NULLS LAST, relevance ASC) AS p, row_number() OVER (PARTITION BY srch_id ORDER BY relevance DESC) AS ip FROM s)\n"
    ", d AS (SELECT srch_id, sum(CASE WHEN p <= 5 THEN (pow(2.0, relevance) - 1.0) / log2(p + 1.0) END) AS dcg, "
    "sum(CASE WHEN ip <= 5 THEN (pow(2.0, relevance) - 1.0) / log2(ip + 1.0) END) AS idcg FROM r GROUP BY srch_id)\n"
)


def _price_scored(spark, sf):
    return R.add_relevance(impressions(spark, sf)).withColumn("score", -F.col("price_usd"))


@register("k24_relevance", oracle_cte() + "SELECT srch_id, prop_id, position, " + _REL_SQL + " AS relevance FROM impressions")
def q_k24(spark, sf):
    return R.add_relevance(impressions(spark, sf)).select("srch_id", "prop_id", "position", "relevance")


@register(
    "m09_ndcg_per_search",
    oracle_cte()
    + _SCORED_CTE
    + "SELECT srch_id, CAST(dcg AS FLOAT) AS dcg, CAST(idcg AS FLOAT) AS idcg, "
    "CAST(CASE WHEN idcg > 0 THEN dcg / idcg ELSE 1.0 END AS FLOAT) AS ndcg FROM d",
)
def q_m09_per(spark, sf):
    per = R.ndcg_per_group(_price_scored(spark, sf), "score", tiebreak=("prop_id", "position"))
    return norm_df(per, ["dcg", "idcg", "ndcg"])


@register(
    "m09_ndcg_at_5",
    oracle_cte()
    + _SCORED_CTE
    + "SELECT CAST(avg(CASE WHEN idcg > 0 THEN dcg / idcg ELSE 1.0 END) AS FLOAT) AS ndcg_at_5, count(*) AS num_groups FROM d",
)
def q_m09(spark, sf):
    out = R.mean_ndcg(_price_scored(spark, sf), "score", tiebreak=("prop_id", "position"))
    return norm_df(out, ["ndcg_at_5"])


@register(
    "m09_ndcg_at_5_skip_empty",
    oracle_cte()
    + _SCORED_CTE
    + "SELECT CAST(avg(dcg / idcg) AS FLOAT) AS ndcg_at_5, count(*) AS num_groups FROM d WHERE idcg > 0",
)
def q_m09_skip(spark, sf):
    out = R.mean_ndcg(_price_scored(spark, sf), "score", tiebreak=("prop_id", "position"), empty_group="skip")
    return norm_df(out, ["ndcg_at_5"])


@register(
    "m07_submission",
    oracle_cte()
    + "SELECT srch_id AS SearchId, prop_id AS PropertyId, row_number() OVER (PARTITION BY srch_id ORDER BY price_usd ASC NULLS LAST, "
    "prop_id ASC NULLS LAST) AS rank_in_search FROM impressions",
)
def q_m07(spark, sf):
    from pyspark.sql import Window

    listed = R.submission(impressions(spark, sf).withColumn("score", -F.col("price_usd")), "score")
    # the rank is read off the order in which submission() delivers the rows
    listed = listed.withColumn("_at", F.monotonically_increasing_id())
    return listed.withColumn("rank_in_search", F.row_number().over(Window.partitionBy("SearchId").orderBy("_at"))).drop("_at")


@register(
    "o09_dedupe_keys",
    oracle_cte()
    + "SELECT srch_id, prop_id, position, CAST(price_usd AS FLOAT) AS price_usd, click_bool FROM (SELECT srch_id, prop_id, position, "
    "price_usd, click_bool, row_number() OVER (PARTITION BY srch_id, prop_id ORDER BY position NULLS FIRST, price_usd NULLS FIRST, "
    "click_bool NULLS FIRST) AS rn FROM impressions) WHERE rn = 1",
)
def q_o09(spark, sf):
    df = impressions(spark, sf).select("srch_id", "prop_id", "position", "price_usd", "click_bool")
    return norm_df(R.dedupe_keys(df), ["price_usd"])


# ------------------------------------------------------ profiling / statistics
from rankmill.operators import binning as B  # noqa: E402
from rankmill.operators import profile as P  # noqa: E402
from rankmill.operators import stats as ST  # noqa: E402

W = oracle_cte()
NUMERIC = [c for c in BASE if c != "date_time"]


def _f(e: str, name: str) -> str:
    return f"CAST({e} AS FLOAT) AS {name}"


@register(
    "g01_click_rate_by_history",
    W + "SELECT visitor_hist_starrating IS NOT NULL AS has_history, " + _f("avg(click_bool)", "mean")
    + ", count(click_bool) AS count FROM impressions GROUP BY 1",
)
def q_g01(spark, sf):
    out = ST.rate_by(impressions(spark, sf), ("has_history", F.col("visitor_hist_starrating").isNotNull()), "click_bool")
    return norm_df(out, ["mean"])


@register(
    "g01_booking_rate_by_comp1_rate",
    W + "SELECT comp1_rate, " + _f("avg(booking_bool)", "mean")
    + ", count(booking_bool) AS count FROM impressions WHERE comp1_rate IS NOT NULL GROUP BY 1",
)
def q_g01b(spark, sf):
    df = impressions(spark, sf).where(F.col("comp1_rate").isNotNull())
    return norm_df(ST.rate_by(df, "comp1_rate", "booking_bool"), ["mean"])


_RECURRING_SQL = "CASE WHEN visitor_hist_starrating IS NOT NULL OR visitor_hist_adr_usd IS NOT NULL THEN 1 ELSE 0 END"


@register(
    "g02_booking_percent_by_recurring",
    W + f"SELECT {_RECURRING_SQL} AS is_recurring_customer, " + _f("avg(booking_bool) * 100.0", "rate_percent")
    + " FROM impressions GROUP BY 1",
)
def q_g02(spark, sf):
    df = row_features(impressions(spark, sf))
    return norm_df(ST.percent_by(df, "is_recurring_customer", "booking_bool"), ["rate_percent"])


@register("g03_group_sizes", W + "SELECT srch_id, count(*) AS size FROM impressions GROUP BY srch_id")
def q_g03(spark, sf):
    return ST.group_sizes(impressions(spark, sf), "srch_id")


@register(
    "g04_value_counts_destination",
    W + "SELECT srch_destination_id, count(*) AS count FROM impressions WHERE srch_destination_id IS NOT NULL GROUP BY 1",
)
def q_g04(spark, sf):
    return ST.value_counts(impressions(spark, sf), "srch_destination_id")


@register(
    "o05_top5_destinations",
    W + "SELECT srch_destination_id, count(*) AS count FROM impressions WHERE srch_destination_id IS NOT NULL "
    "GROUP BY 1 ORDER BY count DESC, srch_destination_id LIMIT 5",
)
def q_o05(spark, sf):
    return ST.value_counts(impressions(spark, sf), "srch_destination_id", top=5)


@register(
    "g05_value_shares_comp1_rate",
    W + "SELECT comp1_rate, " + _f("count(*) / (SELECT count(comp1_rate) FROM impressions)", "share")
    + " FROM impressions WHERE comp1_rate IS NOT NULL GROUP BY 1",
)
def q_g05(spark, sf):
    return norm_df(ST.value_shares(impressions(spark, sf), "comp1_rate"), ["share"])


_FAMILY = "COALESCE(srch_children_count, 0) > 0"


@register(
    "g06_brand_share_by_family",
    W + f", c AS (SELECT {_FAMILY} AS is_family_search, count(*) FILTER (WHERE prop_brand_bool = 0) AS n0, "
    "count(*) FILTER (WHERE prop_brand_bool = 1) AS n1 FROM impressions GROUP BY 1)\n"
    "SELECT is_family_search, " + _f("n0 * 100.0 / (n0 + n1)", "non_brand_percent") + ", "
    + _f("n1 * 100.0 / (n0 + n1)", "brand_percent") + " FROM c",
)
def q_g06(spark, sf):
    df = impressions(spark, sf)
    fam = ("is_family_search", F.coalesce(F.col("srch_children_count"), F.lit(0)) > 0)
    out = ST.share_pivot(df, fam, "prop_brand_bool", [0, 1], names={"0": "non_brand_percent", "1": "brand_percent"})
    return norm_df(out, ["non_brand_percent", "brand_percent"])


@register(
    "g07_crosstab_recurring_booking",
    W + f"SELECT {_RECURRING_SQL} AS is_recurring_customer, count(*) FILTER (WHERE booking_bool = 0) AS booking_bool_0, "
    "count(*) FILTER (WHERE booking_bool = 1) AS booking_bool_1 FROM impressions GROUP BY 1",
)
def q_g07(spark, sf):
    df = row_features(impressions(spark, sf))
    return ST.crosstab(df, "is_recurring_customer", "booking_bool", [0, 1])


@register(
    "g08_distinct_counts",
    W + "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values FROM impressions" for c in BASE) + ")",
)
def q_g08(spark, sf):
    return P.distinct_counts(impressions(spark, sf))


@register(
    "g09_duplicate_rows",
    W + "SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM impressions)) AS BIGINT) AS duplicates FROM impressions",
)
def q_g09(spark, sf):
    return P.duplicate_rows(impressions(spark, sf))


@register(
    "g10_missing_stats",
    W + "SELECT column_name, missing_values, " + _f("missing_values * 100.0 / n", "percentage") + " FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_values, count(*) AS n FROM impressions" for c in BASE)
    + ") WHERE missing_values > 0",
)
def q_g10(spark, sf):
    return norm_df(P.missing_stats(impressions(spark, sf)), ["percentage"])


@register("g11_shape", W + f"SELECT count(*) AS rows, {len(BASE)} AS columns FROM impressions")
def q_g11(spark, sf):
    return P.shape(impressions(spark, sf))


_DESCRIBE = ["price_usd", "prop_starrating", "prop_review_score", "visitor_hist_adr_usd", "orig_destination_distance", "prop_location_score2"]


@register(
    "g12_describe",
    W + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count({c}) AS count, {_f(f'avg({c})', 'mean')}, {_f(f'stddev_samp({c})', 'std')}, "
        f"{_f(f'min({c})', 'min')}, {_f(f'quantile_cont({c}, 0.25)', 'p25')}, {_f(f'quantile_cont({c}, 0.5)', 'p50')}, "
        f"{_f(f'quantile_cont({c}, 0.75)', 'p75')}, {_f(f'max({c})', 'max')} FROM impressions"
        for c in _DESCRIBE
    )
    + ")",
)
def q_g12(spark, sf):
    out = P.describe(impressions(spark, sf), _DESCRIBE)
    return norm_df(out, ["mean", "std", "min", "p25", "p50", "p75", "max"])


@register(
    "g14_price_above_p95",
    W + ", q AS (SELECT quantile_cont(price_usd, 0.95) AS t FROM impressions)\n"
    "SELECT " + _f("t", "threshold") + ", count(*) FILTER (WHERE price_usd > t) AS count_above, "
    + _f("count(*) FILTER (WHERE price_usd > t) * 100.0 / count(*)", "percent_above") + " FROM impressions, q GROUP BY t",
)
def q_g14(spark, sf):
    return norm_df(ST.above_quantile(impressions(spark, sf), "price_usd", 0.95), ["threshold", "percent_above"])


@register(
    "g15_destination_country_match",
    W + "SELECT " + _f("avg(CASE WHEN COALESCE(srch_destination_id = prop_country_id, false) THEN 1.0 ELSE 0.0 END) * 100.0", "match_percent")
    + " FROM impressions",
)
def q_g15(spark, sf):
    return norm_df(ST.match_share(impressions(spark, sf), "srch_destination_id", "prop_country_id"), ["match_percent"])


def _pearson_sql(a: str, b: str) -> str:
    both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    xa, xb = f"CASE WHEN {both} THEN CAST({a} AS DOUBLE) END", f"CASE WHEN {both} THEN CAST({b} AS DOUBLE) END"
    den = f"(stddev_samp({xa}) * stddev_samp({xb}))"
    return f"CASE WHEN {den} <> 0 THEN covar_samp({xa}, {xb}) / {den} END"


@register("g16_corr_stay_window", W + "SELECT " + _f(_pearson_sql("srch_length_of_stay", "srch_booking_window"), "correlation") + " FROM impressions")
def q_g16(spark, sf):
    return norm_df(ST.correlation(impressions(spark, sf), "srch_length_of_stay", "srch_booking_window"), ["correlation"])


_CORR_COLS = list(NUMERIC)


@register(
    "g17_corr_matrix",
    W + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, {_f(_pearson_sql(a, b), 'correlation')} FROM impressions"
        for i, a in enumerate(_CORR_COLS)
        for b in _CORR_COLS[i + 1 :]
    )
    + ")",
)
def q_g17(spark, sf):
    return norm_df(ST.correlation_matrix(impressions(spark, sf), _CORR_COLS), ["correlation"])


_G18_EXCL = {"srch_id", "gross_booking_usd", "gross_bookings_usd", "click_bool", "booking_bool"}
_G18_COLS = [c for c in NUMERIC if c not in _G18_EXCL]
_COMP = [c for c in BASE if c.startswith("comp")]


@register(
    "g18_corr_with_booking",
    W + ", z AS (SELECT * REPLACE (" + ", ".join(f"COALESCE({c}, 0) AS {c}" for c in _COMP) + ") FROM impressions)\n"
    "SELECT * FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, {_f(_pearson_sql(c, 'booking_bool'), 'correlation')} FROM z" for c in _G18_COLS)
    + ")",
)
def q_g18(spark, sf):
    out = ST.correlation_with(impressions(spark, sf), "booking_bool", _G18_COLS, fill_zero=_COMP)
    return norm_df(out, ["correlation"])


@register(
    "g19_min_max_affinity",
    W + "SELECT " + _f("min(srch_query_affinity_score)", "min_value") + ", " + _f("max(srch_query_affinity_score)", "max_value") + " FROM impressions",
)
def q_g19(spark, sf):
    return norm_df(P.min_max(impressions(spark, sf), "srch_query_affinity_score"), ["min_value", "max_value"])


# every pair of values is a cell, with 0 rows where none fall into it
_CHI_SQL = (
    W + f", b AS (SELECT {_RECURRING_SQL} AS a, booking_bool AS b FROM impressions WHERE booking_bool IS NOT NULL)\n"
    ", ra AS (SELECT a, CAST(count(*) AS DOUBLE) AS ra FROM b GROUP BY a), cb AS (SELECT b, CAST(count(*) AS DOUBLE) AS cb FROM b GROUP BY b)\n"
    ", c AS (SELECT a, b, CAST(count(*) AS DOUBLE) AS o FROM b GROUP BY a, b)\n"
    ", e AS (SELECT COALESCE(o, 0.0) AS o, ra * cb / (SELECT count(*) FROM b) AS e, "
    "((SELECT count(*) FROM ra) - 1) * ((SELECT count(*) FROM cb) - 1) AS dof FROM ra CROSS JOIN cb LEFT JOIN c USING (a, b))\n"
    ", x AS (SELECT sum(pow(greatest(abs(o - e) - CASE WHEN dof = 1 THEN least(0.5, abs(o - e)) ELSE 0.0 END, 0.0), 2) / e) AS chi2, max(dof) AS dof FROM e)\n"
)


@register("g20_chi2_recurring_booking", _CHI_SQL + "SELECT " + _f("chi2", "chi2") + ", CAST(dof AS INTEGER) AS dof FROM x")
def q_g20(spark, sf):
    df = row_features(impressions(spark, sf))
    out = ST.chi2_2x2(df, "is_recurring_customer", "booking_bool").select("chi2", "dof")
    return norm_df(out, ["chi2"])


@register(
    "g20_chi2_p_value",
    _CHI_SQL + ", y AS (SELECT sqrt(chi2 / 2.0) AS z, dof FROM x) SELECT " + _f("CASE WHEN dof = 1 THEN " + ST.erfc_sql("z") + " END", "p_value") + " FROM y",
)
def q_g20p(spark, sf):
    out = ST.chi2_2x2(row_features(impressions(spark, sf)), "is_recurring_customer", "booking_bool")
    return norm_df(out.select("p_value"), ["p_value"])


@register(
    "g21_any_all",
    W + "SELECT COALESCE(bool_or(COALESCE(price_usd > 0, false)), false) AS any_true, "
    "COALESCE(bool_and(COALESCE(price_usd > 0, false)), true) AS all_true FROM impressions",
)
def q_g21(spark, sf):
    return P.any_all(impressions(spark, sf), F.col("price_usd") > 0)


@register("u01_distinct_searches", W + "SELECT DISTINCT srch_id FROM impressions")
def q_u01(spark, sf):
    return P.distinct_keys(impressions(spark, sf), "srch_id")


# ------------------------------------------------------------------ binning
def _bucket_sql(col: str, target: str, q: int) -> str:
    qs = ", ".join(f"quantile_cont(x, {i / q})" for i in range(q + 1))
    return (
        W + f", base AS (SELECT {col} AS x, {target} AS y FROM impressions WHERE {col} IS NOT NULL)\n"
        f", e AS (SELECT list_sort(list_distinct([{qs}])) AS edges FROM base)\n"
        ", b AS (SELECT CAST(greatest(1, len(list_filter(edges, lambda v: v < x))) AS INTEGER) AS bucket, y, edges FROM base, e)\n"
        "SELECT bucket, " + _f("edges[bucket]", "lower") + ", " + _f("edges[bucket + 1]", "upper") + ", "
        + _f("avg(y)", "mean") + ", count(y) AS count FROM b GROUP BY bucket, edges"
    )


@register("b01_loc2_quartile_click_rate", _bucket_sql("prop_location_score2", "click_bool", 4))
def q_b01(spark, sf):
    return norm_df(B.quantile_bucket_rates(impressions(spark, sf), "prop_location_score2", "click_bool", 4), ["lower", "upper", "mean"])


@register("b02_distance_quintile_booking_rate", _bucket_sql("orig_destination_distance", "booking_bool", 5))
def q_b02(spark, sf):
    return norm_df(B.quantile_bucket_rates(impressions(spark, sf), "orig_destination_distance", "booking_bool", 5), ["lower", "upper", "mean"])


def _hist_sql(src: str, bins: int) -> str:
    return (
        W + f", v AS ({src})\n, m AS (SELECT min(x) AS lo0, max(x) AS hi0 FROM v)\n"
        ", r AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM m)\n"
        f", c AS (SELECT LEAST(CAST(floor((x - lo) * ({bins} / (hi - lo))) AS INTEGER) + 1, {bins}) AS bin, count(*) AS n FROM v, r GROUP BY 1)\n"
        f"SELECT CAST(g.i AS INTEGER) AS bin, " + _f(f"lo + (g.i - 1) * ((hi - lo) / {bins})", "lower") + ", "
        + _f(f"lo + g.i * ((hi - lo) / {bins})", "upper") + ", COALESCE(c.n, 0) AS count "
        f"FROM range(1, {bins + 1}) g(i) CROSS JOIN r LEFT JOIN c ON c.bin = g.i"
    )


@register(
    "b03_price_histogram_below_p95",
    _hist_sql("SELECT price_usd AS x FROM impressions WHERE price_usd <= (SELECT quantile_cont(price_usd, 0.95) FROM impressions)", 50),
)
def q_b03(spark, sf):
    df = B.between_quantiles(impressions(spark, sf), "price_usd", None, 0.95)
    return norm_df(B.histogram(df, "price_usd", 50), ["lower", "upper"])


@register("b04_log_distance_histogram", _hist_sql("SELECT ln(1 + orig_destination_distance) AS x FROM impressions WHERE orig_destination_distance IS NOT NULL", 100))
def q_b04(spark, sf):
    return norm_df(B.log_histogram(impressions(spark, sf), "orig_destination_distance", 100), ["lower", "upper"])


@register("b05_starrating_counts", W + "SELECT prop_starrating, count(*) AS count FROM impressions WHERE prop_starrating IS NOT NULL GROUP BY 1")
def q_b05(spark, sf):
    return B.category_counts(impressions(spark, sf), "prop_starrating")


@register(
    "b06_star_promotion_counts",
    W + "SELECT prop_starrating, promotion_flag, count(*) AS count FROM impressions "
    "WHERE prop_starrating IS NOT NULL AND promotion_flag IS NOT NULL GROUP BY 1, 2",
)
def q_b06(spark, sf):
    return B.category_counts(impressions(spark, sf), "prop_starrating", "promotion_flag")


@register(
    "b07_price_box",
    W + ", q AS (SELECT quantile_cont(price_usd, 0.25) AS q1, quantile_cont(price_usd, 0.5) AS med, quantile_cont(price_usd, 0.75) AS q3 FROM impressions)\n"
    ", f AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lo_f, q3 + 1.5 * (q3 - q1) AS hi_f FROM q)\n"
    "SELECT " + _f("q1", "q1") + ", " + _f("med", "median") + ", " + _f("q3", "q3") + ", "
    + _f("min(CASE WHEN price_usd >= lo_f THEN price_usd END)", "whisker_low") + ", "
    + _f("max(CASE WHEN price_usd <= hi_f THEN price_usd END)", "whisker_high") + ", "
    "count(*) FILTER (WHERE price_usd < lo_f OR price_usd > hi_f) AS outliers FROM impressions, f WHERE price_usd IS NOT NULL GROUP BY q1, med, q3",
)
def q_b07(spark, sf):
    return norm_df(B.box_stats(impressions(spark, sf), "price_usd"), ["q1", "median", "q3", "whisker_low", "whisker_high"])


@register(
    "b08_price_box_by_star",
    W + ", base AS (SELECT prop_starrating, price_usd FROM impressions WHERE price_usd <= (SELECT quantile_cont(price_usd, 0.95) FROM impressions) "
    "AND prop_starrating IS NOT NULL AND price_usd IS NOT NULL)\n"
    ", q AS (SELECT prop_starrating, quantile_cont(price_usd, 0.25) AS q1, quantile_cont(price_usd, 0.5) AS median, quantile_cont(price_usd, 0.75) AS q3 FROM base GROUP BY 1)\n"
    ", f AS (SELECT *, q1 - (q3 - q1) * 1.5 AS lo_f, q3 + (q3 - q1) * 1.5 AS hi_f FROM q)\n"
    "SELECT base.prop_starrating, " + _f("q1", "q1") + ", " + _f("median", "median") + ", " + _f("q3", "q3") + ", "
    + _f("min(CASE WHEN price_usd >= lo_f THEN price_usd END)", "whisker_low") + ", "
    + _f("max(CASE WHEN price_usd <= hi_f THEN price_usd END)", "whisker_high") + ", "
    "count(*) FILTER (WHERE price_usd < lo_f OR price_usd > hi_f) AS outliers FROM base JOIN f USING (prop_starrating) "
    "GROUP BY base.prop_starrating, q1, median, q3",
)
def q_b08(spark, sf):
    df = B.between_quantiles(impressions(spark, sf), "price_usd", None, 0.95)
    return norm_df(B.box_stats_by(df, "prop_starrating", "price_usd"), ["q1", "median", "q3", "whisker_low", "whisker_high"])


def _hexbin_sql(xe: str, ye: str, grid: int) -> str:
    ny = int(grid / 3 ** 0.5)
    return (
        W + f", p AS (SELECT CAST({xe} AS DOUBLE) AS x, CAST({ye} AS DOUBLE) AS y FROM impressions WHERE {xe} IS NOT NULL AND {ye} IS NOT NULL)\n"
        ", m AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM p)\n"
        ", n AS (SELECT CASE WHEN x0 = x1 THEN (CASE WHEN x0 = 0 THEN -0.1 ELSE x0 - 0.1 * abs(x0) END) ELSE x0 END AS xa, "
        "CASE WHEN x0 = x1 THEN (CASE WHEN x1 = 0 THEN 0.1 ELSE x1 + 0.1 * abs(x1) END) ELSE x1 END AS xb, "
        "CASE WHEN y0 = y1 THEN (CASE WHEN y0 = 0 THEN -0.1 ELSE y0 - 0.1 * abs(y0) END) ELSE y0 END AS ya, "
        "CASE WHEN y0 = y1 THEN (CASE WHEN y1 = 0 THEN 0.1 ELSE y1 + 0.1 * abs(y1) END) ELSE y1 END AS yb FROM m)\n"
        ", g AS (SELECT xa - 1.0e-9 * (xb - xa) AS xmin, xb + 1.0e-9 * (xb - xa) AS xmax, ya AS ymin, yb AS ymax FROM n)\n"
        f", s AS (SELECT xmin, ymin, (xmax - xmin) / {grid} AS sx, (ymax - ymin) / {ny} AS sy FROM g)\n"
        ", i AS (SELECT (x - xmin) / sx AS ix, (y - ymin) / sy AS iy FROM p, s)\n"
        ", d AS (SELECT *, pow(ix - round_even(ix, 0), 2) + 3.0 * pow(iy - round_even(iy, 0), 2) AS d1, "
        "pow(ix - floor(ix) - 0.5, 2) + 3.0 * pow(iy - floor(iy) - 0.5, 2) AS d2 FROM i)\n"
        "SELECT CASE WHEN d1 < d2 THEN 1 ELSE 2 END AS lattice, CAST(CASE WHEN d1 < d2 THEN round_even(ix, 0) ELSE floor(ix) END AS BIGINT) AS i, "
        "CAST(CASE WHEN d1 < d2 THEN round_even(iy, 0) ELSE floor(iy) END AS BIGINT) AS j, count(*) AS count FROM d GROUP BY 1, 2, 3"
    )


@register("b09_hexbin_window_stay", _hexbin_sql("LEAST(srch_booking_window, 365)", "LEAST(srch_length_of_stay, 30)", 50))
def q_b09(spark, sf):
    from rankmill.functions.scalar import clip_upper

    return B.hexbin_counts(impressions(spark, sf), clip_upper("srch_booking_window", 365), clip_upper("srch_length_of_stay", 30), 50)


@register(
    "b10_scatter_sample",
    W + "SELECT srch_id, prop_id, position, LEAST(srch_booking_window, 365) AS srch_booking_window_capped, LEAST(srch_length_of_stay, 30) AS srch_length_of_stay_capped "
    "FROM impressions ORDER BY md5('42|' || srch_id || '|' || prop_id || '|' || position), srch_id, prop_id, position, 4, 5 LIMIT 5000",
)
def q_b10(spark, sf):
    from rankmill.functions.scalar import clip_upper

    df = impressions(spark, sf).select(
        "srch_id", "prop_id", "position",
        clip_upper("srch_booking_window", 365).alias("srch_booking_window_capped"),
        clip_upper("srch_length_of_stay", 30).alias("srch_length_of_stay_capped"),
    )
    return B.seeded_sample(df, 5000, seed=42, key_cols=["srch_id", "prop_id", "position"])


import rankmill.plans.registry_runs  # noqa: E402, F401  (registers the queries of splits, orders, gradients and run logs)
import rankmill.plans.registry_io  # noqa: E402, F401  (registers those of files, column selection and models)
