"""Edge cases of the operators on tiny literal frames (FIXTURES F8)."""

import math

import pytest
from pyspark.sql import functions as F

from rankmill.operators import binning as B
from rankmill.operators import stats as ST
from rankmill.operators.features import price_rank, row_features, engineer_features, search_table
from rankmill.operators.impute import apply_imputation, handle_missing_values
from rankmill.operators.ranking import add_relevance, ndcg_per_group
from rankmill.functions.columns import MissingColumnsError, align_to, feature_columns


def test_price_rank_average_ties_and_null(spark):
    df = spark.createDataFrame([(1, 1, 10.0), (1, 2, 10.0), (1, 3, 20.0), (1, 4, None), (2, 5, 5.0)], "srch_id long, prop_id long, price_usd double")
    got = {r.prop_id: r.price_rank_within_search for r in price_rank(df).collect()}
    assert got == {1: 1.5, 2: 1.5, 3: 3.0, 4: None, 5: 1.0}


def _row_frame(spark, rows):
    schema = (
        "srch_id long, prop_id long, price_usd double, prop_review_score double, visitor_location_country_id int, "
        "prop_country_id int, date_time timestamp, srch_booking_window int, visitor_hist_starrating double, visitor_hist_adr_usd double"
    )
    return spark.createDataFrame(rows, schema)


def test_value_for_money_domestic_dates_weeks(spark):
    import datetime as dt

    sat, sun, mon = dt.datetime(2024, 6, 1, 13), dt.datetime(2024, 6, 2, 8), dt.datetime(2024, 6, 3, 23)
    rows = [
        (1, 1, 100.0, 4.0, 1, 1, sat, 3, None, None),
        (1, 2, 0.0, 4.0, 1, 2, sun, 4, 3.0, None),
        (1, 3, 0.0, 0.0, None, 1, mon, 10, None, 10.0),
        (1, 4, None, 4.0, None, None, None, 11, None, None),
        (1, 5, 100.0, None, 2, 2, mon, None, None, None),
    ]
    out = {r.prop_id: r for r in row_features(_row_frame(spark, rows)).collect()}
    assert [out[i].value_for_money_score for i in range(1, 6)] == [0.04, 100.0, 0.0, 0.0, 0.0]
    assert [out[i].is_domestic_travel for i in range(1, 6)] == [1, 0, 0, 0, 1]
    assert [out[i].is_weekend_search for i in range(1, 6)] == [1, 1, 0, 0, 0]
    assert [out[i].search_day_of_week for i in range(1, 6)] == [5, 6, 0, None, 0]
    assert out[4].search_hour_of_day is None and out[4].search_month is None
    assert out[1].search_hour_of_day == 13 and out[1].search_month == 6
    assert [out[i].booking_window_weeks for i in range(1, 6)] == [0.0, 1.0, 1.0, 2.0, None]
    assert [out[i].is_recurring_customer for i in range(1, 6)] == [0, 1, 1, 0, 0]


def test_recurring_requires_history_columns(spark):
    df = spark.createDataFrame([(1, 1)], "srch_id long, prop_id long")
    with pytest.raises(MissingColumnsError):
        row_features(df)


def test_affinity_fill_rules(spark):
    df = spark.createDataFrame([(-3.0,), (None,), (-5.0,)], "srch_query_affinity_score double")
    out, params = handle_missing_values(df)
    assert params["srch_query_affinity_score_min"] == -5.0
    assert sorted(r[0] for r in out.collect()) == [-105.0, -5.0, -3.0]
    nulls = spark.createDataFrame([(None,), (None,)], "srch_query_affinity_score double")
    out2, p2 = handle_missing_values(nulls)
    assert math.isnan(p2["srch_query_affinity_score_min"])
    assert [r[0] for r in out2.collect()] == [None, None]
    # test side with training minimum
    out3, _ = handle_missing_values(nulls, is_train=False, imputation_values={"srch_query_affinity_score_min": -5.0})
    assert [r[0] for r in out3.collect()] == [-105.0, -105.0]
    # no training values and an all-null column: fallback
    assert [r[0] for r in apply_imputation(nulls).collect()] == [-999.0, -999.0]


def test_single_row_search_and_zero_mean_ratio(spark):
    from rankmill.sources.bridge import impressions

    df = handle_missing_values(impressions(spark, "/root/testdata/sf0.001"))[0]
    one = df.where(F.col("srch_id") == df.groupBy("srch_id").count().where("count = 1").first()[0])
    out = engineer_features(one, "full").first()
    assert out.stddev_price_usd_in_search == 0.0
    assert out.median_price_usd_in_search == out.avg_price_usd_in_search
    assert out.normalized_price_in_search == 0.5
    zero = spark.createDataFrame([(1, 1, 0.0, 3)], "srch_id long, prop_id long, price_usd double, prop_starrating int")
    t = search_table(zero)
    assert t.first().avg_price_usd_in_search == 0.0


def test_relevance_grades(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (1, 1), (0, 1)], "click_bool int, booking_bool int")
    assert [r.relevance for r in add_relevance(df).collect()] == [0, 1, 5, 5]
    with pytest.raises(MissingColumnsError):
        add_relevance(spark.createDataFrame([(1,)], "click_bool int"))


def test_quantile_buckets_collapse(spark):
    df = spark.createDataFrame([(1.0, 1), (1.0, 0), (1.0, 1), (1.0, 0), (9.0, 1)], "x double, y int")
    assert B.quantile_edges(df, "x", 4) == [1.0, 9.0]
    out = B.quantile_bucket_rates(df, "x", "y", 4).collect()
    assert len(out) == 1 and out[0]["count"] == 5


def test_histogram_last_bin_closed_and_constant(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    h = {r.bin: r["count"] for r in B.histogram(df, "x", 5).collect()}
    assert h[5] == 3 and sum(h.values()) == 11
    c = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    hc = B.histogram(c, "x", 4).collect()
    assert sum(r["count"] for r in hc) == 2


def test_constant_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "a double, b double")
    assert ST.correlation(df, "a", "b").first()[0] is None


def test_chi2_with_continuity_correction(spark):
    rows = [(0, 0)] * 10 + [(0, 1)] * 20 + [(1, 0)] * 20 + [(1, 1)] * 10
    df = spark.createDataFrame(rows, "a int, b int")
    r = ST.chi2_2x2(df, "a", "b").first()
    assert abs(r.chi2 - 5.4) < 1e-9 and r.dof == 1
    assert abs(r.p_value - math.erfc(math.sqrt(5.4 / 2))) < 1e-12
    r2 = ST.chi2_2x2(df, "a", "b", correction=False).first()
    assert abs(r2.chi2 - 20 / 3) < 1e-9


def test_ndcg_hand_computed(spark):
    df = spark.createDataFrame([(1, 3.0, 0, 1), (1, 2.0, 5, 2), (1, 1.0, 1, 3)], "srch_id long, score double, relevance int, prop_id long")
    r = ndcg_per_group(df, "score").first()
    assert abs(r.dcg - (31 / math.log2(3) + 1 / 2)) < 1e-9
    assert abs(r.idcg - (31 + 1 / math.log2(3))) < 1e-9
    assert abs(r.ndcg - 0.634145) < 1e-5


def test_alignment_adds_zero_columns(spark):
    df = spark.createDataFrame([(1, 2, 3.0)], "srch_id long, prop_id long, a double")
    out = align_to(df, ["b", "a"], keep=["srch_id", "prop_id"])
    assert out.columns == ["srch_id", "prop_id", "b", "a"] and out.first().b == 0


def test_feature_list_excludes_both_booking_spellings(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 2.0, 3.0)], "srch_id long, prop_id long, gross_bookings_usd double, gross_booking_usd double, x double")
    assert feature_columns(df) == ["prop_id", "x"]


def test_missing_column_profile_skips(spark):
    df = spark.createDataFrame([(1, 1, 3, 0.5)], "srch_id long, prop_id long, prop_starrating int, prop_review_score double")
    df = df.withColumns({"visitor_hist_starrating": F.lit(None).cast("double"), "visitor_hist_adr_usd": F.lit(None).cast("double")})
    out = engineer_features(df)
    assert "price_rank_within_search" not in out.columns and "avg_prop_starrating_for_prop" in out.columns
