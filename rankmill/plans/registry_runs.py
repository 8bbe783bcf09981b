"""Registered queries of splits, orders, scalar functions, ranker gradients and run logs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from rankmill.functions import scalar as S
from rankmill.functions.columns import align_to
from rankmill.operators import ranking as R
from rankmill.operators import runs as A
from rankmill.operators import split as SP
from rankmill.operators import stats as ST
from rankmill.operators.features import engineer_features, prop_table
from rankmill.operators.ranker import LambdaMART
from rankmill.plans.oracle import norm_df
from rankmill.plans.registry import register
from rankmill.sources.bridge import impressions, oracle_cte

W = oracle_cte()

_SPLIT_SQL = (
    W + ", k AS (SELECT DISTINCT srch_id FROM impressions WHERE srch_id IS NOT NULL)"
    ", h AS (SELECT srch_id, CAST('0x' || substr(md5('{seed}:' || srch_id), 1, 13) AS BIGINT) AS h FROM k)"
    ", r AS (SELECT srch_id, row_number() OVER (ORDER BY h, srch_id) AS r, count(*) OVER () AS n FROM h) "
    "SELECT srch_id, r <= {round}(n * 0.2) AS in_test FROM r"
)


def _sides(train, test):
    ids = lambda d, t: d.select("srch_id").distinct().withColumn("in_test", F.lit(t))
    return ids(train, False).unionByName(ids(test, True))


@register("m02_split_validation", _SPLIT_SQL.format(seed=42, round="ceil"))
def q_m02(spark, sf):
    return _sides(*SP.split_data(impressions(spark, sf), 0.2, 42))


@register("m01_split_loader", _SPLIT_SQL.format(seed=7, round="floor"))
def q_m01(spark, sf):
    return _sides(*SP.split_data_by_search_id(impressions(spark, sf), 0.2, 7))


@register(
    "j02_keep_groups",
    W + ", b AS (SELECT DISTINCT srch_id FROM impressions WHERE booking_bool = 1) SELECT srch_id, prop_id, position, "
    "srch_id IN (SELECT srch_id FROM b) AS booked_search FROM impressions",
)
def q_j02(spark, sf):
    df = impressions(spark, sf).select("srch_id", "prop_id", "position", "booking_bool")
    keys = df.filter("booking_bool = 1").select("srch_id").distinct()
    kept = [SP.keep_groups(df, keys, keep=k).withColumn("booked_search", F.lit(k)) for k in (True, False)]
    return kept[0].unionByName(kept[1]).drop("booking_bool")


@register(
    "p07_mismatch_counts",
    W + "SELECT srch_destination_id, count(*) AS count FROM impressions WHERE COALESCE(srch_destination_id <> prop_country_id, true) "
    "AND srch_destination_id IS NOT NULL GROUP BY 1",
)
def q_p07(spark, sf):
    df = impressions(spark, sf).filter(S.differs("srch_destination_id", "prop_country_id"))
    return ST.value_counts(df, "srch_destination_id")


@register(
    "t06_train_fitted_hotel_stats",
    _SPLIT_SQL.format(seed=42, round="ceil").replace("SELECT srch_id, r <=", ", side AS (SELECT srch_id, r <=")
    + "), p AS (SELECT prop_id, avg(price_usd) AS a, median(CAST(prop_location_score2 AS DOUBLE)) AS m, COALESCE(stddev_samp(price_usd), 0.0) AS s "
    "FROM impressions JOIN side USING (srch_id) WHERE NOT in_test GROUP BY prop_id) SELECT t.srch_id, t.prop_id, t.position, CAST(a AS FLOAT) AS avg_price_usd_for_prop, "
    "CAST(m AS FLOAT) AS median_prop_location_score2_for_prop, CAST(s AS FLOAT) AS stddev_price_usd_for_prop, CAST(t.price_usd - a AS FLOAT) AS price_deviation_from_prop_hist_avg "
    "FROM impressions t LEFT JOIN p ON t.prop_id = p.prop_id",
)
def q_t06(spark, sf):
    """All impressions with the hotel statistics of the training searches."""
    df = impressions(spark, sf)
    out = engineer_features(df, hotel_stats=prop_table(SP.split_data(df, 0.2, 42)[0]))
    names = ["avg_price_usd_for_prop", "median_prop_location_score2_for_prop", "stddev_price_usd_for_prop", "price_deviation_from_prop_hist_avg"]
    return norm_df(out.select("srch_id", "prop_id", "position", *names), names)


@register("p03_align", W + "SELECT srch_id, prop_id, CAST(0 AS INTEGER) AS absent_feature, site_id, position FROM impressions")
def q_p03(spark, sf):
    return align_to(impressions(spark, sf), ["absent_feature", "site_id", "position"], keep=["srch_id", "prop_id"])


@register("o02_sorted_searches", W + "SELECT srch_id, count(*) AS rows, true AS contiguous, true AS ordered FROM impressions GROUP BY srch_id")
def q_o02(spark, sf):
    placed = R.sort_by_group(impressions(spark, sf).select("srch_id", "prop_id"))
    placed = placed.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.spark_partition_id())
    # within each delivered partition a search follows a smaller or the same one
    placed = placed.withColumn("_prev", F.lag("srch_id").over(Window.partitionBy("_part").orderBy("_at")))
    return placed.groupBy("srch_id").agg(
        F.count(F.lit(1)).alias("rows"),
        (F.max("_at") - F.min("_at") + 1 == F.count(F.lit(1))).alias("contiguous"),
        F.bool_and(F.col("_prev").isNull() | (F.col("_prev") <= F.col("srch_id"))).alias("ordered"),
    )


_TEXT_SQL = "CASE o_orderkey % 5 WHEN 0 THEN 'N/A' WHEN 1 THEN ' not available' WHEN 2 THEN 'abc' WHEN 3 THEN CAST(CAST(o_orderkey AS DOUBLE) / 8 AS VARCHAR) END"


@register(
    "f15_numbers_and_text",
    f"WITH t AS (SELECT o_orderkey, o_orderpriority, o_totalprice, {_TEXT_SQL} AS t FROM orders), n AS (SELECT *, CASE WHEN lower(trim(t)) NOT IN ('not available', 'n/a') "
    "THEN TRY_CAST(t AS DOUBLE) END AS number FROM t) SELECT o_orderkey, number, CASE WHEN number IS NULL THEN 'N/A' ELSE printf('%.4f', number) END AS formatted, "
    "CAST(round(o_totalprice / 1000.0, 1) AS VARCHAR) || '%' AS percent, CASE o_orderpriority WHEN '1-URGENT' THEN 'first' WHEN '5-LOW' THEN 'last' ELSE 'between' END AS label FROM n",
)
def q_f15(spark, sf):
    text = F.expr(_TEXT_SQL.replace("VARCHAR", "STRING"))
    df = spark.read.parquet(f"{sf}/orders.parquet").withColumn("number", S.parse_number(text))
    return df.select(
        "o_orderkey",
        "number",
        S.fmt_number("number", 4).alias("formatted"),
        S.percent_text(F.col("o_totalprice") / 1000.0, 1).alias("percent"),
        S.label_map("o_orderpriority", {"1-URGENT": "first", "5-LOW": "last"}, "between").alias("label"),
    )


@register("f01_timestamps", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS TIMESTAMP) AS parsed, CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate END AS lenient FROM orders")
def q_f01(spark, sf):
    text = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss")
    df = spark.read.parquet(f"{sf}/orders.parquet").withColumn("t", text).withColumn("u", F.when(F.col("o_orderkey") % 3 > 0, F.col("t")).otherwise(F.lit("no date")))
    return df.select("o_orderkey", S.to_ts("t").cast("timestamp_ntz").alias("parsed"), S.to_ts("u", strict=False).cast("timestamp_ntz").alias("lenient"))


_GRADES = "CASE WHEN booking_bool = 1 THEN 5.0 WHEN click_bool = 1 THEN 1.0 ELSE 0.0 END"


@register(
    "lambda_gradients",
    W + f", d AS (SELECT srch_id, prop_id, -price_usd AS s, {_GRADES} AS y FROM (SELECT *, row_number() OVER (PARTITION BY srch_id, prop_id ORDER BY position, price_usd, "
    "click_bool, booking_bool) AS rn FROM impressions) WHERE rn = 1)"
    ", r AS (SELECT *, row_number() OVER (PARTITION BY srch_id ORDER BY s DESC, prop_id) AS p, row_number() OVER (PARTITION BY srch_id ORDER BY y DESC) AS ip, "
    "max(s) OVER (PARTITION BY srch_id) AS hi, min(s) OVER (PARTITION BY srch_id) AS lo FROM d)"
    ", i AS (SELECT srch_id, sum(CASE WHEN ip <= 30 THEN (pow(2, y) - 1) / log2(ip + 1) ELSE 0 END) AS ideal FROM r GROUP BY srch_id)"
    ", q AS (SELECT a.srch_id, a.prop_id AS pa, b.prop_id AS pb, a.y > b.y AS up, CASE WHEN a.y > b.y THEN a.s - b.s ELSE b.s - a.s END AS ds, a.hi <> a.lo AS spread, "
    "abs(pow(2, a.y) - pow(2, b.y)) * abs(1 / log2(a.p + 1) - 1 / log2(b.p + 1)) * CASE WHEN ideal > 0 THEN 1 / ideal ELSE 0 END AS d "
    "FROM r a JOIN r b ON a.srch_id = b.srch_id AND a.p <= 30 AND b.p > a.p AND a.y <> b.y JOIN i ON i.srch_id = a.srch_id)"
    ", v AS (SELECT srch_id, pa, pb, up, CASE WHEN spread THEN d / (0.01 + abs(ds)) ELSE d END AS d, CASE WHEN ds > 700 THEN 0.0 ELSE 1 / (1 + exp(ds)) END AS rho FROM q)"
    ", l AS (SELECT srch_id, pa, pb, CASE WHEN up THEN -rho * d ELSE rho * d END AS g, rho * (1 - rho) * d AS h, rho * d AS a FROM v)"
    ", c AS (SELECT srch_id, prop_id, sum(g) AS g, sum(h) AS h, sum(a) AS a FROM (SELECT srch_id, pa AS prop_id, g, h, a FROM l UNION ALL SELECT srch_id, pb, -g, h, a FROM l) GROUP BY 1, 2)"
    ", t AS (SELECT *, sum(a) OVER (PARTITION BY srch_id) AS t FROM c)"
    ", f AS (SELECT srch_id, prop_id, CASE WHEN t > 0 THEN log2(1 + t) / t ELSE 1 END AS k, g, h FROM t) "
    "SELECT srch_id, prop_id, CAST(round(g * k, 6) + 0.0 AS FLOAT) AS g, CAST(round(h * k, 6) + 0.0 AS FLOAT) AS h FROM f",
)
def q_gradients(spark, sf):
    df = impressions(spark, sf).select("srch_id", "prop_id", "position", "price_usd", "click_bool", "booking_bool")
    df = R.add_relevance(R.dedupe_keys(df))
    out = LambdaMART().gradients(df.withColumn("score", -F.col("price_usd")), "score")
    return norm_df(out.select("srch_id", "prop_id", (F.round("g", 6) + 0.0).alias("g"), (F.round("h", 6) + 0.0).alias("h")), ["g", "h"])


# ------------------------------------------------------------- run logs
# one record per order priority: the shape of a run log, from the given tables
_RUN_SQL = (
    "WITH g AS (SELECT o_orderpriority AS k, count(*) AS n, avg(o_totalprice) / 1000000.0 AS s, sum(o_totalprice) / 1000.0 AS d, "
    "count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1)"
    ", r AS (SELECT k AS timestamp, CASE WHEN k <> '3-MEDIUM' THEN s END AS ndcg_at_5, d AS training_seconds, CAST(n AS BIGINT) AS num_features, CAST(n AS VARCHAR) AS nrows_train, f, o, p FROM g)"
    ", b AS (SELECT * FROM r WHERE ndcg_at_5 IS NOT NULL ORDER BY ndcg_at_5 DESC, timestamp LIMIT 1) "
)


def _run_logs(spark, sf):
    status = lambda x: F.count(F.when(F.col("o_orderstatus") == x, 1)).cast("double")
    g = spark.read.parquet(f"{sf}/orders.parquet").groupBy(F.col("o_orderpriority").alias("k")).agg(
        F.count(F.lit(1)).cast("string").alias("n"),
        (F.avg("o_totalprice") / 1000000.0).cast("string").alias("s"),
        (F.sum("o_totalprice") / 1000.0).cast("string").alias("d"),
        F.create_map(F.lit("F"), status("F"), F.lit("O"), status("O"), F.lit("P"), status("P")).alias("importances"),
    )
    train_only = F.col("k") == "5-LOW"
    score = F.when(F.col("k") == "3-MEDIUM", F.lit("Not available")).otherwise(F.col("s"))
    return g.select(
        F.col("k").alias("run_timestamp"),
        F.struct(F.col("n").alias("nrows_loaded_train")).alias("configuration"),
        F.struct(F.col("n").alias("num_features_used")).alias("data_summary"),
        F.struct(
            F.create_map(F.lit("rows"), F.col("n")).alias("parameters_used"),
            F.col("d").alias("training_duration_seconds"),
            F.when(~train_only, score).alias("validation_ndcg_at_5"),
        ).alias("model_training_results"),
        F.struct(F.when(train_only, score).alias("validation_ndcg_at_5"), F.lit(None).cast("string").alias("training_duration_seconds")).alias("model_performance"),
        F.struct(F.lit(None).cast("map<string,string>").alias("parameters_used")).alias("model_details"),
        F.col("importances").alias("feature_importances_gain"),
    )


@register("a01_runs", _RUN_SQL + "SELECT timestamp, CAST(ndcg_at_5 AS FLOAT) AS ndcg_at_5, CAST(training_seconds AS FLOAT) AS training_seconds, num_features, nrows_train FROM r")
def q_a01(spark, sf):
    return norm_df(A.extract_metrics(_run_logs(spark, sf)).drop("importances", "parameters"), ["ndcg_at_5", "training_seconds"])


@register("a02_best_run", _RUN_SQL + "SELECT timestamp, CAST(ndcg_at_5 AS FLOAT) AS ndcg_at_5 FROM b")
def q_a02(spark, sf):
    return norm_df(A.best_run(A.extract_metrics(_run_logs(spark, sf))).select("timestamp", "ndcg_at_5"), ["ndcg_at_5"])


@register(
    "a03_top_importances",
    _RUN_SQL + ", u AS (SELECT timestamp, unnest(['F', 'O', 'P']) AS feature, unnest([f, o, p]) AS importance FROM b) SELECT * FROM (SELECT timestamp, feature, "
    "CAST(importance AS DOUBLE) AS importance, row_number() OVER (ORDER BY importance DESC, feature) AS rank FROM u) WHERE rank <= 2",
)
def q_a03(spark, sf):
    return A.top_importances(A.best_run(A.extract_metrics(_run_logs(spark, sf))), 2)


@register("a03_parameters", _RUN_SQL + "SELECT timestamp, 'rows' AS parameter, nrows_train AS value FROM b")
def q_a03_parameters(spark, sf):
    return A.run_parameters(A.best_run(A.extract_metrics(_run_logs(spark, sf))))


@register(
    "a04_formatted",
    _RUN_SQL + "SELECT timestamp, CASE WHEN ndcg_at_5 IS NULL THEN 'N/A' ELSE printf('%.4f', ndcg_at_5) END AS ndcg_at_5, printf('%.2f', training_seconds) AS training_seconds, "
    "num_features, nrows_train FROM r",
)
def q_a04(spark, sf):
    return A.formatted_runs(A.extract_metrics(_run_logs(spark, sf)))
