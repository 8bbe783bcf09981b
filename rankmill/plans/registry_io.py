"""Registered queries of files (S1, S2, S4, S8), column selection (P1, P2, P4, P5, P10, U2) and models."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankmill.functions import columns as C
from rankmill.operators import ranking as R
from rankmill.operators import runs as A
from rankmill.operators.impute import handle_missing_values
from rankmill.operators.ranker import OTHER, CategoryIndex, LambdaMARTModel, Tree
from rankmill.plans.oracle import norm_df, norm_sql
from rankmill.plans.registry import BASE, IMP_CTE, _key_feature_sql, _row_feature_sql, register
from rankmill.plans.registry_runs import _RUN_SQL, _run_logs
from rankmill.plans.train import predict, prepare_features_and_target
from rankmill.schema import CATEGORICAL_COLS, EXCLUDED_FEATURE_COLS, TRAIN_ONLY_COLS, impression_schema
from rankmill.session import checkpoint_dir, shuffles_freed
from rankmill.sources import bridge
from rankmill.sources.bridge import impressions, oracle_cte, read_table, task_count
from rankmill.sources.files import load_impressions, write_json, write_submission
from rankmill.sources.runlogs import read_run_logs

W = oracle_cte()
FIRST_ROWS = 5000
# a long log is written in so many slices, and each drops its shuffle files before the next; a fixed number, so that the work follows the rows
LOG_SLICES = 8


def _folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ------------------------------------------------------------------- files
_PLAIN = [c for c in BASE if c != "date_time"]


@register("s01_csv_log", W + "SELECT " + norm_sql(_PLAIN) + ", strftime(date_time, '%Y-%m-%d %H:%M:%S') AS date_time FROM impressions")
def q_s01(spark, sf):
    view = impressions(spark, sf)
    path = _folder(spark, "log")
    view.write.option("header", True).option("nullValue", "NULL").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").option("compression", "gzip").csv(path)
    kinds = dict(view.dtypes)
    got = load_impressions(spark, path)
    got = got.select(*[F.col(c).cast(kinds[c]).alias(c) for c in _PLAIN], F.date_format("date_time", "yyyy-MM-dd HH:mm:ss").alias("date_time"))
    return norm_df(got)


def _key_slices(view: DataFrame, key: str, lines: DataFrame, column: str, slices: int) -> list[DataFrame]:
    """``view`` in up to ``slices`` ascending ranges of its ``key``, cut at approximate quantiles of ``column`` in ``lines``; null keys come first."""
    probs = [i / slices for i in range(1, slices)]
    cuts = sorted(set(lines.agg(F.percentile_approx(column, probs).alias("q")).first()["q"] or [])) if probs else []
    k = F.col(key)
    if not cuts:
        return [view]
    ranges = [k.isNull() | (k < cuts[0]), *[(k >= a) & (k < b) for a, b in zip(cuts, cuts[1:])], k >= cuts[-1]]
    return [view.where(r) for r in ranges]


_FIRST = ["srch_id", "prop_id", "position", "price_usd"]


@register("s02_first_rows", W + f"SELECT {norm_sql(_FIRST)} FROM (SELECT {', '.join(_FIRST)} FROM impressions ORDER BY ALL LIMIT {FIRST_ROWS})")
def q_s02(spark, sf):
    """The row limit is the feature: the files of the whole log lie in key order."""
    path = _folder(spark, "ordered-log")
    lines = read_table(spark, sf, "lineitem")
    n = lines.count()
    slices = 1 if n <= bridge.COUNTED_ROWS else LOG_SLICES
    view = impressions(spark, sf).drop("date_time").withColumn("date_time", F.lit("2013-04-04 08:32:15"))
    view = view.select(*[f.name for f in impression_schema(True).fields])
    # at least seven files, more where the log is longer, so that a task sorts a bounded part
    files = task_count(spark, n, at_least=7)
    with shuffles_freed(spark):
        # the folders of the slices lie in key order, too
        for i, part in enumerate(_key_slices(view, "srch_id", lines, "l_orderkey", slices)):
            ordered = part.repartitionByRange(-(-files // slices), *_FIRST).sortWithinPartitions(*_FIRST)
            ordered.write.option("header", True).option("nullValue", "NULL").option("compression", "gzip").csv(f"{path}/{i:05d}")
    return norm_df(load_impressions(spark, f"{path}/*", limit_rows=FIRST_ROWS).select(*_FIRST))


@register(
    "s04_submission_file",
    W + "SELECT srch_id AS SearchId, prop_id AS PropertyId, row_number() OVER (PARTITION BY srch_id ORDER BY price_usd ASC NULLS LAST, prop_id ASC NULLS LAST) AS rank_in_search FROM impressions",
)
def q_s04(spark, sf):
    path = _folder(spark, "submission")
    write_submission(R.submission(impressions(spark, sf).withColumn("score", -F.col("price_usd")), "score"), path)
    rows = spark.read.option("header", True).schema("SearchId long, PropertyId long").csv(path)
    # the rank is read off the order of files and lines
    rows = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_line"))
    return rows.withColumn("rank_in_search", F.row_number().over(Window.partitionBy("SearchId").orderBy("_file", "_line"))).drop("_file", "_line")


@register("s08_scanned_logs", _RUN_SQL + "SELECT timestamp, CAST(ndcg_at_5 AS FLOAT) AS ndcg_at_5, CAST(training_seconds AS FLOAT) AS training_seconds, num_features, nrows_train FROM r")
def q_s08(spark, sf):
    path = _folder(spark, "run-logs")
    for i, row in enumerate(_run_logs(spark, sf).toLocalIterator()):  # one record per order priority
        write_json(spark, f"{path}/training_log_{i}.json", row.asDict(recursive=True))
    return norm_df(A.extract_metrics(read_run_logs(spark, path)).drop("importances", "parameters"), ["ndcg_at_5", "training_seconds"])


# ----------------------------------------------------------------- columns
def _per_column(df: DataFrame, chosen: list[tuple[str, str]]) -> DataFrame:
    """(kind, column_name, present): the rows in which each chosen column has a value."""
    counted = df.agg(*[F.count(c).alias(f"c{i}") for i, (_, c) in enumerate(chosen)])
    return counted.select(C.stack_rows([[F.lit(k), F.lit(c), F.col(f"c{i}")] for i, (k, c) in enumerate(chosen)], ["kind", "column_name", "present"]))


def _per_column_sql(chosen: list[tuple[str, str]]) -> str:
    return W + " UNION ALL ".join(f"SELECT '{k}' AS kind, '{c}' AS column_name, count({c}) AS present FROM impressions" for k, c in chosen)


_FEATURES = [c for c in BASE if c not in EXCLUDED_FEATURE_COLS]
_CATEGORICAL = [c for c in CATEGORICAL_COLS if c in BASE]
_DATES = ["date_time"]


@register("p01_feature_columns", _per_column_sql([("feature", c) for c in _FEATURES] + [("categorical", c) for c in _CATEGORICAL]))
def q_p01(spark, sf):
    df = impressions(spark, sf)
    feats = C.feature_columns(df)
    return _per_column(df, [("feature", c) for c in feats] + [("categorical", c) for c in C.categorical_columns(feats)])


@register("p04_column_kinds", _per_column_sql([("numerical", c) for c in BASE if c not in _DATES] + [("datetime", c) for c in _DATES]))
def q_p04(spark, sf):
    df = impressions(spark, sf)
    return _per_column(df, [(kind, c) for kind, cols in C.feature_types(df).items() for c in cols])


@register("p05_competitor_columns", _per_column_sql([("competitor", f"comp{i}_{s}") for i in range(1, 9) for s in ("rate", "inv", "rate_percent_diff")] + [("absent from test", c) for c in TRAIN_ONLY_COLS]))
def q_p05(spark, sf):
    df = impressions(spark, sf)
    C.require(df, ["srch_id", "prop_id"], on_missing="raise")
    if C.require(df, ["no_such_column"]):
        raise AssertionError("a column was found that the log does not have")
    test = df.drop(*TRAIN_ONLY_COLS)
    return _per_column(df, [("competitor", c) for c in C.competitor_columns(df)] + [("absent from test", c) for c in C.missing_from(df.columns, test)])


# ------------------------------------------------------------------ models
_STARS = CategoryIndex({"prop_starrating": [0.0, 1.0, 2.0, 3.0, 4.0]})  # 5 stars count as rare
_FOREST = [
    {"f": 0, "t": 20000.0, "g": 1.0, "l": {"f": 1, "in": [1, 4, 5], "g": 1.0, "l": {"v": 0.5}, "r": {"v": -0.25}}, "r": {"f": 2, "t": 2.25, "g": 1.0, "l": {"v": -1.0}, "r": {"v": 0.75}}},
    {"f": 1, "in": [OTHER, 3], "g": 1.0, "l": {"f": 0, "t": 45000.5, "g": 1.0, "l": {"v": 0.125}, "r": {"v": 2.0}}, "r": {"f": 1, "in": [2], "g": 1.0, "l": {"v": -3.0}, "r": {"v": 0.0625}}},
    {"v": 0.375},
]
_FOREST_FEATURES = ["price_usd", "prop_starrating", "prop_review_score"]


def tree_sql(node: dict, features: list[str], categories: CategoryIndex) -> str:
    """A tree as nested CASE."""
    if "v" in node:
        return str(node["v"])
    name = features[node["f"]]
    if "t" in node:
        left = f"coalesce({name}, -1.0e12) <= {node['t']}"
    else:
        known = categories.values[name]
        left = f"coalesce({name} IN ({', '.join(str(known[i - 1]) for i in node['in'] if i != OTHER) or 'NULL'}), false)"
        if OTHER in node["in"]:
            left = f"({left} OR coalesce({name} NOT IN ({', '.join(map(str, known))}), true))"
    return f"CASE WHEN {left} THEN {tree_sql(node['l'], features, categories)} ELSE {tree_sql(node['r'], features, categories)} END"


def forest_sql(forest: list[dict], rate: float, features: list[str], categories: CategoryIndex) -> str:
    return " + ".join(f"{rate} * ({tree_sql(t, features, categories)})" for t in forest)


@register("m06_forest_scores", W + f"SELECT srch_id, prop_id, position, CAST({forest_sql(_FOREST, 0.5, _FOREST_FEATURES, _STARS)} AS FLOAT) AS relevance_score FROM impressions")
def q_m06(spark, sf):
    model = LambdaMARTModel(_FOREST_FEATURES, [Tree(t, _FOREST_FEATURES) for t in _FOREST], 0.5, len(_FOREST), None, categories=_STARS)
    return norm_df(model.transform(impressions(spark, sf)).select("srch_id", "prop_id", "position", "relevance_score"), ["relevance_score"])


_RANKED = ["price_rank_within_search", "avg_price_usd_in_search", "num_options_in_search"]
_RANKED_FOREST = [
    {"f": 0, "t": 1.5, "g": 1.0, "l": {"f": 2, "t": 3.5, "g": 1.0, "l": {"v": 1.0}, "r": {"v": 2.5}}, "r": {"v": -0.5}},
    {"f": 1, "t": 30000.0, "g": 1.0, "l": {"v": 0.25}, "r": {"f": 0, "t": 3.0, "g": 1.0, "l": {"v": -0.75}, "r": {"v": -2.0}}},
]


@register(
    "m08_predictions",
    W + IMP_CTE + ", f AS (SELECT *, " + ", ".join(_row_feature_sql() + _key_feature_sql(False)) + " FROM imp) "
    f"SELECT srch_id, prop_id, CAST({forest_sql(_RANKED_FOREST, 0.1, _RANKED, CategoryIndex())} AS FLOAT) AS relevance_score FROM f",
)
def q_m08(spark, sf):
    model = LambdaMARTModel(_RANKED, [Tree(t, _RANKED) for t in _RANKED_FOREST], 0.1, len(_RANKED_FOREST), None)
    view = impressions(spark, sf, "prop_id")
    _, fitted = handle_missing_values(view)
    return norm_df(predict(model, view.drop(*TRAIN_ONLY_COLS), fitted).select("srch_id", "prop_id", "relevance_score"), ["relevance_score"])


_GRADE = "CASE WHEN booking_bool = 1 THEN 5.0 WHEN click_bool = 1 THEN 1.0 ELSE 0.0 END"


@register("m03_features_and_target", W + f"SELECT CAST({_GRADE} AS INTEGER) AS relevance, {len(_FEATURES)} AS n_features, count(*) AS rows FROM impressions GROUP BY 1")
def q_m03(spark, sf):
    final, feats = prepare_features_and_target(impressions(spark, sf))
    return final.groupBy("relevance").agg(F.lit(len(feats)).alias("n_features"), F.count(F.lit(1)).alias("rows"))


_STUMPS = [("prop_starrating", 2.5), ("promotion_flag", 0.5), ("price_usd", 20000.0), ("prop_starrating", 4.5)]


def _side(expr: str, side: str) -> str:
    return f"pow(sum(CASE WHEN {side} THEN {expr} END), 2) / count(CASE WHEN {side} THEN 1 END)"


def _gain_sql(feature: str, threshold: float) -> str:
    """Reduction of squared error of the grade when the feature is cut at the threshold."""
    return f"{_side(_GRADE, f'{feature} <= {threshold}')} + {_side(_GRADE, f'{feature} > {threshold}')} - pow(sum({_GRADE}), 2) / count(*)"


@register(
    "m10_importances",
    W + "SELECT feature, CAST(sum(gain) AS FLOAT) AS importance FROM ("
    + " UNION ALL ".join(f"SELECT '{f}' AS feature, {_gain_sql(f, t)} AS gain FROM impressions" for f, t in _STUMPS)
    + ") GROUP BY feature UNION ALL SELECT 'prop_id', CAST(0 AS FLOAT)",
)
def q_m10(spark, sf):
    """Importances of stumps whose gains are measured on the whole log; an unused feature has 0."""
    gains = impressions(spark, sf).agg(*[F.expr(_gain_sql(f, t)).alias(f"g{i}") for i, (f, t) in enumerate(_STUMPS)]).first()
    names = ["prop_id", *dict.fromkeys(f for f, _ in _STUMPS)]
    trees = [Tree({"f": names.index(f), "t": t, "g": gains[i], "l": {"v": 0.0}, "r": {"v": 1.0}}, names) for i, (f, t) in enumerate(_STUMPS)]
    return norm_df(LambdaMARTModel(names, trees, 0.1, len(trees), None).importances_df(spark), ["importance"])
