"""Run-log analysis (A1–A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankmill.functions.scalar import fmt_number, parse_number


def extract_metrics(logs: DataFrame, strict: bool = False) -> DataFrame:
    """One row per run (A1), best NDCG first, runs without a score last.

    ``strict=True`` reads the score only where full runs store it; otherwise
    train-only runs (score under ``model_performance``) are read as well.
    """
    ndcg = parse_number(F.col("model_training_results.validation_ndcg_at_5"))
    if not strict:
        ndcg = F.coalesce(ndcg, parse_number(F.col("model_performance.validation_ndcg_at_5")))
    dur = F.coalesce(F.col("model_training_results.training_duration_seconds"), F.col("model_performance.training_duration_seconds"))
    params = F.coalesce(F.col("model_training_results.parameters_used"), F.col("model_details.parameters_used"))
    return logs.select(
        F.coalesce(F.col("run_timestamp"), F.lit("N/A")).alias("timestamp"),
        ndcg.alias("ndcg_at_5"),
        dur.try_cast("double").alias("training_seconds"),
        F.col("data_summary.num_features_used").try_cast("long").alias("num_features"),
        F.coalesce(F.col("configuration.nrows_loaded_train"), F.lit("N/A")).alias("nrows_train"),
        F.col("feature_importances_gain").alias("importances"),
        params.alias("parameters"),
    ).orderBy(F.desc_nulls_last("ndcg_at_5"), "timestamp")


def best_run(runs: DataFrame) -> DataFrame:
    """The run with the highest score among runs that have one (A2)."""
    return runs.where(F.col("ndcg_at_5").isNotNull()).orderBy(F.desc("ndcg_at_5"), "timestamp").limit(1)


def top_importances(best: DataFrame, k: int = 10) -> DataFrame:
    """Top-k (feature, importance) of a run."""
    ex = best.select("timestamp", F.explode("importances").alias("feature", "importance"))
    w = Window.partitionBy("timestamp").orderBy(F.desc("importance"), "feature")
    return ex.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def run_parameters(best: DataFrame) -> DataFrame:
    """(parameter, value) rows of a run (A3)."""
    return best.select("timestamp", F.explode("parameters").alias("parameter", "value"))


def formatted_runs(runs: DataFrame) -> DataFrame:
    """Display table (A4): score with 4 and time with 2 decimals, N/A for null."""
    return runs.select(
        "timestamp",
        fmt_number("ndcg_at_5", 4).alias("ndcg_at_5"),
        fmt_number("training_seconds", 2).alias("training_seconds"),
        F.col("num_features"),
        F.col("nrows_train"),
    )
