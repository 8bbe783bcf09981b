"""Run-log report (E3: S8 → A1 → A2–A4)."""

from __future__ import annotations

from pyspark.sql import SparkSession

from rankmill.operators import runs as R
from rankmill.sources.runlogs import read_run_logs


def summarize(spark: SparkSession, logs_dir: str, top_n: int = 10, recursive: bool = False, strict: bool = False) -> dict:
    """DataFrames of the executive summary: all runs, best run, its top
    importances and parameters, and the formatted run table."""
    runs = R.extract_metrics(read_run_logs(spark, logs_dir, recursive), strict=strict)
    best = R.best_run(runs)
    return {
        "runs": runs,
        "best": best,
        "top_importances": R.top_importances(best, top_n),
        "parameters": R.run_parameters(best),
        "table": R.formatted_runs(runs),
    }
