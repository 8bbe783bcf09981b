"""Train → predict → submission → run log (E1: K25, M3, M5, M8, S4, S5)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.functions.columns import align_to, categorical_columns, feature_columns
from rankmill.functions.scalar import run_timestamp
from rankmill.operators.features import engineer_features, prop_table
from rankmill.operators.impute import handle_missing_values
from rankmill.operators.ranker import LambdaMART, LambdaMARTModel
from rankmill.operators.ranking import add_relevance, submission
from rankmill.operators.split import split_data
from rankmill.schema import GROUP_COL, ITEM_COL, LABEL_COL
from rankmill.sources.files import ensure_not_empty, write_json, write_submission


def prepare(
    df: DataFrame,
    is_train: bool = True,
    imputation_params: dict | None = None,
    impute: bool = True,
    engineer: bool = True,
    profile: str = "default",
    hotel_stats: DataFrame | None = None,
):
    """Impute, then engineer (K25); returns (frame, imputation params)."""
    params = None
    if impute:
        df, params = handle_missing_values(df, is_train=is_train, imputation_values=imputation_params)
    if engineer:
        df = engineer_features(df, profile, hotel_stats)
    return df, params


def prepare_features_and_target(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Relevance label and feature list (M3)."""
    out = add_relevance(df)
    feats = feature_columns(out)
    if not feats:
        raise ValueError("the frame has no column left that can serve as a feature")
    return out, feats


def train_model(train: DataFrame, val: DataFrame, features: list[str], params: dict | None = None, on_round=None) -> tuple[LambdaMARTModel, dict]:
    """Fit and report (M5): model plus duration, parameters, best NDCG@5. The
    categorical candidates among the features (P2) are split by sets of values."""
    ranker = LambdaMART(**(params or {}))
    model = ranker.fit(train, features, val, on_round=on_round, categorical=categorical_columns(features))
    info = {
        "parameters_used": model.params,
        "training_duration_seconds": f"{model.training_seconds:.2f}",
        "validation_ndcg_at_5": model.best_score if model.best_score is not None else "Not available",
        "best_iteration": model.best_iteration,
    }
    return model, info


def predict(model: LambdaMARTModel, test: DataFrame, imputation_params: dict | None, profile: str = "default") -> DataFrame:
    """Impute with training values, engineer, align, score (M8)."""
    processed, _ = prepare(test, is_train=False, imputation_params=imputation_params, profile=profile)
    aligned = align_to(processed, model.features, keep=[GROUP_COL, ITEM_COL])
    return model.transform(aligned)


def _shape(df: DataFrame, columns: int | None = None) -> str:
    n = len(df.columns) if columns is None else columns
    return str((df.count(), n) if n else (df.count(),))


def _now(df: DataFrame) -> str:
    return df.sparkSession.range(1).select(run_timestamp()).first()[0]


def _trained(train_raw: DataFrame, params, profile, on_round):
    """Prepare, split and fit: the steps that both kinds of run share."""
    ensure_not_empty(train_raw, "training data")
    processed, imputation = prepare(train_raw, is_train=True, profile=profile)
    # cut lineage once: every later stage re-reads the engineered table
    processed = processed.checkpoint()
    final, feats = prepare_features_and_target(processed)
    train, val = split_data(final)
    model, info = train_model(train, val, feats, params, on_round)
    # fixed values: the field names of a run's record
    summary = {
        "raw_train_shape": _shape(train_raw),
        "final_processed_train_shape": _shape(processed),
        "train_set_shape": _shape(train),
        "val_set_shape": _shape(val),
        "X_train_shape": _shape(train, len(feats)),
        "y_train_shape": _shape(train, 0),
        "X_val_shape": _shape(val, len(feats)),
        "y_val_shape": _shape(val, 0),
        "num_train_groups": train.select(GROUP_COL).distinct().count(),
        "num_val_groups": val.select(GROUP_COL).distinct().count(),
        "num_features_used": len(feats),
    }
    clean = {k: (None if isinstance(v, float) and math.isnan(v) else v) for k, v in (imputation or {}).items()}
    return model, info, feats, summary, imputation, clean or None


def run(
    train_raw: DataFrame,
    test_raw: DataFrame | None = None,
    submission_dir: str | None = None,
    log_dir: str | None = None,
    params: dict | None = None,
    profile: str = "default",
    on_round=None,
    nrows_train: int | str = "all",
    nrows_test: int | str = "all",
    hotel_stats: str = "own",
) -> dict:
    """The whole training run; returns the log record. ``nrows_*`` are the row
    limits that the caller loaded the frames with. ``hotel_stats`` "own" takes the
    test rows' hotel statistics from the test rows, "train" from the training rows."""
    if hotel_stats not in ("own", "train"):
        raise ValueError("hotel_stats must be own or train")
    ts = _now(train_raw)
    model, info, feats, summary, imputation, clean = _trained(train_raw, params, profile, on_round)
    if test_raw is not None:
        fitted = prop_table(handle_missing_values(train_raw)[0]) if hotel_stats == "train" else None
        processed, _ = prepare(test_raw, is_train=False, imputation_params=imputation, profile=profile, hotel_stats=fitted)
        aligned = align_to(processed, model.features, keep=[GROUP_COL, ITEM_COL])
        summary["raw_test_shape"] = _shape(test_raw)
        summary["final_processed_test_shape"] = _shape(processed)
        summary["X_test_shape"] = _shape(aligned, len(feats))
        if submission_dir:
            write_submission(submission(model.transform(aligned), "relevance_score"), f"{submission_dir.rstrip('/')}/submission_{ts}")
    log = {
        "run_timestamp": ts,
        "configuration": {"nrows_loaded_train": nrows_train, "nrows_loaded_test": nrows_test},
        "data_summary": summary,
        "preprocessing_details": {"imputation_values_from_train": clean},
        "features_used": {"all_feature_names": feats, "categorical_feature_names": model.categorical},
        "model_training_results": {k: info[k] for k in ("parameters_used", "training_duration_seconds", "validation_ndcg_at_5")},
        "feature_importances_gain": dict(model.feature_importances()) or "Not available",
    }
    if log_dir:
        write_json(train_raw.sparkSession, f"{log_dir.rstrip('/')}/training_log_{ts}.json", log)
    return log


def run_train_only(
    train_raw: DataFrame,
    log_dir: str | None = None,
    params: dict | None = None,
    profile: str = "default",
    on_round=None,
    nrows_train: int | str = "all",
) -> dict:
    """Training without a test file (S6): the record keeps the score as text
    under ``model_performance`` and has no importances."""
    ts = _now(train_raw)
    _, info, feats, summary, _, clean = _trained(train_raw, params, profile, on_round)
    log = {
        "run_timestamp": ts,
        "run_type": "train_only",
        "configuration": {"nrows_loaded_train": nrows_train},
        "data_summary": summary,
        "imputation_details": {"imputation_values_from_train": clean},
        "features_used": {"all_feature_names": feats},
        "model_details": {"parameters_used": info["parameters_used"]},
        "model_performance": {"validation_ndcg_at_5": str(info["validation_ndcg_at_5"]), "training_duration_seconds": info["training_duration_seconds"]},
    }
    if log_dir:
        write_json(train_raw.sparkSession, f"{log_dir.rstrip('/')}/train_only_log_{ts}.json", log)
    return log


def relevance_shares(df: DataFrame) -> DataFrame:
    """Share of each relevance grade, sorted by grade (G5 on the label)."""
    total = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy(LABEL_COL).agg((F.count(F.lit(1)) / total).alias("share")).orderBy(LABEL_COL)
