"""Run-log scan (S8): every JSON document in a folder, one row per run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

S, L, D = T.StringType(), T.LongType(), T.DoubleType()

_SHAPES = [
    "raw_train_shape", "final_processed_train_shape", "train_set_shape", "val_set_shape", "X_train_shape",
    "y_train_shape", "X_val_shape", "y_val_shape", "raw_test_shape", "final_processed_test_shape", "X_test_shape",
]

LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_timestamp", S),
        T.StructField("run_type", S),
        T.StructField("configuration", T.StructType([T.StructField("nrows_loaded_train", S), T.StructField("nrows_loaded_test", S)])),
        T.StructField(
            "data_summary",
            T.StructType(
                [T.StructField(n, S) for n in _SHAPES]
                + [T.StructField("num_train_groups", L), T.StructField("num_val_groups", L), T.StructField("num_features_used", S)]
            ),
        ),
        T.StructField("preprocessing_details", T.StructType([T.StructField("imputation_values_from_train", T.MapType(S, D))])),
        T.StructField(
            "features_used",
            T.StructType([T.StructField("all_feature_names", T.ArrayType(S)), T.StructField("categorical_feature_names", T.ArrayType(S))]),
        ),
        T.StructField(
            "model_training_results",
            T.StructType(
                [
                    T.StructField("parameters_used", T.MapType(S, S)),
                    T.StructField("training_duration_seconds", S),
                    T.StructField("validation_ndcg_at_5", S),
                ]
            ),
        ),
        T.StructField("model_performance", T.StructType([T.StructField("validation_ndcg_at_5", S), T.StructField("training_duration_seconds", S)])),
        T.StructField("model_details", T.StructType([T.StructField("parameters_used", T.MapType(S, S))])),
        T.StructField("feature_importances_gain", T.MapType(S, D)),
        T.StructField("_corrupt_record", S),
    ]
)


def read_run_logs(spark: SparkSession, logs_dir: str, recursive: bool = False) -> DataFrame:
    """All ``*.json`` documents of ``logs_dir``; undecodable files are dropped.

    A field whose JSON type does not fit (e.g. ``"Not available"`` where a map
    is expected) becomes null while the rest of the record is kept.
    """
    reader = (
        spark.read.schema(LOG_SCHEMA)
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("pathGlobFilter", "*.json")
    )
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    df = reader.json(logs_dir)
    return df.where(df["run_timestamp"].isNotNull()).drop("_corrupt_record")
