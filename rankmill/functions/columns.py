"""Column selection by list, type and name pattern."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankmill.schema import CATEGORICAL_COLS, EXCLUDED_FEATURE_COLS


class MissingColumnsError(ValueError):
    pass


def require(df: DataFrame, cols, on_missing: str = "skip") -> bool:
    """Presence guard (P10): True if all ``cols`` exist; otherwise raise
    (``on_missing="raise"``) or return False (``"skip"``)."""
    missing = [c for c in cols if c not in df.columns]
    if missing and on_missing == "raise":
        raise MissingColumnsError(f"DataFrame must contain columns {missing}")
    return not missing


def feature_columns(df: DataFrame, excluded=EXCLUDED_FEATURE_COLS) -> list[str]:
    """All columns except ids, labels and leakage columns."""
    return [c for c in df.columns if c not in set(excluded)]


def categorical_columns(features: list[str], candidates=CATEGORICAL_COLS) -> list[str]:
    """Candidates that are present among the features, in candidate order."""
    present = set(features)
    return [c for c in candidates if c in present]


def align_to(df: DataFrame, features: list[str], keep: list[str] = ()) -> DataFrame:
    """Test-to-train alignment (P3): absent features are added as 0 and the
    features are put in training order; ``keep`` columns are carried in front."""
    have = set(df.columns)
    cols = [F.col(c) for c in keep if c in have]
    cols += [F.col(c) if c in have else F.lit(0).alias(c) for c in features]
    return df.select(*cols)


def missing_from(features: list[str], df: DataFrame) -> list[str]:
    """Column-set difference."""
    have = set(df.columns)
    return [c for c in features if c not in have]


_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def feature_types(df: DataFrame) -> dict[str, list[str]]:
    """Columns grouped as categorical / numerical / boolean / datetime."""
    out = {"categorical": [], "numerical": [], "boolean": [], "datetime": []}
    for f in df.schema.fields:
        t = f.dataType
        if isinstance(t, (T.StringType,)):
            out["categorical"].append(f.name)
        elif isinstance(t, _NUMERIC):
            out["numerical"].append(f.name)
        elif isinstance(t, T.BooleanType):
            out["boolean"].append(f.name)
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            out["datetime"].append(f.name)
    return out


def numeric_columns(df: DataFrame, include_bool: bool = False) -> list[str]:
    kinds = feature_types(df)
    return kinds["numerical"] + (kinds["boolean"] if include_bool else [])


def competitor_columns(df: DataFrame) -> list[str]:
    """Columns named like ``comp…`` and rate/inv/diff (P5)."""
    return [c for c in df.columns if "comp" in c and re.search(r"rate|inv|diff", c)]


def stack_rows(entries, names: list[str]):
    """Generator column turning each row into ``len(entries)`` rows, one per
    entry (a list of Columns, one per output name). ``stack`` emits rows
    directly inside the generated code, without building an array of structs
    per input row."""
    flat = [c for e in entries for c in e]
    return F.stack(F.lit(len(entries)), *flat).alias(*names)
