"""Group-preserving train/validation split.

The test keys are the ``n`` keys with the smallest seeded hash. The n-th
smallest hash is found with the bracketing order statistic (no global sort,
no key list on the driver); each row then decides its side by comparing its
own key hash with that threshold — a filter, not a join. The hash is the start
of an MD5 over seed and key as text, so any engine draws the same split.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.operators.quantiles import order_statistics
from rankmill.schema import GROUP_COL

_HEX = 13  # hex digits of the hash: 52 bits, exact as a double


def _key_hash(group: str, seed: int):
    text = F.concat(F.lit(f"{int(seed)}:"), F.col(group).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, _HEX), 16, 10).cast("double")


def split_by_group(
    df: DataFrame,
    test_size: float = 0.2,
    seed: int = 42,
    group: str = GROUP_COL,
    rounding: str = "ceil",
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with every group on one side only and exactly
    ``ceil`` (or ``floor``) of ``test_size × groups`` groups in test."""
    keys = df.select(group).where(F.col(group).isNotNull()).distinct()
    n_keys = keys.count()
    raw = n_keys * float(test_size)
    n_test = math.ceil(raw - 1e-9) if rounding == "ceil" else math.floor(raw + 1e-9)
    h = _key_hash(group, seed)
    if n_test <= 0:
        return df, df.limit(0)
    if n_test >= n_keys:
        return df.limit(0), df
    vals = keys.select(h.alias("v"), group).persist()
    t = order_statistics(vals.select("v"), [n_test - 1], n_keys)[n_test - 1]
    below = vals.where(F.col("v") < F.lit(t)).count()
    # keys sharing the threshold hash (practically none): take the smallest keys
    ties = [r[group] for r in vals.where(F.col("v") == F.lit(t)).orderBy(group).limit(n_test - below).collect()]
    vals.unpersist()
    in_test = (h < F.lit(t)) | ((h == F.lit(t)) & F.col(group).isin(ties))
    return df.where(~in_test | F.col(group).isNull()), df.where(in_test)


def split_data_by_search_id(df: DataFrame, test_size: float = 0.2, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Loader-style split (M1): floor(n·p) test searches."""
    return split_by_group(df, test_size, seed, GROUP_COL, rounding="floor")


def split_data(df: DataFrame, test_size: float = 0.2, random_state: int = 42, group: str = GROUP_COL) -> tuple[DataFrame, DataFrame]:
    """Pipeline-style split (M2): ceil(n·p) validation searches, rows sorted
    by group on both sides."""
    train, val = split_by_group(df, test_size, random_state, group, rounding="ceil")
    return train.sortWithinPartitions(group), val.sortWithinPartitions(group)


def keep_groups(df: DataFrame, keys: DataFrame, group: str = GROUP_COL, keep: bool = True) -> DataFrame:
    """Membership filter and its complement by a key set (J2): a hash join, so
    that a task holds its part of the key set and sorts no rows."""
    return df.join(keys.select(group).hint("shuffle_hash"), group, "left_semi" if keep else "left_anti")
