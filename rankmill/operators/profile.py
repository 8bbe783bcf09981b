"""Table profiling.

Every profile is one aggregate pass over the pruned columns; per-column
results are unpivoted into long tables so their size never depends on rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.functions.columns import stack_rows
from rankmill.operators.quantiles import exact_quantiles


def shape(df: DataFrame) -> DataFrame:
    """(rows, columns) of a table."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def _unpivot(one_row: DataFrame, cols: list[str], name: str, value: str) -> DataFrame:
    return one_row.unpivot([], cols, name, value)


def missing_stats(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing-value table (G10, B11): columns with at least one null, with
    count and percentage, sorted by percentage descending."""
    cols = cols or df.columns
    counts = df.agg(F.count(F.lit(1)).alias("__n"), *[(F.count(F.lit(1)) - F.count(c)).alias(c) for c in cols])
    long = counts.select("__n", stack_rows([[F.lit(c), F.col(c).cast("long")] for c in cols], ["column_name", "missing_values"]))
    return (
        long.where(F.col("missing_values") > 0)
        .select("column_name", "missing_values", (F.col("missing_values") * F.lit(100.0) / F.col("__n")).alias("percentage"))
        .orderBy(F.desc("percentage"), "column_name")
    )


def missing_share(df: DataFrame, column: str) -> DataFrame:
    """Percentage of nulls in one column."""
    return df.agg(F.try_divide((F.count(F.lit(1)) - F.count(column)) * F.lit(100.0), F.count(F.lit(1))).alias("missing_percentage"))


def distinct_counts(df: DataFrame, cols: list[str] | None = None, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct non-null values per column.

    Exact: columns are grouped by type family (whole numbers, reals, instants,
    text) and every row is unpivoted to typed (column, value) pairs with
    ``stack``; duplicates collapse in each map task, then the distinct pairs are
    counted per column. No number or instant becomes text, and 0.0 and -0.0
    count once.
    ``approx`` uses HyperLogLog++ sketches instead.
    """
    cols = cols or df.columns
    if approx:
        one = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in cols])
        return one.select(stack_rows([[F.lit(c), F.col(c).cast("long")] for c in cols], ["column_name", "distinct_values"]))
    families: dict[str, list] = {}
    for c, t in df.dtypes:
        if c in cols:
            kind = "long" if t in ("tinyint", "smallint", "int", "bigint", "boolean") else "double" if t in ("double", "float") else t if t in ("timestamp", "timestamp_ntz", "date") else "string"
            v = F.col(c).cast(kind)
            families.setdefault(kind, []).append([F.lit(c), F.when(v == 0, F.lit(0.0)).otherwise(v) if kind == "double" else v])
    counts = None
    for entries in families.values():
        long = df.select(stack_rows(entries, ["column_name", "v"])).where(F.col("v").isNotNull())
        part = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("_n")).groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
        counts = part if counts is None else counts.unionByName(part)
    names = df.sparkSession.createDataFrame([(c,) for c in cols], "column_name string")
    return names.join(counts, "column_name", "left").select("column_name", F.coalesce("distinct_values", F.lit(0)).cast("long").alias("distinct_values"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Number of rows that repeat an earlier identical row (G9); nulls compare
    equal. Duplicates collapse inside each map task before the shuffle."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c")).agg(
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("duplicates")
    )


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """count, mean, std, min, 25 %, 50 %, 75 %, max per column (G12) with
    exact quantiles. The pruned columns are kept (memory, then disk), so that
    ``df`` runs once, whatever the number of columns."""
    aggs = []
    for c in cols:
        aggs += [
            F.count(c).alias(f"{c}__count"),
            F.avg(c).alias(f"{c}__mean"),
            F.stddev_samp(c).alias(f"{c}__std"),
            F.min(F.col(c).cast("double")).alias(f"{c}__min"),
            F.max(F.col(c).cast("double")).alias(f"{c}__max"),
        ]
    values = df.select(*dict.fromkeys(cols)).persist()
    try:
        one = values.agg(*aggs).first()
        quantiles = {c: exact_quantiles(values, c, [0.25, 0.5, 0.75]) for c in cols}
    finally:
        values.unpersist()
    rows = [(c, one[f"{c}__count"], one[f"{c}__mean"], one[f"{c}__std"], one[f"{c}__min"], *quantiles[c], one[f"{c}__max"]) for c in cols]
    reals = ", ".join(f"{name} double" for name in ("mean", "std", "min", "p25", "p50", "p75", "max"))
    return df.sparkSession.createDataFrame(rows, f"column_name string, count long, {reals}")


def min_max(df: DataFrame, column: str) -> DataFrame:
    """min and max of a column (G19); null for an all-null column."""
    return df.agg(F.min(column).alias("min_value"), F.max(column).alias("max_value"))


def any_all(df: DataFrame, cond) -> DataFrame:
    """Whether any / all rows satisfy ``cond`` (G21); null conditions count as false."""
    c = F.coalesce(cond, F.lit(False))
    return df.agg(F.coalesce(F.bool_or(c), F.lit(False)).alias("any_true"), F.coalesce(F.bool_and(c), F.lit(True)).alias("all_true"))


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    """Distinct key set."""
    return df.select(key).distinct()
