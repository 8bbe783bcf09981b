"""Tables behind the notebook plots.

Bin edges are a handful of scalars computed by Spark jobs; bucketing is a
column expression and the counts are partial aggregates.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.operators.quantiles import exact_quantiles, key_quantiles
from rankmill.operators.stats import rate_by


def quantile_edges(df: DataFrame, column: str, q: int) -> list[float]:
    """Sorted distinct quantile edges 0, 1/q, …, 1 (duplicates dropped)."""
    edges = exact_quantiles(df, column, [i / q for i in range(q + 1)])
    if edges[0] is None:
        return []
    return sorted(set(edges))


def bucket_expr(column: str, edges: list[float]):
    """1-based bucket with (lo, hi] intervals, the minimum in bucket 1."""
    arr = F.array(*[F.lit(float(e)) for e in edges])
    below = F.size(F.filter(arr, lambda e: e < F.col(column)))
    return F.when(F.col(column).isNotNull(), F.greatest(F.lit(1), below))


def quantile_bucket_rates(df: DataFrame, column: str, target: str, q: int = 4) -> DataFrame:
    """Mean and count of ``target`` per quantile bucket of ``column`` over the
    non-null values (B1 + B2); no rows when fewer than two distinct edges."""
    base = df.where(F.col(column).isNotNull())
    edges = quantile_edges(base, column, q)
    if len(edges) < 2:
        return df.sparkSession.createDataFrame([], "bucket int, lower double, upper double, mean double, count long")
    arr = F.array(*[F.lit(float(e)) for e in edges])
    out = rate_by(base, ("bucket", bucket_expr(column, edges)), target)
    return out.select(
        "bucket",
        F.element_at(arr, F.col("bucket")).alias("lower"),
        F.element_at(arr, F.col("bucket") + 1).alias("upper"),
        "mean",
        "count",
    )


def _nonsingular(lo: float, hi: float, expander: float = 0.1) -> tuple[float, float]:
    if lo == hi:
        if lo == 0:
            return -expander, expander
        return lo - expander * abs(lo), hi + expander * abs(hi)
    return lo, hi


def histogram(df: DataFrame, column, bins: int, name: str = "value") -> DataFrame:
    """Equal-width histogram (B3): every bin 1..bins with its edges and count;
    the last bin is closed. ``column`` may be a Column (e.g. a log1p)."""
    expr = F.col(column) if isinstance(column, str) else column
    vals = df.select(expr.cast("double").alias(name)).where(F.col(name).isNotNull())
    mm = vals.agg(F.min(name).alias("lo"), F.max(name).alias("hi")).first()
    spark = df.sparkSession
    if mm["lo"] is None:
        return spark.createDataFrame([], f"bin int, lower double, upper double, count long")
    lo, hi = mm["lo"], mm["hi"]
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    idx = F.least(F.floor((F.col(name) - F.lit(lo)) * F.lit(bins / (hi - lo))).cast("int") + 1, F.lit(bins))
    counts = vals.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    allbins = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    return (
        allbins.join(counts, "bin", "left")
        .select(
            "bin",
            (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lower"),
            (F.lit(lo) + F.col("bin") * F.lit(width)).alias("upper"),
            F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count"),
        )
    )


def log_histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Histogram of log1p values; no rows unless some value is positive."""
    if not df.where(F.col(column) > 0).limit(1).count():
        return df.sparkSession.createDataFrame([], "bin int, lower double, upper double, count long")
    return histogram(df.where(F.col(column).isNotNull()), F.log1p(F.col(column)), bins, "log1p_value")


def category_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Bar counts by category (B5) or by category and hue (B6), nulls dropped."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond).groupBy(*cols).agg(F.count(F.lit(1)).alias("count"))


def box_stats(df: DataFrame, column: str) -> DataFrame:
    """Box-plot numbers over the non-null values (B7): quartiles, whiskers at
    the furthest values within 1.5·IQR, outlier count."""
    q1, med, q3 = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    c = F.col(column)
    if q1 is None:
        return df.sparkSession.createDataFrame([], "q1 double, median double, q3 double, whisker_low double, whisker_high double, outliers long")
    iqr = q3 - q1
    lo_f, hi_f = q1 - 1.5 * iqr, q3 + 1.5 * iqr
    return df.where(c.isNotNull()).agg(
        F.lit(q1).alias("q1"),
        F.lit(med).alias("median"),
        F.lit(q3).alias("q3"),
        F.min(F.when(c >= lo_f, c.cast("double"))).alias("whisker_low"),
        F.max(F.when(c <= hi_f, c.cast("double"))).alias("whisker_high"),
        F.count(F.when((c < lo_f) | (c > hi_f), 1)).alias("outliers"),
    )


def box_stats_by(df: DataFrame, by: str, column: str) -> DataFrame:
    """Box-plot numbers per group (B8); quartiles from per-group histograms."""
    base = df.where(F.col(by).isNotNull() & F.col(column).isNotNull())
    q = key_quantiles(base, by, column, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    q = q.withColumns({"lo_f": F.col("q1") - (F.col("q3") - F.col("q1")) * 1.5, "hi_f": F.col("q3") + (F.col("q3") - F.col("q1")) * 1.5})
    c = F.col(column).cast("double")
    return (
        base.join(q, by)
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(c >= F.col("lo_f"), c)).alias("whisker_low"),
            F.max(F.when(c <= F.col("hi_f"), c)).alias("whisker_high"),
            F.count(F.when((c < F.col("lo_f")) | (c > F.col("hi_f")), 1)).alias("outliers"),
        )
    )


def between_quantiles(df: DataFrame, column: str, lo_p: float | None, hi_p: float | None) -> DataFrame:
    """Rows whose value lies within the given quantiles (outlier cut for B8)."""
    ps = [p for p in (lo_p, hi_p) if p is not None]
    qs = dict(zip(ps, exact_quantiles(df, column, ps)))
    cond = F.lit(True)
    if lo_p is not None:
        cond = cond & (F.col(column) >= F.lit(qs[lo_p]))
    if hi_p is not None:
        cond = cond & (F.col(column) <= F.lit(qs[hi_p]))
    return df.where(cond)


def hexbin_counts(df: DataFrame, x, y, gridsize: int = 50) -> DataFrame:
    """Hexagonal-cell counts (B9), matplotlib's lattice rule: two offset grids,
    each point goes to the nearer centre; cells with at least one point."""
    cx = F.col(x) if isinstance(x, str) else x
    cy = F.col(y) if isinstance(y, str) else y
    pts = df.select(cx.cast("double").alias("x"), cy.cast("double").alias("y")).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    mm = pts.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
    if mm[0] is None:
        return df.sparkSession.createDataFrame([], "lattice int, i long, j long, count long")
    xmin, xmax = _nonsingular(mm[0], mm[1])
    ymin, ymax = _nonsingular(mm[2], mm[3])
    nx = gridsize
    ny = int(nx / math.sqrt(3))
    pad = 1.0e-9 * (xmax - xmin)
    xmin, xmax = xmin - pad, xmax + pad
    sx, sy = (xmax - xmin) / nx, (ymax - ymin) / ny
    ix = (F.col("x") - F.lit(xmin)) / F.lit(sx)
    iy = (F.col("y") - F.lit(ymin)) / F.lit(sy)
    pts = pts.select(ix.alias("ix"), iy.alias("iy"))
    ix1, iy1 = F.bround("ix"), F.bround("iy")
    ix2, iy2 = F.floor("ix"), F.floor("iy")
    d1 = F.pow(F.col("ix") - ix1, 2) + F.lit(3.0) * F.pow(F.col("iy") - iy1, 2)
    d2 = F.pow(F.col("ix") - ix2 - 0.5, 2) + F.lit(3.0) * F.pow(F.col("iy") - iy2 - 0.5, 2)
    first = d1 < d2
    cells = pts.select(
        F.when(first, F.lit(1)).otherwise(F.lit(2)).alias("lattice"),
        F.when(first, ix1).otherwise(ix2).cast("long").alias("i"),
        F.when(first, iy1).otherwise(iy2).cast("long").alias("j"),
    )
    return cells.groupBy("lattice", "i", "j").agg(F.count(F.lit(1)).alias("count"))


def seeded_sample(df: DataFrame, n: int, seed: int = 42, key_cols: list[str] | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows chosen by a seeded hash order (O8, B10): the
    MD5 of seed and key columns as text, so any engine draws the same sample.

    ``orderBy(hash).limit(n)`` runs as a per-partition top-n followed by one
    merge of at most n rows per partition, so the sample is bounded by n.
    """
    cols = key_cols or df.columns
    text = F.concat_ws("|", F.lit(str(int(seed))), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    rest = [c for c in df.columns if c not in cols]
    return df.withColumn("_h", F.md5(text)).orderBy("_h", *cols, *rest).limit(n).drop("_h")
