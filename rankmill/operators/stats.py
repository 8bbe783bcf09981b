"""Rates, counts, pivots, correlations and tests.

All are aggregates that Spark computes partially per map task; totals are
scalar sub-queries (``DataFrame.scalar``), so no table passes the driver.
"""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmill.operators.quantiles import exact_quantile
from rankmill.session import checkpoint_dir


def rate_by(df: DataFrame, by, target: str) -> DataFrame:
    """Mean and support of ``target`` per group (G1); ``by`` = column name or
    (name, Column) for a derived grouping such as a null indicator."""
    name, expr = (by, F.col(by)) if isinstance(by, str) else by
    return df.groupBy(expr.alias(name)).agg(F.avg(target).alias("mean"), F.count(target).alias("count"))


def percent_by(df: DataFrame, by: str, target: str, out: str = "rate_percent") -> DataFrame:
    """Mean per group as percentage."""
    return df.groupBy(by).agg((F.avg(target) * F.lit(100.0)).alias(out))


def group_sizes(df: DataFrame, key: str) -> DataFrame:
    """Rows per group."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("size"))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts of non-null values, most frequent first (G4, O5 with ``top``)."""
    out = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    out = out.orderBy(F.desc("count"), column)
    return out.limit(top) if top else out


def value_shares(df: DataFrame, column: str, percent: bool = False) -> DataFrame:
    """Normalised value counts sorted by value (G5); the total is a scalar
    sub-query."""
    base = df.where(F.col(column).isNotNull())
    total = base.select(F.count(F.lit(1))).scalar()
    scale = F.lit(100.0) if percent else F.lit(1.0)
    return (
        base.groupBy(column)
        .agg(F.count(F.lit(1)).alias("count"))
        .select(column, (F.col("count") * scale / total).alias("share"))
        .orderBy(column)
    )


def share_pivot(df: DataFrame, by, value: str, values: list, percent: bool = True, names: dict | None = None) -> DataFrame:
    """Share of each ``value`` within each group, one column per value with 0
    for absent combinations (G6)."""
    name, expr = (by, F.col(by)) if isinstance(by, str) else by
    piv = df.groupBy(expr.alias(name)).pivot(value, values).agg(F.count(F.lit(1))).fillna(0)
    vcols = [str(v) for v in values]
    total = sum((F.col(c) for c in vcols), F.lit(0))
    scale = F.lit(100.0) if percent else F.lit(1.0)
    names = names or {}
    return piv.select(name, *[(F.col(c) * scale / total).alias(names.get(c, f"share_{c}")) for c in vcols])


def crosstab(df: DataFrame, a: str, b: str, values: list) -> DataFrame:
    """Contingency table (G7): rows = values of ``a``, one count column per
    value of ``b`` (given, so no extra pass to discover them)."""
    piv = df.groupBy(a).pivot(b, values).agg(F.count(F.lit(1))).fillna(0)
    return piv.select(a, *[F.col(str(v)).cast("long").alias(f"{b}_{v}") for v in values])


def quantile_value(df: DataFrame, column: str, p: float) -> float | None:
    """Exact linear-interpolation quantile."""
    return exact_quantile(df, column, p)


def above_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """Threshold, count and share of rows above the p-quantile."""
    q = quantile_value(df, column, p)
    return df.agg(
        F.lit(q).cast("double").alias("threshold"),
        F.count(F.when(F.col(column) > F.lit(q), 1)).alias("count_above"),
        F.try_divide(F.count(F.when(F.col(column) > F.lit(q), 1)) * F.lit(100.0), F.count(F.lit(1))).alias("percent_above"),
    )


def match_share(df: DataFrame, a: str, b: str) -> DataFrame:
    """Percentage of rows where two columns are equal, null = no match."""
    return df.agg((F.avg(F.coalesce(F.col(a) == F.col(b), F.lit(False)).cast("double")) * F.lit(100.0)).alias("match_percent"))


def pearson(a: str | Column, b: str | Column) -> Column:
    """Pearson correlation over rows where both sides are present; null (not an
    error) when one side is constant (G16)."""
    ca = F.col(a) if isinstance(a, str) else a
    cb = F.col(b) if isinstance(b, str) else b
    both = ca.isNotNull() & cb.isNotNull()
    xa, xb = F.when(both, ca.cast("double")), F.when(both, cb.cast("double"))
    return F.try_divide(F.covar_samp(xa, xb), F.stddev_samp(xa) * F.stddev_samp(xb))


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(pearson(a, b).alias("correlation"))


def pair_correlations(df: DataFrame, cols: dict[str, Column], pairs: list[tuple[str, str]]) -> list[float | None]:
    """Pearson correlation of each pair over the rows where both sides are present.

    One pass over a vector of (present, centred value, square) per column: its
    Gram matrix, summed in the JVM and partially per task, holds the counts,
    sums, squares and products of every pair. Only that matrix of
    (3 columns)^2 numbers reaches the driver. Centring by the column means (a
    first, small pass) keeps the sums precise.
    """
    names = list(cols)
    means = df.agg(F.count(F.lit(1)).alias("n"), *[F.avg(c.cast("double")).alias(f"m{i}") for i, c in enumerate(cols.values())]).first()
    if not names or not means["n"]:
        return [None for _ in pairs]
    parts = []
    for i, c in enumerate(cols.values()):
        x = c.cast("double") - F.lit(float(means[f"m{i}"] or 0.0))
        parts += [c.isNotNull().cast("double"), F.coalesce(x, F.lit(0.0)), F.coalesce(x * x, F.lit(0.0))]
    vectors = MLUtils.convertVectorColumnsFromML(df.select(array_to_vector(F.array(*parts)).alias("v")), "v")
    # with the sizes given, the matrix runs ``df`` once
    g = RowMatrix(vectors, means["n"], 3 * len(names)).computeGramianMatrix().toArray()
    out = []
    for a, b in pairs:
        i, j = 3 * names.index(a), 3 * names.index(b)
        n, sx, sy = g[i, j], g[i + 1, j], g[i, j + 1]
        sxx, syy, sxy = g[i + 2, j], g[i, j + 2], g[i + 1, j + 1]
        vx, vy = (sxx - sx * sx / n, syy - sy * sy / n) if n >= 2 else (0.0, 0.0)
        # a constant side has no variance beyond rounding
        flat = n < 2 or vx <= 1e-12 * sxx or vy <= 1e-12 * syy
        out.append(None if flat else float((sxy - sx * sy / n) / math.sqrt(vx * vy)))
    return out


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """(col_a, col_b, correlation) for all pairs a < b in ``cols`` order."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    got = pair_correlations(df, {c: F.col(c) for c in cols}, pairs)
    return df.sparkSession.createDataFrame([(a, b, r) for (a, b), r in zip(pairs, got)], "col_a string, col_b string, correlation double")


def correlation_with(df: DataFrame, target: str, cols: list[str], fill_zero: list[str] = ()) -> DataFrame:
    """Correlation of each column with ``target`` (G18), sorted descending,
    target itself removed; ``fill_zero`` columns have nulls replaced by 0."""
    zero = set(fill_zero)
    src = {c: F.coalesce(F.col(c), F.lit(0)) if c in zero else F.col(c) for c in cols if c != target}
    got = pair_correlations(df, {**src, target: F.col(target)}, [(c, target) for c in src])
    out = df.sparkSession.createDataFrame(list(zip(src, got)), "feature string, correlation double")
    return out.orderBy(F.desc_nulls_last("correlation"), "feature")


MAX_CATEGORIES = 1000


def erfc_sql(z: str, terms: int = 60) -> str:
    """SQL text (for any engine) of the complementary error function of the
    column ``z`` >= 0: a power series below 3, a continued fraction above."""
    number = "{:.17e}".format
    series, fraction = number(1.0), z
    for n in range(terms, 0, -1):
        series = f"({number(1.0)} + {number(2 / (2 * n + 1))} * {z} * {z} * {series})"
        fraction = f"({z} + {number(n / 2)} / {fraction})"
    scale = f"exp(-{z} * {z}) * {number(1 / math.sqrt(math.pi))}"
    return f"CASE WHEN {z} < 3 THEN {number(1.0)} - 2 * {z} * {scale} * {series} ELSE {scale} / {fraction} END"


def chi2_2x2(df: DataFrame, a: str, b: str, correction: bool = True) -> DataFrame:
    """Chi-squared test of independence on the a × b contingency table.

    Cells without rows count as 0, so the table is all values of ``a`` times all
    of ``b`` (at most ``MAX_CATEGORIES`` each; both lists are checked). With one
    degree of freedom Yates' continuity correction is applied; the p-value of
    one degree of freedom is erfc(sqrt(x / 2)), null otherwise.
    """
    both = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    checkpoint_dir(df.sparkSession)
    # written: the plan below uses the cells many times, ``df`` runs once
    cells = both.groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count(F.lit(1)).cast("double").alias("o")).checkpoint()
    rows, cols = cells.groupBy("a").agg(F.sum("o").alias("ra")), cells.groupBy("b").agg(F.sum("o").alias("cb"))
    for side, name in ((rows, a), (cols, b)):
        if len(side.limit(MAX_CATEGORIES + 1).collect()) > MAX_CATEGORIES:
            raise ValueError(f"{name} has more than {MAX_CATEGORIES} values")
    total = cells.select(F.sum("o")).scalar()
    dof = (rows.select(F.count(F.lit(1))).scalar() - 1) * (cols.select(F.count(F.lit(1))).scalar() - 1)
    # two checked, small lists of values
    table = rows.crossJoin(F.broadcast(cols)).join(cells, ["a", "b"], "left").withColumn("o", F.coalesce("o", F.lit(0.0)))
    e = F.col("ra") * F.col("cb") / total
    diff = F.abs(F.col("o") - e)
    corr = F.when(dof == 1, F.least(F.lit(0.5 if correction else 0.0), diff)).otherwise(F.lit(0.0))
    res = table.agg(F.sum(F.pow(F.greatest(diff - corr, F.lit(0.0)), 2) / e).alias("chi2")).withColumn("dof", dof.cast("int"))
    res = res.withColumn("_z", F.sqrt(F.col("chi2") / 2.0))
    return res.withColumn("p_value", F.when(F.col("dof") == 1, F.expr(erfc_sql("_z")))).drop("_z")
