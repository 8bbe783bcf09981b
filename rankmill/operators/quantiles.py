"""Exact quantiles that never gather a column into one task.

``percentile`` would merge every distinct value of a column in one task. Here
all wanted order statistics are bracketed together: each pass takes an
approximate quantile sketch (mergeable, fixed size) of every value region that
still holds a wanted rank, and counts the rows below and at the sketch's values,
which are values of the column. A rank that falls on such a value is found; the
others go on strictly between two of them. A region loses its pivots in every
pass, so the loop ends for any values (ties, neighbouring doubles, infinities),
and shrinks by a factor of about ``ACCURACY / 6``, so a pass is added only when
the rows grow that much. A pass is two jobs, whatever the number of quantiles.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankmill.operators.ranges import HOT_ROWS, key_ranges

ACCURACY = 10000


def _inside(lo: float | None, hi: float | None) -> Column:
    above = F.lit(True) if lo is None else F.col("v") > F.lit(lo)
    return above if hi is None else above & (F.col("v") < F.lit(hi))


def order_statistics(values: DataFrame, ks, n: int, accuracy: int = ACCURACY) -> dict[int, float]:
    """k-th smallest (0-based) value of the double column ``v`` for every k; n = number of rows."""
    found: dict[int, float] = {}
    # wanted rank -> (exclusive bounds, rows before the region, rows in it)
    wanted = {int(k): (None, None, 0, n) for k in ks}
    while wanted:
        regions = sorted(set(wanted.values()), key=lambda r: r[2])
        d = 3.0 / accuracy
        own = {k: [min(1.0, max(0.0, (k - start + 0.5) / size + e)) for e in (-d, 0.0, d)] for k, (_, _, start, size) in wanted.items()}
        probs = sorted({p for ps in own.values() for p in ps})
        region = F.coalesce(*[F.when(_inside(lo, hi), F.lit(i)) for i, (lo, hi, _, _) in enumerate(regions)])
        parts = values.select("v", region.alias("region")).where(F.col("region").isNotNull())
        sketch = {r["region"]: r["q"] for r in parts.groupBy("region").agg(F.percentile_approx("v", probs, accuracy).alias("q")).collect()}
        pivots = [sorted({sketch[i][probs.index(p)] for k, r in wanted.items() if r == reg for p in own[k]}) for i, reg in enumerate(regions)]
        aggs = []
        for i, (lo, _, _, _) in enumerate(regions):
            for j, p in enumerate(pivots[i]):
                aggs.append(F.count(F.when(_inside(lo, p), 1)).alias(f"lt_{i}_{j}"))
                aggs.append(F.count(F.when(F.col("v") == F.lit(p), 1)).alias(f"eq_{i}_{j}"))
        counts = values.agg(*aggs).first()
        for k, reg in list(wanted.items()):
            i = regions.index(reg)
            lo, hi, start, size = reg
            done = 0  # rows of the region up to and with the last pivot below k
            for j, p in enumerate(pivots[i]):
                lt, eq = counts[f"lt_{i}_{j}"], counts[f"eq_{i}_{j}"]
                if k - start < lt:
                    hi, size = p, lt - done
                    break
                if k - start < lt + eq:
                    found[k] = p
                    break
                lo, done = p, lt + eq
            else:
                size -= done
            if k in found:
                del wanted[k]
            else:
                wanted[k] = (lo, hi, start + done, size)
    return found


def exact_quantiles(df: DataFrame, column: str, probs, accuracy: int = ACCURACY) -> list:
    """Linear-interpolation quantiles (the SQL ``quantile_cont`` rule) of the
    non-null values of ``column``; None for an empty column. The pruned column
    is kept (memory, then disk) while the passes run."""
    values = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v")).persist()
    try:
        n = values.count()
        if n == 0:
            return [None for _ in probs]
        pos = [(n - 1) * float(p) for p in probs]
        vals = order_statistics(values, {k for x in pos for k in (math.floor(x), math.ceil(x))}, n, accuracy)
    finally:
        values.unpersist()
    out = []
    for x in pos:
        vlo, vhi = vals[math.floor(x)], vals[math.ceil(x)]
        out.append(vlo if vlo == vhi else vlo + (vhi - vlo) * (x - math.floor(x)))
    return out


def exact_quantile(df: DataFrame, column: str, p: float, **kw) -> float | None:
    return exact_quantiles(df, column, [p], **kw)[0]


def running_counts(hist: DataFrame, keys: list[str], value: str, count: str = "n", max_values: int = HOT_ROWS) -> DataFrame:
    """``hist`` with ``cum`` (rows of the key up to and with this value) and ``tot`` (rows of the key).

    ``hist`` has one row per (keys, value). A key with more than ``max_values`` values is cut
    into ranges at its own quantiles, however close its values lie, so that many tasks walk
    it; the ranges' totals give the counts before a range. Null values have count 0.
    """
    outer = Window.partitionBy(*keys)
    cut = key_ranges(hist, keys, F.coalesce(F.col(value).cast("double"), F.lit(float("nan"))), "_range", max_values)
    if cut is None:
        upto = outer.orderBy(F.col(value).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return hist.withColumns({"cum": F.sum(count).over(upto), "tot": F.sum(count).over(outer)})
    inner = Window.partitionBy(*keys, "_range").orderBy(F.col(value).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = cut.withColumn("_in", F.sum(count).over(inner))
    totals = hist.groupBy(*keys, "_range").agg(F.sum(count).alias("_n"))
    upto = outer.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = totals.select(*keys, "_range", (F.sum("_n").over(upto) - F.col("_n")).alias("_before"), F.sum("_n").over(outer).alias("tot"))
    out = hist.join(totals, [*keys, "_range"])
    return out.withColumn("cum", F.col("_in") + F.col("_before")).drop("_range", "_in", "_before")


def key_quantiles(df: DataFrame, key: str, column: str, probs, names, max_values: int = HOT_ROWS) -> DataFrame:
    """Exact per-key quantiles from a (key, value) histogram: the running counts
    walk distinct values, not rows, and split a hot key by value range."""
    hist = (
        df.where(F.col(key).isNotNull() & F.col(column).isNotNull())
        .groupBy(key, F.col(column).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    hist = running_counts(hist, [key], "v", max_values=max_values)
    start = F.col("cum") - F.col("n")
    aggs = []
    keep = None
    for p, name in zip(probs, names):
        pos = (F.col("tot") - 1) * F.lit(float(p))
        lo, hi = F.floor(pos), F.ceil(pos)
        has_lo = (start <= lo) & (lo < F.col("cum"))
        has_hi = (start <= hi) & (hi < F.col("cum"))
        cond = has_lo | has_hi
        keep = cond if keep is None else keep | cond
        hist = hist.withColumns({f"_lo_{name}": F.when(has_lo, F.col("v")), f"_hi_{name}": F.when(has_hi, F.col("v")), f"_f_{name}": pos - lo})
    picked = hist.where(keep)
    for name in names:
        vlo, vhi, fr = F.max(f"_lo_{name}"), F.max(f"_hi_{name}"), F.max(f"_f_{name}")
        aggs.append((vlo + (vhi - vlo) * fr).alias(name))
    return picked.groupBy(key).agg(*aggs)
