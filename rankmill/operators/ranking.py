"""Labels, ranked output and NDCG.

Top-k per search is written as ``row_number() … <= k``; Spark plans it with a
partial ``WindowGroupLimit`` before the shuffle, so each map task forwards at
most k rows per search and a hot search cannot flood one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankmill.functions.columns import require
from rankmill.operators.ranges import HOT_ROWS, hot_keys, join_null_safe, numbered, order_columns
from rankmill.schema import BOOKING_COL, CLICK_COL, GROUP_COL, ITEM_COL, LABEL_COL

# fixed values: relevance grades for booking / click / neither
GRADE_BOOKED = 5
GRADE_CLICKED = 1
GRADE_NONE = 0


def relevance_col(booking: str = BOOKING_COL, click: str = CLICK_COL) -> Column:
    return (
        F.when(F.col(booking) == 1, F.lit(GRADE_BOOKED))
        .when(F.col(click) == 1, F.lit(GRADE_CLICKED))
        .otherwise(F.lit(GRADE_NONE))
    )


def add_relevance(df: DataFrame, out: str = LABEL_COL) -> DataFrame:
    """Graded label 5 / 1 / 0 (K24); raises if the label columns are absent."""
    require(df, [BOOKING_COL, CLICK_COL], on_missing="raise")
    return df.withColumn(out, relevance_col())


def _best_first(score: str, tiebreak) -> list[tuple[str, bool]]:
    return [(score, True)] + [(c, False) for c in tiebreak]


def _order(score: str, tiebreak) -> list[Column]:
    return order_columns(_best_first(score, tiebreak))


def rank_in_group(df: DataFrame, score: str, group: str = GROUP_COL, tiebreak=(ITEM_COL,), out: str = "rank", max_rows: int = HOT_ROWS) -> DataFrame:
    """1-based position of each row in its group, best score first (O1).

    A group with more than ``max_rows`` rows is ranked in two levels: inside ranges of
    the score (ties: of the tie-break columns), then by the totals of the ranges.
    """
    ranked, ranges = numbered(df, group, _best_first(score, tiebreak), out, max_rows)
    return ranked.drop(*ranges)


def top_k(df: DataFrame, k: int, score: str, group: str = GROUP_COL, tiebreak=(ITEM_COL,), out: str = "rank") -> DataFrame:
    """The best ``k`` rows of each group with their position."""
    w = Window.partitionBy(group).orderBy(*_order(score, tiebreak))
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= k)


def range_count(df: DataFrame, rows_per_range: int = HOT_ROWS) -> int:
    """Number of partitions for an ordered output of ``df``: one per ``rows_per_range`` rows, and
    at least the cluster's parallelism. Given as a number, so that AQE does not join them."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_range))


def submission(
    df: DataFrame,
    score: str = "relevance_score",
    group: str = GROUP_COL,
    item: str = ITEM_COL,
    tiebreak=(ITEM_COL,),
    rows_per_range: int = HOT_ROWS,
) -> DataFrame:
    """Ranked list (M7): ``SearchId, PropertyId`` best first within each search.

    The order is materialised as a range partitioning on the search id and the
    score plus a sort inside partitions (O2), so written part files are globally
    ordered without a single-task global sort, and one hot search is spread over
    several of them. The number of ranges follows the measured row count.
    """
    ties = [F.col(f"_t{i}").asc_nulls_last() for i in range(len(tiebreak))]
    rows = df.select(F.col(group).alias("SearchId"), F.col(item).alias("PropertyId"), F.col(score).alias("_s"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tiebreak)])
    return (
        rows.repartitionByRange(range_count(df.select(group), rows_per_range), "SearchId", F.col("_s").desc_nulls_last(), *ties)
        .sortWithinPartitions("SearchId", F.col("_s").desc_nulls_last(), *ties)
        .select("SearchId", "PropertyId")
    )


def sort_by_group(df: DataFrame, group: str = GROUP_COL, max_rows: int = HOT_ROWS) -> DataFrame:
    """Rows clustered and ordered by group (O2).

    A group with more than ``max_rows`` rows is cut into slices by a hash of its rows,
    which lie behind one another in consecutive partitions.
    """
    n = range_count(df.select(group), max_rows)
    found = hot_keys(df.select(group), [group], max_rows)
    if found is None:
        return df.repartitionByRange(n, group).sortWithinPartitions(group)
    slices = found[0].select(group, F.ceil(F.col("_n") / max_rows).alias("_slices"))
    cut = join_null_safe(df, slices, [group], "left")
    row = F.xxhash64(*[F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")])
    cut = cut.withColumn("_slice", F.when(F.col("_slices").isNull(), F.lit(0)).otherwise(F.pmod(row, F.col("_slices"))))
    return cut.repartitionByRange(n, group, "_slice").sortWithinPartitions(group, "_slice").drop("_slices", "_slice")


def gain(rel: Column) -> Column:
    """Exponential gain 2^rel − 1."""
    return F.pow(F.lit(2.0), rel.cast("double")) - F.lit(1.0)


def discount(pos: Column) -> Column:
    """1 / log2(pos + 1) for 1-based positions."""
    return F.lit(1.0) / F.log2(pos.cast("double") + F.lit(1.0))


def ndcg_per_group(
    df: DataFrame,
    score: str,
    label: str = LABEL_COL,
    group: str = GROUP_COL,
    k: int = 5,
    tiebreak=(ITEM_COL,),
    empty_group: str = "one",
) -> DataFrame:
    """NDCG@k of each group (M9): ``(group, dcg, idcg, ndcg)``.

    Ties in the score are ordered by ``tiebreak`` and then by the label
    ascending (pessimistic), so the result is deterministic. Groups without a
    positive label get NDCG 1 (``"one"``), 0 (``"zero"``) or are dropped
    (``"skip"``).
    """
    if empty_group not in ("one", "zero", "skip"):
        raise ValueError("empty_group must be one, zero or skip")
    base = df.select(group, score, label, *tiebreak)
    actual_w = Window.partitionBy(group).orderBy(*_order(score, tiebreak), F.col(label).asc())
    ideal_w = Window.partitionBy(group).orderBy(F.col(label).desc())
    dcg = (
        base.withColumn("_p", F.row_number().over(actual_w))
        .where(F.col("_p") <= k)
        .groupBy(group)
        .agg(F.sum(gain(F.col(label)) * discount(F.col("_p"))).alias("dcg"))
    )
    idcg = (
        base.withColumn("_p", F.row_number().over(ideal_w))
        .where(F.col("_p") <= k)
        .groupBy(group)
        .agg(F.sum(gain(F.col(label)) * discount(F.col("_p"))).alias("idcg"))
    )
    out = dcg.join(idcg, group)
    if empty_group == "skip":
        out = out.where(F.col("idcg") > 0)
    empty = F.lit(1.0) if empty_group == "one" else F.lit(0.0)
    return out.withColumn("ndcg", F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(empty))


def mean_ndcg(df: DataFrame, score: str, label: str = LABEL_COL, group: str = GROUP_COL, k: int = 5, tiebreak=(ITEM_COL,), empty_group: str = "one") -> DataFrame:
    """One row: mean NDCG@k over groups and the number of groups."""
    per = ndcg_per_group(df, score, label, group, k, tiebreak, empty_group)
    return per.agg(F.avg("ndcg").alias(f"ndcg_at_{k}"), F.count(F.lit(1)).alias("num_groups"))


def ndcg_value(df: DataFrame, score: str, **kw) -> float | None:
    k = kw.get("k", 5)
    return mean_ndcg(df, score, **kw).first()[f"ndcg_at_{k}"]


def dedupe_keys(df: DataFrame, keys=(GROUP_COL, ITEM_COL)) -> DataFrame:
    """One row per key combination (O9), deterministically the row with the
    smallest remaining values (struct order). An aggregate, not a window, so
    Spark reduces duplicates inside each map task before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    return df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*")
