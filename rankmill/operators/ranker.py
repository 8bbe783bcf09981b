"""LambdaMART on Spark.

Each boosting round:

1. number the rows of every search by the current score;
2. pair every row in the top ``truncation_level`` positions with the rows
   ranked below it that carry a different label (J4, an equi-join on the
   search key; at most ``truncation_level`` partners per row, exactly the
   pairs the truncated LambdaRank objective sums over);
3. per pair, the LambdaRank gradient: ``ρ = 1 / (1 + e^{σ(s_hi − s_lo)})``,
   ``|ΔNDCG| = |G_hi − G_lo| · |D(p_i) − D(p_j)| / IDCG`` (divided by
   ``0.01 + |s_hi − s_lo|`` once scores differ), ``λ = −σ ρ |ΔNDCG|`` for the
   better row and ``+`` for the other, hessian ``σ² ρ (1 − ρ) |ΔNDCG|``;
   per search both are scaled by ``log2(1 + Σ|λ|) / Σ|λ|``;
4. fit a regression tree on target ``−g/h`` with weight ``h``: the weighted
   leaf mean is the Newton step ``−Σg / Σh`` and the weighted-variance split
   gain equals ``(Σg)² / Σh``;
5. ``score += learning_rate · tree``, evaluate NDCG@k on validation, stop after
   ``early_stopping_rounds`` rounds without gain and keep the best round.

**State.** The feature vectors are a static table; a round moves only the narrow
table (search, part, row, label, score). Both are hash-partitioned by (search,
part) and joined without a shuffle. Lineage is cut with reliable ``checkpoint()``
into the cluster's ``spark.checkpoint.dir``; a checkpoint that a newer one has
replaced is deleted.

**Hot searches.** A search with more than ``hot_rows`` rows is cut into parts of so
many rows, so no task holds it. Its ranks come from ranges of the score
(``ranges.numbered``), its top rows are copied to its ranges and paired there, and
the sums per row are added by (search, part). Where there is no such search, ranking,
pairing and sums run inside the partitions of the narrow table, without a shuffle.

**Categories.** Columns named as categorical are indexed by value (the most frequent
``max_categories`` values of each; 0 stands for null, unseen and rarer values) and
marked nominal in the vector's metadata, so that Spark's trees split them by sets of
values.

Rows of a search are told apart by item and a hash of their features, never by
the label, and score ties are ordered by item as in the NDCG operator, so the
reported validation score is that of the scored validation rows. Rows without
a search id belong to no search and take no part in training or validation.

A fitted model scores from flat node arrays: one Arrow-batched function walks
blocks of trees for a batch of rows at once, so neither the plan nor generated
code grows with the number of trees or leaves.
"""

from __future__ import annotations

import math
import threading
import time
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankmill.functions.columns import stack_rows
from rankmill.operators.ranges import HOT_ROWS, numbered
from rankmill.operators.ranking import discount, gain, mean_ndcg, range_count
from rankmill.schema import GROUP_COL, ITEM_COL, LABEL_COL
from rankmill.session import checkpoint_dir

# Spark trees do not route nulls: missing values go below every real value.
NULL_SENTINEL = -1.0e12
# Index of null, unseen and rare values of a categorical feature.
OTHER = 0
# While a model is fitted, joins on (search, part, row) reuse the partitioning by (search,
# part). An adaptive plan does not tell the partitioning of what it checkpoints or keeps,
# and has nothing to add here: hot searches are cut explicitly.
PLANNING = {"spark.sql.requireAllClusterKeysForCoPartition": "false", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
ROWS_PER_TASK = 100_000


@dataclass
class CategoryIndex:
    """Values of the categorical features and their index (from 1), fitted on training rows."""

    values: dict[str, list] = field(default_factory=dict)

    @staticmethod
    def fit(df: DataFrame, columns: list[str], max_categories: int) -> CategoryIndex:
        """The ``max_categories`` most frequent values of every column (ties: the smaller one), in one pass."""
        if not columns:
            return CategoryIndex()
        rows = df.select(stack_rows([[F.lit(i), _category(df, c).cast("string")] for i, c in enumerate(columns)], ["f", "v"]))
        counts = rows.where(F.col("v").isNotNull()).groupBy("f", "v").agg(F.count(F.lit(1)).alias("n"))
        order = Window.partitionBy("f").orderBy(F.desc("n"), "v")
        top = counts.withColumn("r", F.row_number().over(order)).where(F.col("r") <= max_categories).collect()
        number = {c: t != "string" for c, t in df.dtypes}
        found: dict[str, list] = {c: [] for c in columns}
        for r in sorted(top, key=lambda r: r["r"]):
            c = columns[r["f"]]
            found[c].append(float(r["v"]) if number[c] else r["v"])
        return CategoryIndex({c: sorted(v) for c, v in found.items()})

    def size(self, column: str) -> int:
        return len(self.values[column]) + 1

    def column(self, df: DataFrame, column: str) -> Column:
        """Index of the row's value as double."""
        pairs = [F.lit(x) for i, v in enumerate(self.values[column]) for x in (v, float(i + 1))]
        if not pairs:
            return F.lit(float(OTHER))
        return F.coalesce(F.try_element_at(F.create_map(*pairs), _category(df, column)), F.lit(float(OTHER)))


def _category(df: DataFrame, column: str) -> Column:
    """Value by which a category is told: text, or the number as double (-0.0 as 0.0)."""
    return F.col(column) if df.schema[column].dataType.simpleString() == "string" else F.col(column).cast("double") + F.lit(0.0)


def _feature(df: DataFrame, column: str, categories: CategoryIndex) -> Column:
    if column in categories.values:
        return categories.column(df, column)
    return F.coalesce(F.col(column).cast("double"), F.lit(NULL_SENTINEL))


def _nominal(column: str, categories: CategoryIndex) -> dict:
    """Column metadata by which Spark's trees know a categorical feature."""
    if column not in categories.values:
        return {}
    return {"ml_attr": {"type": "nominal", "num_vals": categories.size(column)}}


@dataclass
class Tree:
    """A fitted tree as nested dicts: {"f": idx, "t": thr, "l": …, "r": …}, {"f": idx, "in": [values that
    go left], "l": …, "r": …} or {"v": value}."""

    root: dict
    features: list[str]

    def nodes(self) -> list[tuple]:
        """(feature or -1, threshold or set of values, left, right, value) of every node, the root first."""
        out: list[list] = []

        def add(n) -> int:
            at = len(out)
            out.append([-1, 0.0, at, at, float(n.get("v", 0.0))])
            if "v" not in n:
                out[at][:2] = [int(n["f"]), frozenset(map(int, n["in"])) if "in" in n else float(n["t"])]
                out[at][2], out[at][3] = add(n["l"]), add(n["r"])
            return at

        add(self.root)
        return [tuple(x) for x in out]

    def gains(self) -> dict[str, float]:
        out: dict[str, float] = {}

        def walk(n):
            if "v" in n:
                return
            name = self.features[n["f"]]
            out[name] = out.get(name, 0.0) + n["g"]
            walk(n["l"])
            walk(n["r"])

        walk(self.root)
        return out


def forest_scorer(trees: list[Tree], rate: float, block: int = 32):
    """Arrow-batched function: array of feature values -> rate times the sum of the trees' values."""
    blocks = []
    for lo in range(0, len(trees), block):
        flat, roots = [], []
        for t in trees[lo : lo + block]:
            base = len(flat)
            roots.append(base)
            flat += [(f, x, left + base, right + base, v) for f, x, left, right, v in t.nodes()]
        f, x, left, right, v = zip(*flat)
        # row k of ``member``: the values that go left at the nodes whose set is k
        sets = sorted({c for c in x if isinstance(c, frozenset)}, key=sorted)
        member = np.zeros((len(sets) + 1, 2 + max((max(c, default=0) for c in sets), default=0)), bool)
        for k, c in enumerate(sets):
            member[k, list(c)] = True
        place = {c: k for k, c in enumerate(sets)}
        which = np.array([place[c] if isinstance(c, frozenset) else -1 for c in x])
        limit = np.array([0.0 if isinstance(c, frozenset) else c for c in x])
        blocks.append((np.array(roots), np.array(f), limit, which, member, np.array(left), np.array(right), np.array(v)))

    @F.pandas_udf("double")
    def score(rows: pd.Series) -> pd.Series:
        total = np.zeros(len(rows))
        if len(rows) and blocks:
            values = np.stack(rows.to_numpy())
            at_row = np.arange(len(values))[:, None]
            for roots, f, limit, which, member, left, right, v in blocks:
                node = np.broadcast_to(roots, (len(values), len(roots))).copy()
                while (f[node] >= 0).any():
                    x = values[at_row, np.maximum(f[node], 0)]
                    down = x <= limit[node]
                    by_set = which[node] >= 0
                    if by_set.any():
                        last = member.shape[1] - 1  # a value beyond all sets is in none
                        down[by_set] = member[which[node][by_set], np.clip(x[by_set], 0, last).astype(np.int64)]
                    node = np.where(down, left[node], right[node])
                for k in range(len(roots)):  # tree by tree, as training adds them
                    total += rate * v[node[:, k]]
        return pd.Series(total)

    return score


def _read_tree(java_model, index_map: list[int], reg_alpha: float = 0.0, reg_lambda: float = 0.0) -> dict:
    """Walk the JVM tree once (it has at most 2^depth leaves).

    A leaf's value is −G / H; L1 shrinks |G| by ``reg_alpha`` and L2 adds
    ``reg_lambda`` to H (H is the leaf's total weight).
    """

    def leaf(node) -> float:
        value = float(node.prediction())
        if not (reg_alpha or reg_lambda):
            return value
        h = float(node.impurityStats().count())
        return math.copysign(max(abs(value) * h - reg_alpha, 0.0), value) / (h + reg_lambda) if h + reg_lambda > 0 else 0.0

    def walk(node):
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            stats = node.impurityStats()
            by_set = split.getClass().getSimpleName() == "CategoricalSplit"
            return {
                "f": index_map[split.featureIndex()],
                **({"in": [int(c) for c in split.leftCategories()]} if by_set else {"t": float(split.threshold())}),
                "g": float(node.gain()) * float(stats.count()),
                "l": walk(node.leftChild()),
                "r": walk(node.rightChild()),
            }
        return {"v": leaf(node)}

    return walk(java_model.rootNode())


@dataclass
class LambdaMARTModel:
    features: list[str]
    trees: list[Tree]
    learning_rate: float
    best_iteration: int
    best_score: float | None
    history: list[dict] = field(default_factory=list)
    params: dict = field(default_factory=dict)
    training_seconds: float = 0.0
    categories: CategoryIndex = field(default_factory=CategoryIndex)

    @property
    def categorical(self) -> list[str]:
        """The features that the trees split by sets of values."""
        return list(self.categories.values)

    def score_expr(self, df: DataFrame, n_trees: int | None = None) -> Column:
        trees = self.trees[: n_trees if n_trees is not None else self.best_iteration]
        return forest_scorer(trees, self.learning_rate)(F.array(*[_feature(df, c, self.categories) for c in self.features]))

    def transform(self, df: DataFrame, output_col: str = "relevance_score") -> DataFrame:
        """Scores (M6); missing feature columns count as 0 like the aligned
        test frame of the reference."""
        have = set(df.columns)
        missing = [c for c in self.features if c not in have]
        if missing:
            df = df.withColumns({c: F.lit(0.0) for c in missing})
        return df.withColumn(output_col, self.score_expr(df))

    def feature_importances(self) -> list[tuple[str, float]]:
        """Total split gain per feature over the used trees (M10), sorted."""
        tot = {f: 0.0 for f in self.features}
        for t in self.trees[: self.best_iteration]:
            for k, v in t.gains().items():
                tot[k] += v
        return sorted(tot.items(), key=lambda kv: (-kv[1], kv[0]))

    def importances_df(self, spark) -> DataFrame:
        return spark.createDataFrame(self.feature_importances(), "feature string, importance double")


_conf_lock = threading.Lock()
_conf_depth: dict[tuple, list] = {}


@contextmanager
def _conf(spark, settings: dict[str, str]):
    """Session settings for the length of a block; blocks that run at the same time in several threads share them."""
    key = (id(spark._jsparkSession), *sorted(settings.items()))
    with _conf_lock:
        depth = _conf_depth.setdefault(key, [0, None])
        if depth[0] == 0:
            depth[1] = {k: spark.conf.get(k, None) for k in settings}
            for k, v in settings.items():
                spark.conf.set(k, v)
        depth[0] += 1
    try:
        yield
    finally:
        with _conf_lock:
            depth[0] -= 1
            if depth[0] == 0:
                for k, v in _conf_depth.pop(key)[1].items():
                    if v is None:
                        spark.conf.unset(k)
                    else:
                        spark.conf.set(k, v)


def drop_checkpoint(df: DataFrame) -> None:
    """Delete the files of a checkpointed frame that nothing reads any more."""
    jvm = df.sparkSession.sparkContext._jvm
    file = df._jdf.logicalPlan().rdd().getCheckpointFile()
    if file.isDefined():
        path = jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tree_column(tree: Tree, values: str, rate: float) -> Column:
    """``rate`` times the value of one tree for the array column ``values``, as an expression of the JVM."""

    def build(n) -> Column:
        if "v" in n:
            return F.lit(rate * float(n["v"]))
        x = F.col(values)[int(n["f"])]
        left = x.isin(*map(float, n["in"])) if "in" in n else x <= F.lit(float(n["t"]))
        return F.when(left, build(n["l"])).otherwise(build(n["r"]))

    return build(tree.root)


class _State:
    """Static rows of a data set and its narrow table of scores, partitioned alike.

    The scores are checkpointed every round, so a round's plan has no earlier round in
    it; the checkpoint before is then deleted. The keys of the static rows have names
    (and so attributes) of their own: were they shared, a join would rewrite one side's
    plan, which then matches neither its partitioning nor what is persisted.
    """

    def __init__(self, rows: DataFrame, group: str, hot: bool):
        self.rows, self.hot, self.key = rows, hot, [group, "_part", "_rn"]
        self.static = rows.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(self.key)], "_f")
        self.scores = rows.select(*self.key, "_item", "_y", "_inv", F.lit(0.0).alias("_s")).checkpoint()

    def beside(self, table: DataFrame, static: DataFrame) -> DataFrame:
        """``table`` joined with rows of ``static`` by search, part and row, without a shuffle."""
        cond = None
        for i, c in enumerate(self.key):
            e = F.col(c) == F.col(f"_k{i}")
            cond = e if cond is None else cond & e
        return table.join(static, cond)

    def advance(self, tree: Tree, rate: float) -> None:
        """Add the new tree's values to the scores."""
        keys = [f"_k{i}" for i in range(len(self.key))]
        values = self.static.select(*keys, vector_to_array("_f").alias("_a")).select(*keys, tree_column(tree, "_a", rate).alias("_d"))
        before = self.scores
        moved = [F.col(c) if c != "_s" else (F.col("_s") + F.col("_d")).alias("_s") for c in before.columns]
        self.scores = self.beside(before, values).select(*moved).checkpoint()
        drop_checkpoint(before)

    def close(self) -> None:
        drop_checkpoint(self.scores)
        drop_checkpoint(self.rows)


@dataclass
class LambdaMART:
    n_estimators: int = 100
    learning_rate: float = 0.05
    num_leaves: int = 31
    max_depth: int = -1
    min_child_samples: int = 20
    subsample: float = 1.0
    colsample_bytree: float = 1.0
    reg_alpha: float = 0.0
    reg_lambda: float = 0.0
    max_bins: int = 32
    truncation_level: int = 30
    sigmoid: float = 1.0
    normalize: bool = True
    eval_at: int = 5
    early_stopping_rounds: int | None = 10
    seed: int = 42
    max_categories: int = 63
    hot_rows: int = HOT_ROWS

    def _depth(self) -> int:
        d = max(1, math.ceil(math.log2(max(2, self.num_leaves))))
        if self.max_depth and self.max_depth > 0:
            d = min(d, self.max_depth)
        return min(d, 30)

    # ---------------------------------------------------------------- data prep
    def _prepare(self, df: DataFrame, features: list[str], label: str, group: str, categories: CategoryIndex) -> tuple[DataFrame, bool]:
        """((group, part, row, item, label, features vector, 1 / ideal DCG), whether a search is hot).

        ``_rn`` numbers the group's rows by item and feature hash, so neither it nor any
        order made from it depends on the label; ``_part`` cuts a hot group by it.
        """
        T = self.truncation_level
        names = [f"_x{i}" for i in range(len(features))]
        item = F.col(ITEM_COL).cast("long") if ITEM_COL in df.columns else F.lit(0).cast("long")
        xs = [_feature(df, c, categories).alias(n, metadata=_nominal(c, categories)) for c, n in zip(features, names, strict=True)]
        base = df.where(F.col(group).isNotNull()).select(F.col(group), item.alias("_item"), F.col(label).cast("double").alias("_y"), *xs).withColumn("_hash", F.xxhash64(*names))
        base, ranges = numbered(base, group, [("_item", False), ("_hash", False)], "_rn", self.hot_rows)
        best = base.select(group, "_y").withColumn("_ip", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_y")))).where(F.col("_ip") <= T)
        ideal = best.groupBy(group).agg(F.sum(gain(F.col("_y")) * discount(F.col("_ip"))).alias("_idcg"))
        base = base.drop(*ranges).join(ideal, group)
        part = F.floor((F.col("_rn") - 1) / F.lit(self.hot_rows)).cast("int")
        inv = F.when(F.col("_idcg") > 0, F.lit(1.0) / F.col("_idcg")).otherwise(F.lit(0.0))
        vec = VectorAssembler(inputCols=names, outputCol="_f", handleInvalid="keep").transform(base)
        return vec.select(group, part.alias("_part"), "_rn", "_item", "_y", "_f", inv.alias("_inv")), bool(ranges)

    # ------------------------------------------------------------ gradients
    def _gradients(self, S: DataFrame, group: str, hot: bool = False, held: list | None = None) -> DataFrame:
        """(group, _part, _rn, _g, _h) for rows that take part in at least one pair.

        With ``held`` the ranks of hot searches, which are read several times, are kept
        and noted there; the caller lets go of them.
        """
        T, sig = self.truncation_level, float(self.sigmoid)
        row = ["_part", "_rn"]
        if hot:
            ranked, ranges = numbered(S, group, [("_s", True), ("_rn", False)], "_p", self.hot_rows)
            keys = [group, *ranges]
            if held is not None:
                ranked = ranked.persist()
                held.append(ranked)
            span = ranked.groupBy(group).agg(F.max("_s").alias("_best"), F.min("_s").alias("_worst"))
            top = ranked.where(F.col("_p") <= T).drop(*ranges).join(span, group)
            if ranges:  # the top rows of a search, at most T, go to each of its ranges
                top = ranked.select(*keys).distinct().join(top, group)
        else:
            keys = [group, "_part"]
            w = Window.partitionBy(*keys)
            ranked = S.withColumns(
                {"_p": F.row_number().over(w.orderBy(F.desc("_s"), "_rn")), "_best": F.max("_s").over(w), "_worst": F.min("_s").over(w)}
            )
            top = ranked.where(F.col("_p") <= T)

        def side(frame: DataFrame, name: str, more: list[str]) -> DataFrame:
            here = [F.col(c) for c in keys]
            return frame.select(*here, *[F.col(f"_{c}").alias(f"{name}_{c}") for c in ("part", "rn", "y", "s", "p")], *more)

        pairs = side(ranked, "j", []).join(side(top, "i", ["_inv", "_best", "_worst"]), keys)
        pairs = pairs.where((F.col("j_p") > F.col("i_p")) & (F.col("i_y") != F.col("j_y")))
        i_high = F.col("i_y") > F.col("j_y")
        ds = F.when(i_high, F.col("i_s") - F.col("j_s")).otherwise(F.col("j_s") - F.col("i_s"))
        dndcg = F.abs(gain(F.col("i_y")) - gain(F.col("j_y"))) * F.abs(discount(F.col("i_p")) - discount(F.col("j_p"))) * F.col("_inv")
        if self.normalize:
            dndcg = F.when(F.col("_best") != F.col("_worst"), dndcg / (F.lit(0.01) + F.abs(ds))).otherwise(dndcg)
        rho = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(sig) * ds))
        parts = ["i_part", "j_part"] if hot else ["_part"]
        pairs = pairs.select(
            group, *parts, "i_rn", "j_rn", i_high.alias("i_high"), (F.lit(-sig) * rho * dndcg).alias("lam"), (F.lit(sig * sig) * rho * (F.lit(1.0) - rho) * dndcg).alias("hess")
        )
        g_i = F.when(F.col("i_high"), F.col("lam")).otherwise(-F.col("lam"))
        own = [F.col("hess"), F.abs("lam")]
        sides = [[F.col("i_rn"), g_i, *own], [F.col("j_rn"), -g_i, *own]]
        if hot:
            contrib = pairs.select(group, stack_rows([[F.col(p), *x] for p, x in zip(parts, sides, strict=True)], [*row, "g", "h", "a"]))
        else:  # both rows lie in one part, so the sums stay in the partition
            contrib = pairs.select(group, "_part", stack_rows(sides, ["_rn", "g", "h", "a"]))
        per_row = contrib.groupBy(group, *row).agg(F.sum("g").alias("_g"), F.sum("h").alias("_h"), F.sum("a").alias("_a"))
        if self.normalize:
            if hot:
                total = per_row.groupBy(group).agg(F.sum("_a").alias("_t"))
                parts = S.select(group, "_part").distinct().join(total, group)
                per_row = per_row.join(parts, [group, "_part"])
            else:
                per_row = per_row.withColumn("_t", F.sum("_a").over(Window.partitionBy(group, "_part")))
            factor = F.when(F.col("_t") > 0, F.log2(F.lit(1.0) + F.col("_t")) / F.col("_t")).otherwise(F.lit(1.0))
            return per_row.select(group, *row, (F.col("_g") * factor).alias("_g"), (F.col("_h") * factor).alias("_h"))
        return per_row.select(group, *row, "_g", "_h")

    def gradients(self, df: DataFrame, score: str, label: str = LABEL_COL, group: str = GROUP_COL) -> DataFrame:
        """(group, item, g, h): one round's gradients for given scores (J4); items are unique within a group."""
        rows, hot = self._prepare(df, [score], label, group, CategoryIndex())
        rows = rows.withColumn("_s", vector_to_array("_f")[0]).drop("_f")
        found = self._gradients(rows, group, hot)
        out = found.join(rows.select(group, "_part", "_rn", "_item"), [group, "_part", "_rn"])
        return out.select(group, F.col("_item").alias(ITEM_COL), F.col("_g").alias("g"), F.col("_h").alias("h"))

    # ------------------------------------------------------------------ fit
    def fit(
        self,
        train: DataFrame,
        features: list[str],
        val: DataFrame | None = None,
        label: str = LABEL_COL,
        group: str = GROUP_COL,
        on_round=None,
        categorical: list[str] = (),
    ) -> LambdaMARTModel:
        """Train on ``features``, of which ``categorical`` are split by sets of values."""
        spark = train.sparkSession
        checkpoint_dir(spark)
        t0 = time.time()
        with _conf(spark, PLANNING):
            return self._fit(train, features, val, label, group, on_round, t0, list(categorical))

    def _tables(self, df: DataFrame, features: list[str], label: str, group: str, categories: CategoryIndex) -> _State:
        rows, hot = self._prepare(df, features, label, group, categories)
        n = range_count(df.select(group), ROWS_PER_TASK)
        rows = rows.repartition(n, group, "_part").sortWithinPartitions(group, "_part", "_rn").checkpoint()
        return _State(rows, group, hot)

    def _fit(self, train, features, val, label, group, on_round, t0, categorical) -> LambdaMARTModel:
        import random

        lr = float(self.learning_rate)
        categories = CategoryIndex.fit(train, [c for c in features if c in set(categorical)], self.max_categories)
        bins = max(self.max_bins, *(categories.size(c) for c in categories.values), 2)
        states = [self._tables(d, features, label, group, categories) for d in (train, val) if d is not None]
        trees: list[Tree] = []
        history = []
        best_score, best_iter, since_best = None, 0, 0
        n_feat = len(features)
        for rnd in range(1, self.n_estimators + 1):
            own = states[0]
            ranks: list[DataFrame] = []
            gh = self._gradients(own.scores, group, own.hot, ranks).where(F.col("_h") > 0).persist()
            fit_rows = own.beside(gh, own.static).select("_f", (-F.col("_g") / F.col("_h")).alias("_t"), F.col("_h").alias("_w"))
            if self.subsample < 1.0:
                fit_rows = fit_rows.sample(fraction=float(self.subsample), seed=self.seed + rnd)
            index_map = list(range(n_feat))
            feat_col = "_f"
            if self.colsample_bytree < 1.0:
                rng = random.Random(self.seed * 1000003 + rnd)
                k = max(1, int(round(n_feat * self.colsample_bytree)))
                index_map = sorted(rng.sample(range(n_feat), k))
                fit_rows = VectorSlicer(inputCol="_f", outputCol="_fs", indices=index_map).transform(fit_rows)
                feat_col = "_fs"
            pairs = gh.count()
            for frame in ranks:
                frame.unpersist()
            if not pairs or fit_rows.isEmpty():
                gh.unpersist()
                break
            dtr = DecisionTreeRegressor(
                featuresCol=feat_col,
                labelCol="_t",
                weightCol="_w",
                maxDepth=self._depth(),
                maxBins=bins,
                minInstancesPerNode=max(1, int(self.min_child_samples)),
                seed=self.seed,
            )
            model = dtr.fit(fit_rows)
            gh.unpersist()
            tree = Tree(_read_tree(model._java_obj, index_map, float(self.reg_alpha), float(self.reg_lambda)), features)
            trees.append(tree)
            for state in states:
                state.advance(tree, lr)
            rec = {"round": rnd, "seconds": time.time() - t0}
            if len(states) > 1:
                score = mean_ndcg(states[1].scores, "_s", label="_y", group=group, k=self.eval_at, tiebreak=("_item",)).first()[0]
                rec[f"val_ndcg_at_{self.eval_at}"] = score
                if best_score is None or (score is not None and score > best_score):
                    best_score, best_iter, since_best = score, rnd, 0
                else:
                    since_best += 1
            else:
                best_iter = rnd
            history.append(rec)
            if on_round:
                on_round(rec)
            if len(states) > 1 and self.early_stopping_rounds and since_best >= self.early_stopping_rounds:
                break
        for state in states:
            state.close()
        return LambdaMARTModel(
            features=list(features),
            trees=trees,
            learning_rate=lr,
            best_iteration=best_iter or len(trees),
            best_score=best_score,
            history=history,
            params=self.params(),
            training_seconds=time.time() - t0,
            categories=categories,
        )

    def params(self) -> dict:
        return {
            "objective": "lambdarank",
            "n_estimators": self.n_estimators,
            "learning_rate": self.learning_rate,
            "num_leaves": self.num_leaves,
            "max_depth": self.max_depth,
            "min_child_samples": self.min_child_samples,
            "subsample": self.subsample,
            "colsample_bytree": self.colsample_bytree,
            "reg_alpha": self.reg_alpha,
            "reg_lambda": self.reg_lambda,
            "max_bins": self.max_bins,
            "max_categories": self.max_categories,
            "truncation_level": self.truncation_level,
            "eval_at": self.eval_at,
            "early_stopping_rounds": self.early_stopping_rounds,
            "random_state": self.seed,
        }
