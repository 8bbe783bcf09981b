"""Split invariants and the LambdaMART ranker on a planted-signal frame."""

import math
import os
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rankmill.operators.ranges import numbered
from rankmill.operators.ranker import PLANNING, CategoryIndex, LambdaMART, Tree, _conf
from rankmill.operators.ranking import mean_ndcg, rank_in_group, submission
from rankmill.operators.split import split_by_group, split_data


def planted(spark, searches=300, per=10):
    """Relevance driven by two of three features plus noise: the top three
    rows by noisy utility of each search get grades 5, 1, 1."""
    df = spark.range(searches * per).select(
        (F.col("id") / per).cast("long").alias("srch_id"),
        (F.col("id") % 997).alias("prop_id"),
        (F.rand(1) * 10).alias("f_good"),
        (F.rand(2) * 10).alias("f_also"),
        (F.rand(3) * 10).alias("f_noise"),
    )
    util = F.col("f_good") + 0.5 * F.col("f_also") + F.rand(4) * 2
    from pyspark.sql import Window

    r = F.row_number().over(Window.partitionBy("srch_id").orderBy(util.desc(), "prop_id"))
    return df.withColumn("_r", r).withColumn("relevance", F.when(F.col("_r") == 1, 5).when(F.col("_r") <= 3, 1).otherwise(0)).drop("_r")


def test_split_is_exact_disjoint_and_repeatable(spark):
    df = planted(spark, 101, 3)
    tr, te = split_by_group(df, 0.2, seed=7)
    a = {r[0] for r in tr.select("srch_id").distinct().collect()}
    b = {r[0] for r in te.select("srch_id").distinct().collect()}
    assert not a & b and len(a | b) == 101 and len(b) == 21  # ceil(20.2)
    _, te2 = split_by_group(df, 0.2, seed=7)
    assert {r[0] for r in te2.select("srch_id").distinct().collect()} == b
    _, te3 = split_by_group(df, 0.2, seed=7, rounding="floor")
    assert te3.select("srch_id").distinct().count() == 20


def test_lambdamart_learns_planted_signal(spark):
    df = planted(spark)
    tr, va = split_data(df, 0.2, 42)
    feats = ["f_good", "f_also", "f_noise"]
    base = mean_ndcg(va.withColumn("s", F.lit(0.0)), "s", tiebreak=("prop_id",)).first()[0]
    model = LambdaMART(n_estimators=6, learning_rate=0.2, num_leaves=8, min_child_samples=5, early_stopping_rounds=3).fit(tr, feats, va)
    assert model.best_score > base + 0.2
    scored = model.transform(va)
    got = mean_ndcg(scored, "relevance_score", tiebreak=("prop_id",)).first()[0]
    assert got > base + 0.2
    imp = dict(model.feature_importances())
    assert imp["f_good"] > imp["f_noise"]
    # the submission keeps every row once, best first
    sub = submission(scored, "relevance_score")
    assert sub.count() == va.count()
    rows = scored.where(F.col("srch_id") == scored.first().srch_id).orderBy(F.desc("relevance_score")).collect()
    assert all(rows[i].relevance_score >= rows[i + 1].relevance_score for i in range(len(rows) - 1))


def _categorical_frame(spark):
    """Relevance hangs on whether the category is in a set that no threshold cuts off."""
    df = spark.range(2400).select(
        (F.col("id") / 8).cast("long").alias("srch_id"), (F.col("id") % 997).alias("prop_id"),
        (F.xxhash64("id") % 12).cast("int").alias("code"), F.concat(F.lit("c"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5))).alias("name"), F.rand(5).alias("noise"),
    )
    return df.withColumn("relevance", F.when(F.abs("code").isin(1, 4, 7, 10), 5).otherwise(0))


def test_category_sets_are_learned(spark):
    df = _categorical_frame(spark).persist()
    tr, va = df.filter("srch_id < 200"), df.filter("srch_id >= 200")
    feats = ["code", "name", "noise"]
    kw = dict(n_estimators=1, learning_rate=0.5, num_leaves=2, min_child_samples=5)
    plain = LambdaMART(**kw).fit(tr, feats[:1] + feats[2:], va)
    sets = LambdaMART(**kw).fit(tr, feats, va, categorical=["code", "name", "absent"])
    assert sets.categorical == ["code", "name"] and plain.categorical == []
    # one split by a set of values separates what one threshold cannot
    assert sets.best_score == 1.0 and plain.best_score < 0.95
    root = sets.trees[0].root
    values = sets.categories.values["code"]
    good = {i + 1 for i, v in enumerate(values) if abs(v) in (1, 4, 7, 10)}
    assert root["f"] == 0 and set(root["in"]) in (good, set(range(1, len(values) + 1)) - good, set(range(len(values) + 1)) - good)
    scored = sets.transform(va)
    assert mean_ndcg(scored, "relevance_score", tiebreak=("prop_id",)).first()[0] == 1.0
    # null and unseen values go the way that no set names
    odd = spark.createDataFrame([(1, 1, None, "c1", 0.5), (1, 2, 999, "zz", 0.5), (1, 3, 1, None, None), (1, 4, 0, "c2", 1.0)], "srch_id long, prop_id long, code int, name string, noise double")
    got = {r.prop_id: r.relevance_score for r in sets.transform(odd).collect()}
    assert got[1] == got[2] and got[3] > got[4]
    df.unpersist()


def test_category_index_is_bounded(spark):
    rows = [(i % 9, f"v{i % 3}", -0.0 if i % 2 else 0.0) for i in range(90)] + [(100, None, None)] * 50 + [(None, "v1", 1.0)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    index = CategoryIndex.fit(df, ["a", "b", "c"], 4)
    assert index.values == {"a": [0.0, 1.0, 2.0, 100.0], "b": ["v0", "v1", "v2"], "c": [0.0, 1.0]}
    got = df.select(*[index.column(df, c).alias(c) for c in "abc"]).distinct().collect()
    assert {r.a for r in got} == {0.0, 1.0, 2.0, 3.0, 4.0} and {r.b for r in got} == {0.0, 1.0, 2.0, 3.0} and {r.c for r in got} == {0.0, 1.0, 2.0}


def _gradients_by_hand(rows, T=30):
    """Per (search, item): gradient and hessian by the plain double loop."""
    out = {}
    for g in {r[0] for r in rows}:
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        gains = sorted((2**r[3] - 1 for r in mine), reverse=True)[:T]
        ideal = sum(x / math.log2(i + 2) for i, x in enumerate(gains))
        spread = mine[0][2] != mine[-1][2]
        acc = {r[1]: [0.0, 0.0] for r in mine}
        total = 0.0
        for i, a in enumerate(mine[:T]):
            for j in range(i + 1, len(mine)):
                b = mine[j]
                if a[3] == b[3]:
                    continue
                hi, lo = (a, b) if a[3] > b[3] else (b, a)
                ds = hi[2] - lo[2]
                d = abs(2 ** a[3] - 2 ** b[3]) * abs(1 / math.log2(i + 2) - 1 / math.log2(j + 2)) / ideal
                d = d / (0.01 + abs(ds)) if spread else d
                rho = 1 / (1 + math.exp(ds))
                acc[hi[1]][0] -= rho * d
                acc[lo[1]][0] += rho * d
                for x in (hi, lo):
                    acc[x[1]][1] += rho * (1 - rho) * d
                total += 2 * rho * d
        k = math.log2(1 + total) / total if total > 0 else 1.0
        out |= {(g, item): (x * k, h * k) for item, (x, h) in acc.items()}
    return out


@pytest.mark.parametrize("ties", [True, False])
def test_gradients_of_a_hot_search(spark, ties):
    """One search with most rows is ranked, paired and summed in ranges, with the same result."""
    rng = random.Random(ties)
    rows = [(1 if i % 3 else 2 + i % 7, i, 0.0 if ties and rng.random() < 0.7 else rng.random() * 4, rng.choice([0, 0, 0, 1, 5])) for i in range(900)]
    df = spark.createDataFrame(rows, "srch_id long, prop_id long, score double, relevance int").repartition(3)
    want = _gradients_by_hand(rows)
    for limit in (40, 10**6):
        got = {(r.srch_id, r.prop_id): (r.g, r.h) for r in LambdaMART(hot_rows=limit).gradients(df, "score").collect()}
        assert all(got.get(k, (0.0, 0.0)) == pytest.approx(w, abs=1e-9) for k, w in want.items()) and set(got) <= set(want)


def test_training_with_a_hot_search_gives_the_same_model(spark):
    df = planted(spark, 60).withColumn("srch_id", F.when(F.col("srch_id") < 20, 0).otherwise(F.col("srch_id"))).persist()
    feats = ["f_good", "f_also", "f_noise"]
    kw = dict(n_estimators=2, learning_rate=0.3, num_leaves=4, min_child_samples=5)
    whole = LambdaMART(**kw).fit(df, feats, df)
    cut = LambdaMART(**kw, hot_rows=50).fit(df, feats, df)
    assert [r["val_ndcg_at_5"] for r in cut.history] == pytest.approx([r["val_ndcg_at_5"] for r in whole.history], abs=1e-3)
    assert len(whole.trees) == 2
    df.unpersist()


def checkpoint_file(df):
    return df._jdf.logicalPlan().rdd().getCheckpointFile().get().removeprefix("file:")


def test_rounds_move_only_the_narrow_table(spark):
    """Ranking, pairing and the join with the features need no exchange; replaced checkpoints are deleted."""
    df = planted(spark, 40)
    ranker = LambdaMART(num_leaves=4)
    with _conf(spark, PLANNING):
        state = ranker._tables(df, ["f_good", "f_noise"], "relevance", "srch_id", CategoryIndex())
        for _ in range(2):  # the scores of a later round are as well partitioned
            before = checkpoint_file(state.scores)
            state.advance(Tree({"f": 0, "t": 5.0, "l": {"v": 1.0}, "r": {"f": 1, "in": [1, 3], "l": {"v": 2.0}, "r": {"v": 3.0}}}, []), 0.5)
            assert os.path.isdir(checkpoint_file(state.scores)) and not os.path.exists(before)
        assert {r[0] for r in state.scores.select("_s").distinct().collect()} <= {1.0, 2.0, 3.0}
        gradients = ranker._gradients(state.scores, "srch_id").persist()
        joined = state.beside(gradients, state.static)
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "InMemory" in plan
    gradients.unpersist()
    files = [checkpoint_file(x) for x in (state.scores, state.rows)]
    assert all(map(os.path.isdir, files))
    state.close()
    assert not any(map(os.path.exists, files))


@pytest.mark.parametrize("kind", ["spread", "one score", "nulls", "all equal"])
def test_two_level_ranks(spark, kind):
    """A hot search's places equal those of one window, and no task holds many of its ranges' rows."""
    rng = random.Random(1)
    score = {
        "spread": lambda: 100.0 + 4 * rng.random(),
        "one score": lambda: 7.0 if rng.random() < 0.9 else rng.random(),
        "nulls": lambda: rng.choice([None, float("nan"), float("inf"), -float("inf"), 0.0, -0.0, rng.random()]),
        "all equal": lambda: 1.0,
    }[kind]
    big = 2**62 if kind == "one score" else 0  # items that no double tells apart
    rows = [(None if i % 5 == 0 else 1 if i % 3 else i % 50, i + big, score()) for i in range(6000)]
    df = spark.createDataFrame(rows, "srch_id long, prop_id long, score double")
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("srch_id").orderBy(F.col("score").desc_nulls_last(), F.col("prop_id").asc_nulls_last())))
    got = rank_in_group(df, "score", max_rows=150)
    assert got.columns == want.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    ranged, ranges = numbered(df, "srch_id", [("score", True), ("prop_id", False)], "rank", 150)
    sizes = [r["count"] for r in ranged.groupBy("srch_id", *ranges).count().collect()]
    assert max(sizes) <= 3 * 150
