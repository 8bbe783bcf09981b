"""Order statistics, chi-squared, correlations, loader, logs and large models."""

import json
import math
import os
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rankmill.operators import binning as B
from rankmill.operators import profile as P
from rankmill.operators import stats as ST
from rankmill.operators.groupstats import key_average_rank, key_medians
from rankmill.operators.quantiles import exact_quantiles, key_quantiles, order_statistics, running_counts
from rankmill.operators.ranges import key_ranges
from rankmill.operators.ranker import LambdaMART, LambdaMARTModel, Tree, forest_scorer
from rankmill.operators.ranking import mean_ndcg, submission
from rankmill.schema import impression_schema
from rankmill.sources.files import EmptyInputError, ensure_not_empty, load_impressions

INF = float("inf")


@pytest.mark.parametrize(
    "values",
    [
        [0.3, 0.1 + 0.2] * 300,  # neighbouring doubles
        [5.0] * 1000 + [7.0],
        [-INF, INF, 0.0, -0.0, 1e308, -1e308, 5e-324] * 40,
        [float(i * i % 1009) for i in range(2000)],
        [2.5],
    ],
)
def test_order_statistics_end_and_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3).persist()
    t = time.time()
    n = len(values)
    ks = sorted({0, n // 4, n // 2, 3 * n // 4, n - 1})
    got = order_statistics(df, ks, n, accuracy=50)  # a coarse sketch needs several passes
    assert [got[k] for k in ks] == [sorted(values)[k] for k in ks]
    assert time.time() - t < 90
    df.unpersist()


def test_exact_quantiles_of_ties_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,), (float("nan"),), (4.0,)], "x double")
    assert exact_quantiles(df, "x", [0, 0.5, 0.75, 1]) == [1.0, 2.0, 3.0, 4.0]
    assert exact_quantiles(df.filter("x > 9 AND NOT isnan(x)"), "x", [0.5]) == [None]


def test_hot_key_statistics_are_split_and_exact(spark):
    rng = random.Random(1)
    rows = [(1, rng.random() * 100) for _ in range(3000)] + [(k, float(rng.randrange(5))) for k in range(2, 40) for _ in range(7)]
    df = spark.createDataFrame(rows, "k long, x double")
    pdf = pd.DataFrame(rows, columns=["k", "x"])
    med = {r.k: r.m for r in key_medians(df, "k", ["x"], ["m"]).collect()}
    assert med == pytest.approx(pdf.groupby("k")["x"].median().to_dict())
    q = {r.k: (r.a, r.b) for r in key_quantiles(df, "k", "x", [0.25, 0.9], ["a", "b"]).collect()}
    want = pdf.groupby("k")["x"].quantile([0.25, 0.9]).unstack()
    assert all(q[k] == pytest.approx(tuple(want.loc[k])) for k in q) and len(q) == 39
    ranks = {(r.k, r.x): r.r for r in key_average_rank(df, "k", "x", "r").collect()}
    pdf["r"] = pdf.groupby("k")["x"].rank()
    assert all(ranks[k, x] == r for k, x, r in pdf.itertuples(index=False))
    # a key with more values than one window may walk is cut into ranges, with the same results
    plan = key_average_rank(df, "k", "x", "r", max_values=100)._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan
    assert {(r.k, r.x): r.r for r in key_average_rank(df, "k", "x", "r", max_values=100).collect()} == ranks
    assert {r.k: r.m for r in key_medians(df, "k", ["x"], ["m"], max_values=100).collect()} == med
    assert {r.k: (r.a, r.b) for r in key_quantiles(df, "k", "x", [0.25, 0.9], ["a", "b"], max_values=100).collect()} == q


def test_close_values_of_a_hot_key_spread(spark):
    """Prices between 100.00 and 104.00 are cut at the key's own quantiles."""
    df = spark.range(4000).select(F.lit(1).alias("k"), (100 + F.col("id") / 1000).alias("x"), F.lit(1).cast("long").alias("n"))
    df = df.union(spark.range(30).select(F.col("id") + 2, F.lit(5.0), F.lit(1).cast("long")))
    cut = key_ranges(df, ["k"], F.col("x"), "r", 250)
    sizes = [r["count"] for r in cut.filter("k = 1").groupBy("r").count().collect()]
    assert len(sizes) >= 16 and max(sizes) <= 500 and cut.filter("k > 1 AND r != 0").count() == 0
    walked = running_counts(df, ["k"], "x", max_values=250).filter("k = 1").orderBy("x").collect()
    assert [r.cum for r in walked] == list(range(1, 4001)) and {r.tot for r in walked} == {4000}


def test_chi_squared_with_an_empty_cell(spark):
    rows = [(0, 0)] * 10 + [(0, 1)] * 20 + [(1, 0)] * 10
    r = ST.chi2_2x2(spark.createDataFrame(rows, "a int, b int"), "a", "b", correction=False).first()
    assert abs(r.chi2 - 40 / 3) < 1e-9 and r.dof == 1
    assert abs(r.p_value - math.erfc(math.sqrt(20 / 3))) < 1e-12
    none = ST.chi2_2x2(spark.createDataFrame([], "a int, b int"), "a", "b").first()
    assert none.chi2 is None


@pytest.mark.parametrize("z", [0.0, 0.1, 1.0, 2.9, 3.0, 4.5, 9.0])
def test_error_function(spark, z):
    got = spark.range(1).select(F.lit(z).alias("z")).select(F.expr(ST.erfc_sql("z"))).first()[0]
    assert got == pytest.approx(math.erfc(z), rel=1e-9, abs=1e-15)


def test_correlations_with_nulls_and_constants(spark):
    rng = random.Random(2)
    rows = [(float(i), rng.random() if i % 3 else None, 1e9 + i % 7, 4.0, None) for i in range(300)]
    cols = ["a", "b", "c", "d", "e"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols))
    got = {(r.col_a, r.col_b): r.correlation for r in ST.correlation_matrix(df, cols).collect()}
    # the reference value of a far-off column is taken after an exact shift, which changes no correlation
    want = pd.DataFrame([(*r[:2], r[2] - 1e9, *r[3:]) for r in rows], columns=cols).astype(float).corr(min_periods=2)
    for (a, b), r in got.items():
        w = want.loc[a, b]
        assert (r is None) == (np.isnan(w) or "d" in (a, b)) and (r is None or abs(r - w) < 1e-9), (a, b)
    assert len(got) == 10
    assert {r.correlation for r in ST.correlation_matrix(df.limit(0), ["a", "b"]).collect()} == {None}


def test_empty_frames_give_empty_results(spark):
    df = spark.createDataFrame([], "x double, y double")
    assert ST.above_quantile(df, "x", 0.5).first().percent_above is None
    assert P.missing_share(df, "x").first()[0] is None
    assert B.quantile_bucket_rates(df, "x", "y").collect() == [] and B.log_histogram(df, "x", 4).collect() == []


def test_distinct_instants_across_a_clock_change(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_seconds(x) AS t, CAST(0.0 AS DOUBLE) * s AS z FROM VALUES (1604210400, 1), (1604214000, -1) AS v(x, s)")
        got = {r.column_name: r.distinct_values for r in P.distinct_counts(df).collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert got == {"t": 2, "z": 1}


def _csv(path, n):
    cols = [f.name for f in impression_schema(True).fields]
    lines = []
    for i in range(n):
        vals = {c: "" for c in cols} | {"srch_id": str(i // 2), "prop_id": str(i), "date_time": "2013-04-04 08:32:15", "price_usd": "NaN" if i % 5 == 0 else "10.5"}
        lines.append(",".join(vals[c] for c in cols))
    path.write_text(",".join(cols) + "\n" + "\n".join(lines) + "\n")
    return str(path)


def test_loader_nan_limits_missing_and_empty(spark, tmp_path):
    path = _csv(tmp_path / "a.csv", 40)
    df = load_impressions(spark, path)
    assert df.filter("price_usd IS NULL").count() == 8 and df.agg(F.avg("price_usd")).first()[0] == 10.5
    assert sorted(r.prop_id for r in load_impressions(spark, path, limit_rows=7).collect()) == list(range(7))
    with pytest.raises(AnalysisException):
        load_impressions(spark, str(tmp_path / "absent.csv")).count()
    with pytest.raises(AnalysisException):
        load_impressions(spark, str(tmp_path / "absent.csv"), limit_rows=3)
    with pytest.raises(EmptyInputError):
        ensure_not_empty(load_impressions(spark, _csv(tmp_path / "b.csv", 0)))


def test_first_rows_by_position(spark, tmp_path):
    """The limit falls into, between and behind files and blocks; no task sorts or holds the rows."""
    (tmp_path / "many files").mkdir()
    sizes = {"b 1.csv": 700, "a%20.csv": 50, "c.csv": 0, "d.csv": 300}
    order = []
    for name in sorted(sizes):
        _csv(tmp_path / "many files" / name, sizes[name])
        order += [(name, i) for i in range(sizes[name])]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
    try:
        path = str(tmp_path / "many files")
        for n in (0, 1, 49, 50, 51, 333, 749, 750, 751, 1049, 1050, 5000):
            got = load_impressions(spark, path, limit_rows=n)
            rows = got.select(F.col("prop_id")).collect()
            assert sorted(r.prop_id for r in rows) == sorted(i for _, i in order[:n]), n
        plan = load_impressions(spark, path, limit_rows=333)
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert not any(x in text for x in ("Sort", "Limit", "TakeOrdered", "Exchange")) and plan.rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _frame(spark, searches=120, per=8):
    return spark.range(searches * per).select(
        (F.col("id") / per).cast("long").alias("srch_id"), (F.col("id") % 7).alias("prop_id"), F.round(F.rand(1) * 3).alias("good"), F.rand(2).alias("noise"),
    ).withColumn("relevance", F.when(F.col("good") == 3, 5).when(F.col("good") == 2, 1).otherwise(0))


def test_reported_score_is_that_of_the_scored_rows(spark):
    df = _frame(spark).persist()
    tr, va = df.filter("srch_id < 90"), df.filter("srch_id >= 90")
    model = LambdaMART(n_estimators=2, num_leaves=2, min_child_samples=5).fit(tr, ["good", "noise"], va)
    got = mean_ndcg(model.transform(va), "relevance_score", tiebreak=("prop_id",)).first()[0]
    assert model.best_score == pytest.approx(got, abs=1e-12)
    # L1 and L2 change the leaves
    small = LambdaMART(n_estimators=1, num_leaves=2, min_child_samples=5, reg_lambda=1e6).fit(tr, ["good", "noise"])
    flat = LambdaMART(n_estimators=1, num_leaves=2, min_child_samples=5, reg_alpha=1e9).fit(tr, ["good", "noise"])
    plain = LambdaMART(n_estimators=1, num_leaves=2, min_child_samples=5).fit(tr, ["good", "noise"])
    top = lambda m: m.transform(va).agg(F.max(F.abs("relevance_score"))).first()[0]
    assert top(plain) > 100 * top(small) > 0 and top(flat) == 0
    df.unpersist()


def _random_tree(rng, leaves, n_features):
    if leaves == 1:
        return {"v": rng.random()}
    left = rng.randint(1, leaves - 1)
    return {"f": rng.randrange(n_features), "t": rng.random(), "g": 1.0, "l": _random_tree(rng, left, n_features), "r": _random_tree(rng, leaves - left, n_features)}


def _walk(node, x):
    while "v" not in node:
        node = node["l"] if x[node["f"]] <= node["t"] else node["r"]
    return node["v"]


@pytest.mark.parametrize("trees,leaves", [(100, 31), (700, 150)])
def test_large_models_score(spark, trees, leaves):
    rng = random.Random(trees)
    names = [f"x{i}" for i in range(10)]
    forest = [Tree(_random_tree(rng, leaves, 10), names) for _ in range(trees)]
    rows = [tuple(rng.random() for _ in names) for _ in range(60)]
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))
    model = LambdaMARTModel(names, forest, 0.1, trees, None)
    t = time.time()
    scored = model.transform(df)
    assert time.time() - t < 15
    got = sorted(r.relevance_score for r in scored.collect())
    want = sorted(sum(0.1 * _walk(f.root, r) for f in forest) for r in rows)
    assert np.allclose(got, want)
    assert forest_scorer([], 0.1) is not None


def test_submission_of_one_hot_search(spark):
    df = spark.range(5000).select(F.lit(1).cast("long").alias("srch_id"), F.col("id").alias("prop_id"), (F.col("id") % 100).cast("double").alias("relevance_score"))
    df = df.union(spark.range(50).select(F.col("id") + 2, F.col("id"), F.lit(1.0)))
    parts = submission(df).withColumn("part", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    rows = parts.orderBy("at").collect()
    assert len({r.part for r in rows if r.SearchId == 1}) > 1  # the search is spread over partitions
    want = [(r.srch_id, r.prop_id) for r in df.orderBy("srch_id", F.desc("relevance_score"), "prop_id").collect()]
    assert [(r.SearchId, r.PropertyId) for r in rows] == want


def test_train_only_run_and_tuning(spark, tmp_path):
    from rankmill.plans.report import summarize
    from rankmill.plans.train import run_train_only
    from rankmill.plans.tuning import SPACE, tune
    from rankmill.sources.bridge import impressions

    df = impressions(spark, "/root/testdata/sf0.001").filter("srch_id % 4 = 0")
    log = run_train_only(df, str(tmp_path / "logs"), params={"n_estimators": 1, "num_leaves": 3}, nrows_train=1234)
    assert log["run_type"] == "train_only" and log["data_summary"]["X_train_shape"].endswith(f"{log['data_summary']['num_features_used']})")
    runs = summarize(spark, str(tmp_path / "logs"))["runs"].collect()
    assert len(runs) == 1 and runs[0].nrows_train == "1234" and runs[0].ndcg_at_5 == pytest.approx(float(log["model_performance"]["validation_ndcg_at_5"]))
    best = str(tmp_path / "best.json")
    trials = tune(df, 1, out_path=best, fixed={"n_estimators": 1, "num_leaves": 3}).collect()
    assert [t.status for t in trials] == ["complete"] and set(json.load(open(best))) == set(SPACE)


def test_trials_on_bad_data_are_pruned(spark, tmp_path):
    from rankmill.plans.tuning import tune
    from rankmill.sources.bridge import impressions

    good = impressions(spark, "/root/testdata/sf0.001").filter("srch_id % 8 = 0").persist()
    raws = {0: good, 1: good.drop("click_bool"), 2: good.limit(0), 4: good}

    def log(trial):
        return raws[trial] if trial in raws else load_impressions(spark, str(tmp_path / "absent.csv"))

    best = str(tmp_path / "best.json")
    got = {r.trial: r for r in tune(log, 5, out_path=best, fixed={"n_estimators": 1, "num_leaves": 2}, parallel=3, spark=spark).collect()}
    assert {t: r.status for t, r in got.items()} == {0: "complete", 1: "pruned", 2: "pruned", 3: "pruned", 4: "complete"}
    assert all((r.reason is None) == (r.status == "complete") and (r.ndcg_at_5 > 0) == (r.status == "complete") for r in got.values())
    assert "Columns" in got[1].reason and "EmptyInputError" in got[2].reason
    none = tune(good.limit(0), 2, out_path=str(tmp_path / "none.json"), fixed={"n_estimators": 1})
    assert {r.status for r in none.collect()} == {"pruned"} and not os.path.exists(tmp_path / "none.json")
    good.unpersist()


def test_checkpoints_need_a_shared_folder_on_a_cluster():
    from rankmill.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_entry_without_the_corpus_operators(tmp_path):
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    shutil.copytree(os.path.join(root, "rankmill"), tmp_path / "rankmill", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(root, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 55 and not any(k.startswith('op') or k == 'pipeline' for k in q) and set(e.oracle_sql()) == set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_feature_plan_scans_and_exchanges(spark, tmp_path):
    from rankmill.operators.features import engineer_features
    from rankmill.sources.bridge import impressions

    path = str(tmp_path / "log.parquet")
    impressions(spark, "/root/testdata/sf0.001").write.parquet(path)
    for profile in ("default", "full"):
        plan = engineer_features(spark.read.parquet(path), profile)._jdf.queryExecution()
        # one scan for the hotel table, one for the rows
        assert plan.optimizedPlan().toString().count("Relation [") == 2
        text = plan.executedPlan().toString()
        # the hotel table's aggregate, at most both sides of its join, and the rows by search
        assert text.count("Exchange hashpartitioning") <= 3 and "CartesianProduct" not in text


@pytest.mark.parametrize("profile", ["default", "full"])
def test_features_of_hot_searches_and_hotels(spark, profile):
    """Searches and hotels above the row limit take the other path and get the same features."""
    from rankmill.operators.features import engineer_features
    from rankmill.sources.bridge import impressions

    df = impressions(spark, "/root/testdata/sf0.001")
    df = df.withColumn("srch_id", F.when(F.col("srch_id") % 3 == 0, 3).when(F.col("srch_id") % 50 == 1, None).otherwise(F.col("srch_id")))
    df = df.withColumn("prop_id", F.when(F.col("prop_id") % 3 == 0, 3).when(F.col("prop_id") % 50 == 1, None).otherwise(F.col("prop_id"))).persist()
    whole, cut = (engineer_features(df, profile, max_rows=n).toPandas().sort_values(list(df.columns), ignore_index=True) for n in (10**9, 100))
    assert list(whole.columns) == list(cut.columns)
    pd.testing.assert_frame_equal(whole, cut, check_dtype=False, rtol=1e-9)
    df.unpersist()


def test_hotel_statistics_of_training_rows(spark):
    from rankmill.operators.features import engineer_features, prop_table

    cols = "srch_id long, prop_id long, price_usd double, visitor_hist_starrating double, visitor_hist_adr_usd double"
    train = spark.createDataFrame([(1, 1, 10.0, None, None), (2, 1, 30.0, None, None)], cols)
    test = spark.createDataFrame([(3, 1, 50.0, None, None), (3, 2, 5.0, None, None)], cols)
    own = {r.prop_id: r.avg_price_usd_for_prop for r in engineer_features(test).collect()}
    fitted = {r.prop_id: r.avg_price_usd_for_prop for r in engineer_features(test, hotel_stats=prop_table(train)).collect()}
    assert own == {1: 50.0, 2: 5.0} and fitted == {1: 20.0, 2: None}


def test_null_prices_keep_their_rows_and_have_no_rank(spark):
    rows = [(1, 1, None), (1, 2, 5.0), (1, 3, 5.0), (2, 4, None)]
    df = spark.createDataFrame(rows, "srch_id long, prop_id long, price_usd double")
    got = {(r.srch_id, r.price_usd): r.r for r in key_average_rank(df, "srch_id", "price_usd", "r", keep_null=True).collect()}
    assert got == {(1, None): None, (1, 5.0): 1.5, (2, None): None}
