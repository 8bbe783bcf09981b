"""CSV source, run-log sink/scan/report, search space, plan shapes."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from rankmill.plans.report import summarize
from rankmill.plans.tuning import SPACE, search_space
from rankmill.schema import impression_schema
from rankmill.sources.files import load_impressions, write_json


def test_csv_null_tokens_and_group_limit(spark):
    d = tempfile.mkdtemp(prefix="rm-csv-")
    cols = [f.name for f in impression_schema(True).fields]
    rows = []
    for i, sid in enumerate([1, 1, 2, 2, 3]):
        vals = {c: "" for c in cols}
        vals.update({"srch_id": str(sid), "prop_id": str(i), "date_time": "2013-04-04 08:32:15", "price_usd": "NULL" if i == 0 else "10.5"})
        rows.append(",".join(vals[c] for c in cols))
    with open(os.path.join(d, "train.csv"), "w") as f:
        f.write(",".join(cols) + "\n" + "\n".join(rows) + "\n")
    df = load_impressions(spark, os.path.join(d, "train.csv"))
    assert df.count() == 5 and df.where(F.col("price_usd").isNull()).count() == 1
    assert df.where(F.col("visitor_hist_starrating").isNull()).count() == 5
    assert dict(df.dtypes)["date_time"] == "timestamp"
    assert load_impressions(spark, os.path.join(d, "train.csv"), limit_groups=2).select("srch_id").distinct().count() == 2


def test_run_logs_report(spark):
    d = tempfile.mkdtemp(prefix="rm-logs-")
    full = {
        "run_timestamp": "20240101_000000",
        "configuration": {"nrows_loaded_train": 2000000, "nrows_loaded_test": 2000000},
        "data_summary": {"num_features_used": 117, "num_train_groups": 10},
        "model_training_results": {"parameters_used": {"n_estimators": 100, "learning_rate": 0.05}, "training_duration_seconds": "12.50", "validation_ndcg_at_5": 0.41},
        "feature_importances_gain": {f"f{i}": float(i) for i in range(15)},
    }
    na = dict(full, run_timestamp="20240102_000000")
    na["model_training_results"] = {"parameters_used": "Not available", "training_duration_seconds": "Not available", "validation_ndcg_at_5": "Not available"}
    na["feature_importances_gain"] = "Not available"
    train_only = {"run_timestamp": "20240103_000000", "run_type": "train_only", "model_performance": {"validation_ndcg_at_5": "0.39"}, "data_summary": {"num_features_used": "117"}}
    for name, obj in (("a", full), ("b", na), ("c", train_only)):
        write_json(spark, os.path.join(d, f"training_log_{name}.json"), obj)
    with open(os.path.join(d, "broken.json"), "w") as f:
        f.write("{not json")
    rep = summarize(spark, d)
    runs = rep["runs"].collect()
    assert len(runs) == 3
    assert [r.ndcg_at_5 for r in runs] == [0.41, 0.39, None]
    strict = summarize(spark, d, strict=True)["runs"].collect()
    assert sum(r.ndcg_at_5 is not None for r in strict) == 1
    top = rep["top_importances"].orderBy("rank").collect()
    assert [r.feature for r in top][:3] == ["f14", "f13", "f12"] and len(top) == 10
    assert {r.parameter for r in rep["parameters"].collect()} == {"n_estimators", "learning_rate"}
    table = {r.timestamp: r for r in rep["table"].collect()}
    assert table["20240101_000000"].ndcg_at_5 == "0.4100" and table["20240102_000000"].ndcg_at_5 == "N/A"
    assert table["20240101_000000"].training_seconds == "12.50"


def test_search_space_ranges(spark):
    rows = search_space(spark, 50, seed=3).collect()
    assert len(rows) == 50
    for r in rows:
        for k, spec in SPACE.items():
            assert spec[0] <= r[k] <= spec[1], (k, r[k])
        assert (r.n_estimators - 100) % 50 == 0
    assert rows == search_space(spark, 50, seed=3).collect()


def test_plans_have_no_python_udf_and_partial_topk(spark):
    from rankmill.operators.features import engineer_features
    from rankmill.operators.impute import handle_missing_values
    from rankmill.operators.ranking import add_relevance, ndcg_per_group
    from rankmill.sources.bridge import impressions

    df = handle_missing_values(impressions(spark, "/root/testdata/sf0.001"))[0]
    plan = engineer_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    nd = ndcg_per_group(add_relevance(df).withColumn("s", -F.col("price_usd")), "s")
    p2 = nd._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in p2 and "Partial" in p2


def test_train_predict_run_writes_submission_and_log(spark):
    from rankmill.plans.report import summarize as summ
    from rankmill.plans.train import run
    from rankmill.schema import TRAIN_ONLY_COLS
    from rankmill.sources.bridge import impressions

    d = tempfile.mkdtemp(prefix="rm-run-")
    df = impressions(spark, "/root/testdata/sf0.001")
    test = df.drop(*TRAIN_ONLY_COLS)
    log = run(df, test, submission_dir=os.path.join(d, "sub"), log_dir=os.path.join(d, "logs"), params={"n_estimators": 2, "learning_rate": 0.1})
    assert log["data_summary"]["num_features_used"] == 117
    assert log["model_training_results"]["validation_ndcg_at_5"] != "Not available"
    sub = spark.read.option("header", True).csv(os.path.join(d, "sub", f"submission_{log['run_timestamp']}"))
    assert sub.columns == ["SearchId", "PropertyId"] and sub.count() == df.count()
    runs = summ(spark, os.path.join(d, "logs"))["runs"].collect()
    assert len(runs) == 1 and runs[0].num_features == 117
