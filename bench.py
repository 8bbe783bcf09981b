"""Benchmark: headline operators at $BENCH_SF_DIR on local[$BENCH_CPUS].

The impression view is materialised once as parquet (timed as ``bridge``) —
the shape a production log has — and every operator then reads that table.
Results are forced with the ``noop`` sink, so nothing is collected. Prints one
JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from rankmill import get_spark  # noqa: E402
from rankmill.functions.columns import feature_columns  # noqa: E402
from rankmill.operators import binning as B  # noqa: E402
from rankmill.operators import profile as P  # noqa: E402
from rankmill.operators import stats as ST  # noqa: E402
from rankmill.operators.features import engineer_features  # noqa: E402
from rankmill.operators.impute import handle_missing_values  # noqa: E402
from rankmill.operators.ranker import LambdaMART  # noqa: E402
from rankmill.operators.ranking import add_relevance, mean_ndcg, submission  # noqa: E402
from rankmill.operators.split import split_data  # noqa: E402
from rankmill.sources.bridge import impressions  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    rounds = int(os.environ.get("BENCH_ROUNDS", "5"))
    spark = get_spark(
        f"local[{cpus}]",
        app_name="rankmill-bench",
        shuffle_partitions=cpus * 2,
        extra_conf={
            "spark.driver.memory": "16g",
            # long sessions generate much code; a full JIT code cache silently stops compilation
            "spark.driver.extraJavaOptions": "-XX:ReservedCodeCacheSize=1g -XX:+UseParallelGC",
        },
    )
    # a cluster passes a folder that all executors share; local runs get a scratch folder
    scratch = sys.argv[1] if len(sys.argv) > 1 else tempfile.mkdtemp(prefix="rankmill-bench-")
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.time()
        out = fn()
        times[name] = round(time.time() - t, 3)
        return out

    def sink(df):
        df.write.format("noop").mode("overwrite").save()

    path = f"{scratch}/impressions.parquet"
    timed("bridge", lambda: impressions(spark, sf_dir).write.mode("overwrite").parquet(path))
    raw = spark.read.parquet(path)

    imp_path = f"{scratch}/features.parquet"

    def features():
        imp, _ = handle_missing_values(raw)
        engineer_features(imp).write.mode("overwrite").parquet(imp_path)

    timed("features_default", features)
    timed("features_full", lambda: sink(engineer_features(handle_missing_values(raw)[0], "full")))
    feats = add_relevance(spark.read.parquet(imp_path))

    timed("ndcg_price_order", lambda: mean_ndcg(feats.withColumn("score", -F.col("price_usd")), "score", tiebreak=("prop_id", "position")).collect())
    timed("missing_stats", lambda: P.missing_stats(raw).collect())
    timed("distinct_counts", lambda: P.distinct_counts(raw).collect())
    timed("duplicates", lambda: P.duplicate_rows(raw).collect())
    timed("describe", lambda: P.describe(raw, ["price_usd", "prop_location_score2", "orig_destination_distance"]).collect())
    num = [c for c in raw.columns if c != "date_time"]
    timed("corr_matrix", lambda: ST.correlation_matrix(raw, num).collect())
    timed("quantile_bucket_rates", lambda: B.quantile_bucket_rates(raw, "prop_location_score2", "click_bool", 4).collect())
    timed("box_by_star", lambda: B.box_stats_by(raw, "prop_starrating", "price_usd").collect())
    timed("hexbin", lambda: B.hexbin_counts(raw, "srch_booking_window", "srch_length_of_stay", 50).collect())

    train, val = timed("split", lambda: split_data(feats))
    fc = feature_columns(feats)
    model = timed(
        "lambdamart_train",
        lambda: LambdaMART(n_estimators=rounds, learning_rate=0.1, early_stopping_rounds=None).fit(train, fc, val),
    )
    times["lambdamart_sec_per_round"] = round(times["lambdamart_train"] / max(1, len(model.trees)), 3)
    timed("score_and_submission", lambda: sink(submission(model.transform(val), "relevance_score")))

    total = round(sum(v for k, v in times.items() if k != "lambdamart_sec_per_round"), 3)
    print(
        json.dumps(
            {
                "metric": "total_sec",
                "value": total,
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).replace("sf", ""),
                "cpus": cpus,
                "lambdamart_rounds": rounds,
                "val_ndcg_at_5": model.best_score,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
