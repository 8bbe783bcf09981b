"""Hyper-parameter search (E2: M11–M13, S7).

The search space is a small seeded parameter table drawn with ``rand(seed)``
columns. The first trial on a log prepares, splits (seed 123) and checkpoints it,
the others use the same split; trials run side by side and report validation
NDCG@5. A trial whose data cannot be read, prepared or split is recorded as
``pruned`` with score 0 and the reason; the other trials go on.
"""

from __future__ import annotations

import math
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.operators.split import split_data
from rankmill.plans.train import prepare, prepare_features_and_target, train_model
from rankmill.session import checkpoint_dir
from rankmill.sources.files import ensure_not_empty, write_json

# fixed values: the search space (low, high, kind[, step])
SPACE = {
    "n_estimators": (100, 700, "int", 50),
    "learning_rate": (0.01, 0.2, "log"),
    "num_leaves": (20, 150, "int", 1),
    "max_depth": (3, 12, "int", 1),
    "min_child_samples": (5, 100, "int", 1),
    "subsample": (0.5, 1.0, "float"),
    "colsample_bytree": (0.5, 1.0, "float"),
    "reg_alpha": (1e-3, 10.0, "log"),
    "reg_lambda": (1e-3, 10.0, "log"),
}


def search_space(spark: SparkSession, n_trials: int, seed: int = 42) -> DataFrame:
    """One row per trial with every parameter drawn from its range."""
    cols = [F.col("id").cast("int").alias("trial")]
    for i, (name, spec) in enumerate(SPACE.items()):
        lo, hi, kind = spec[:3]
        u = F.rand(seed + i)
        if kind == "int":
            step = spec[3]
            n = (hi - lo) // step + 1
            e = (F.lit(lo) + F.floor(u * n) * step).cast("int")
        elif kind == "log":
            e = F.exp(F.lit(math.log(lo)) + u * F.lit(math.log(hi) - math.log(lo)))
        else:
            e = F.lit(lo) + u * F.lit(hi - lo)
        cols.append(e.alias(name))
    return spark.range(n_trials).coalesce(1).select(*cols)


class _Prepared:
    """The prepared split of every raw frame, made by the first trial that needs it."""

    def __init__(self):
        self._locks: dict[int, threading.Lock] = {}
        self._done: dict[int, tuple] = {}
        self._guard = threading.Lock()

    def get(self, raw: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
        with self._guard:
            lock = self._locks.setdefault(id(raw), threading.Lock())
        with lock:
            if id(raw) not in self._done:
                try:
                    self._done[id(raw)] = (raw, self._make(raw), None)
                except Exception as e:  # noqa: BLE001 - kept, and raised again in every trial on this frame
                    self._done[id(raw)] = (raw, None, e)
            _, made, error = self._done[id(raw)]
        if error is not None:
            raise error
        return made

    def _make(self, raw: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
        ensure_not_empty(raw, "tuning data")
        processed, _ = prepare(raw, is_train=True)
        final, feats = prepare_features_and_target(processed.checkpoint())
        train, val = split_data(final, random_state=123)
        return train.checkpoint(), val.checkpoint(), feats


def run_trial(data: Callable[[], tuple], params: dict) -> tuple[str, float, str | None]:
    """(status, score, reason) of one trial: ``pruned`` if its data cannot be prepared, ``failed``
    if training raises (score 0 in both cases), else ``complete``."""
    try:
        train, val, feats = data()
    except (ValueError, PySparkException, Py4JJavaError) as e:
        return "pruned", 0.0, f"{type(e).__name__}: {e}"[:500]
    try:
        model, _ = train_model(train, val, feats, params)
    except (ValueError, PySparkException, Py4JJavaError) as e:
        return "failed", 0.0, f"{type(e).__name__}: {e}"[:500]
    return "complete", float(model.best_score or 0.0), None


def tune(
    raw: DataFrame | Callable[[int], DataFrame],
    n_trials: int = 5,
    seed: int = 42,
    out_path: str | None = None,
    fixed: dict | None = None,
    parallel: int = 2,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Run the trials (M11); returns (trial, status, ndcg_at_5, params…, reason).

    ``raw`` is the log, or a function that gives the log of a trial (then name ``spark``).
    ``parallel`` trials run at a time, each in a fair scheduler pool of its own, so a
    trial's small jobs do not leave executors idle. The best complete trial's parameters
    are written to ``out_path``; without one nothing is written.
    """
    spark = spark or (raw.sparkSession if isinstance(raw, DataFrame) else SparkSession.active())
    checkpoint_dir(spark)
    prepared = _Prepared()

    def one(row) -> tuple:
        p = row.asDict()
        trial = p.pop("trial")
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"trial-{trial}")
        try:
            status, score, reason = run_trial(lambda: prepared.get(raw if isinstance(raw, DataFrame) else raw(trial)), p | (fixed or {}))
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
        return (trial, status, score, *[float(p[k]) for k in SPACE], reason)

    trials = search_space(spark, n_trials, seed).collect()  # n_trials small rows
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        results = list(pool.map(one, trials))
    schema = "trial int, status string, ndcg_at_5 double, " + ", ".join(f"{k} double" for k in SPACE) + ", reason string"
    out = spark.createDataFrame(results, schema)
    if out_path:
        best = out.where("status = 'complete'").orderBy(F.desc("ndcg_at_5"), "trial").first()
        if best is not None:
            write_json(spark, out_path, {k: best[k] for k in SPACE})
    return out
