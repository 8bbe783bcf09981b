"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.session import checkpoint_dir


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table at ``path`` in the shared folder: its plan runs once and its lineage ends there."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over the edges (a, b); only ids that have an edge.

    Each round takes the smallest label among a vertex and its neighbours, then
    the label of that label, so long chains shrink by doubling. Every round's
    labels are a table in the shared checkpoint folder; the driver learns only
    whether some label changed.
    """
    folder = f"{checkpoint_dir(edges.sparkSession)}/components-{uuid.uuid4().hex}"
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct()
    both = written(both, f"{folder}/edges")
    labels = written(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("id"), F.least("a", "low").alias("label")), f"{folder}/labels")
    for k in range(max_rounds):
        sent = both.join(labels.hint("merge"), both["b"] == labels["id"]).select(F.col("a").alias("id"), "label", F.lit(None).cast("long").alias("own"))
        low = sent.union(labels.select("id", "label", F.col("label").alias("own"))).groupBy("id").agg(F.min("label").alias("label"), F.min("own").alias("old"))
        to = labels.select(F.col("id").alias("to_id"), F.col("label").alias("to_label"))
        step = low.join(to.hint("merge"), low["label"] == to["to_id"], "left")
        step = written(step.select("id", "old", F.least("label", F.coalesce("to_label", "label")).alias("label")), f"{folder}/round-{k}")
        labels = step.select("id", "label")
        if step.filter("label != old").isEmpty():
            return labels.select("id", F.col("label").alias("component"))
    raise RuntimeError(f"labels still change after {max_rounds} rounds")
