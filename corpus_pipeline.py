"""Corpus pipeline: toxicity, near duplicates, repeated passages, benchmark leaks, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes each result as Parquet below the shared checkpoint folder and reads it
again as the next stage's input. All stages but the last return the columns of
their input, whatever they are; doc_id, text and, where present, n_chars are the
only ones that a stage reads or changes.

Defined cases: rows with null ids are scored, tokenised and tested against the
benchmark like others, and are no near duplicates or repeats of anything; rows
that repeat an id with one text are one document from stage 2 on; different texts
under one id are documents of their own, and a text stays or goes whatever the others
under its id do. An empty table passes through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankmill.llm import toxicity
from rankmill.llm.bpe import encode_decode
from rankmill.llm.decontaminate import decontaminate, is_contaminated
from rankmill.llm.ngram_join import jaccard_components
from rankmill.llm.substring_dedup import substring_dedup
from rankmill.session import checkpoint_dir

NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Rows that Spark hands to Python at a time. The stages carry whole texts, and a batch is held by the
#: executor and by its worker, so Spark's 10,000 rows take tens of MB of both for every running task.
BATCH_ROWS = 200
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """At most ``BATCH_ROWS`` rows of an Arrow batch from now on; a smaller setting of the session stays."""
    have = int(spark.conf.get(_BATCH, "10000"))
    if have <= 0 or have > BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 1 (operator 7): documents that the grammar scores as toxic go."""
    small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    grammar = toxicity.train(docs, labels, F.lit(True))
    scored = toxicity.score_documents(docs, grammar)
    return scored.filter(F.col("toxicity.score") < toxicity.THRESHOLD).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 2 (operator 1): of documents linked by five-word shingles the one with the smallest id stays."""
    small_batches(spark)
    known = docs.filter("doc_id IS NOT NULL").withColumn("__hash", F.coalesce(F.md5(F.col("text").cast("binary")), F.lit("")))
    texts = known.select("doc_id", "__hash")
    several = texts.groupBy("doc_id").agg((F.min("__hash") != F.max("__hash")).alias("several")).filter("several")
    if several.isEmpty():
        stay = jaccard_components(docs.select("doc_id", "text"), NEAR_WORDS, NEAR_PERCENT).filter("doc_id = component_id")
        kept = known.join(stay.select("doc_id").distinct(), "doc_id", "left_semi")
    else:
        # one vertex per id and text, numbered in the order of the ids; written, so that the numbers stay
        path = f"{checkpoint_dir(spark)}/vertices-{uuid.uuid4().hex}"
        order = texts.distinct().repartitionByRange("doc_id", "__hash").sortWithinPartitions("doc_id", "__hash")
        order.withColumn("vertex", F.monotonically_increasing_id()).write.parquet(path)
        vertices = spark.read.parquet(path)
        numbered = known.select("doc_id", "__hash", "text").join(vertices, ["doc_id", "__hash"]).select(F.col("vertex").alias("doc_id"), "text")
        stay = jaccard_components(numbered, NEAR_WORDS, NEAR_PERCENT).filter("doc_id = component_id").select(F.col("doc_id").alias("vertex")).distinct()
        kept = known.join(vertices.join(stay, "vertex", "left_semi"), ["doc_id", "__hash"], "left_semi")
    kept = kept.dropDuplicates(["doc_id", "__hash"]).drop("__hash")
    return kept.unionByName(docs.filter("doc_id IS NULL")).select(*[F.col(f"`{c}`") for c in docs.columns])


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 3 (operator 4): passages of 13 words or more that an earlier document has are cut; emptied documents go."""
    small_batches(spark)
    cut = substring_dedup(docs, carry=True).filter("kept_text != '' OR n_words = 0")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    out = {"doc_id": F.col("doc_id"), "text": text}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("row.n_chars")).cast(docs.schema["n_chars"].dataType)
    return cut.select(*[out.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 4 (operator 10): documents that hold a benchmark item go."""
    small_batches(spark)
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.filter(~is_contaminated()).select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Stage 5 (operator 2): token ids of every text, and the hash of what they decode to."""
    small_batches(spark)
    coded = encode_decode(docs)
    return coded.select(
        "row.doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("bpe", tokenize),
]

#: SQL cannot express the learned toxicity stage and the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{checkpoint_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = spark.conf.get(_BATCH, None)
    try:
        for i, (name, stage) in enumerate(STAGES):
            path = f"{folder}/{i}-{name}"
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    finally:
        spark.conf.unset(_BATCH) if before is None else spark.conf.set(_BATCH, before)
    return docs
