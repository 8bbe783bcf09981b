"""Operator 8 and the pipeline."""

import base64
import gzip
import hashlib
import io
import os
import random
import re

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankmill.llm import warc

SF_SMALL = "/root/testdata/sf0.001"

FOLDER = iter(range(10**6))


def folder(tmp_path):
    return str(tmp_path / f"w{next(FOLDER)}")


@pytest.mark.parametrize("split", [61, 1000, 1 << 23])
def test_every_page_comes_back(spark, tmp_path, split):
    rng = random.Random(split)
    big = bytes(rng.randrange(256) for _ in range(30_000)).decode("latin-1")
    pages = [(i, f"http://x/{i}%\r\n", f"<p>{'é' * (i % 7)}</p>") for i in range(40)]
    pages += [(100, None, None), (101, "u", ""), (102, "u", ""), (None, None, "<b>alone"), (None, None, "<p></p>"), (7, "again", "<p></p>"), (200, "\x1f\x8b\x08", "\x1f\x8b\x08WARC/1.1" * 50), (201, "big", big)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    got = warc.read_warc(warc.write_warc(df, folder(tmp_path)), split).collect()
    body = {}
    for i, _, h in pages:
        body.setdefault((h or "").encode(), []).append(i)
    want = []
    for i, u, h in pages:
        b = (h or "").encode()
        lead = max((x for x in body[b] if x is not None), default=None)
        revisit = lead is not None and i != lead
        want.append((i, u, "revisit" if revisit else "response", lead if revisit else None, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode()))
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted(want, key=repr)
    full = warc.resolve_revisits(warc.read_warc(warc.write_warc(df, folder(tmp_path)), split))
    assert sorted(bytes(r.payload) for r in full.collect()) == sorted((h or "").encode() for _, _, h in pages)


def test_reading_tasks_grow_with_the_archives(spark):
    def manifest(sizes):
        return spark.createDataFrame([(f"a{i}", n, 1) for i, n in enumerate(sizes)], "path string, n_bytes long, n_records long")

    few = 8 * spark.sparkContext.defaultParallelism
    assert [warc.read_tasks(manifest(s), 1000) for s in ([0], [10], [2500, 1000], [10**6] * 20)] == [1, 1, 4, max(few, 20_000 // warc.RANGES_PER_TASK)]
    assert warc.read_warc(manifest([10_000]), 1000).rdd.getNumPartitions() == 10


def test_short_payloads_are_all_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "xx"), (2, "b", "xx"), (3, "c", "y" * 50), (4, "d", "y" * 50)], "page_id long, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read_warc(warc.write_warc(df, folder(tmp_path), min_revisit_bytes=10)).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("revisit", 4), 4: ("response", None)}


def test_no_pages(spark, tmp_path):
    assert warc.read_warc(warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), folder(tmp_path))).collect() == []


def test_members_are_gzip_and_damage_is_reported():
    member = warc.encode_record(1, "u", b"hello", None)
    assert gzip.decompress(member).startswith(b"WARC/1.1\r\n")
    two = member + member
    assert [r[0] for r in warc.records_in_range(io.BytesIO(two), len(two), 1, len(two))] == [1]
    broken = member + member[: len(member) // 2]
    with pytest.raises(ValueError):
        list(warc.records_in_range(io.BytesIO(broken), len(broken), 0, len(broken)))


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.select("doc_id").collect()}
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).collect(), docs.schema)
        assert docs.columns == columns
        now = {r.doc_id for r in docs.select("doc_id").collect()}
        assert now <= ids
        kept.append(len(now))
        ids = now
    assert kept[-1] > 0.6 * spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    rows = docs.collect()
    seen = set()
    for r in sorted(rows, key=lambda r: r.doc_id):
        ws = re.findall(r"[^\x20\x09-\x0D]+", r.text)
        runs = {tuple(ws[i : i + 13]) for i in range(len(ws) - 12)}
        assert r.n_chars == len(r.text)
        seen |= runs
    items = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert not any(i in r.text for r in rows for i in items)
    last = corpus_pipeline.run(spark, SF_SMALL)
    assert {r.doc_id for r in last.select("doc_id").collect()} == ids
    assert last.filter(F.octet_length("ids") != 4 * F.col("n_tokens")).count() == 0


def test_near_duplicates_judge_every_text_under_an_id(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (5, a + " end"), (5, b), (5, b), (5, c), (7, c + " end"), (9, None), (9, ""), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF_SMALL).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(1, a), (5, b), (5, c), (9, None), (9, ""), (None, a)], key=repr)


def test_pipeline_edges(spark, tmp_path, edge_docs, no_docs):
    for name, schema in (("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")):
        spark.createDataFrame([], schema).write.parquet(os.path.join(tmp_path, f"{name}.parquet"))
    for docs in (edge_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == edge_docs.columns
            docs = spark.createDataFrame(docs.collect(), docs.schema)
        corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()


def test_stages_hand_python_few_rows_at_a_time(spark, tmp_path, monkeypatch):
    """Whole texts lie in a batch: Spark's 10,000 rows of them took an executor beyond its memory."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.range(3_000).selectExpr("id AS doc_id", "concat('text ', id) AS text").coalesce(1)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    before = spark.conf.get(setting)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    try:
        for _, stage in corpus_pipeline.STAGES:
            spark.conf.set(setting, "10000")
            stage(spark, docs, str(tmp_path))
            assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) == corpus_pipeline.BATCH_ROWS
        spark.conf.set(setting, "100")
        corpus_pipeline.small_batches(spark)
        assert spark.conf.get(setting) == "100"
        monkeypatch.setattr(corpus_pipeline, "STAGES", corpus_pipeline.STAGES[-1:])
        spark.conf.set(setting, "777")
        assert corpus_pipeline.run(spark, str(tmp_path)).count() == 3_000
        assert spark.conf.get(setting) == "777"
    finally:
        spark.conf.set(setting, before)
