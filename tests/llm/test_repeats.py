"""Operators 1, 4 and 5 against brute force."""

import collections
import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from harness import compare

from rankmill.llm import ngram_join, substring_dedup, suffix_dedup, wordhash
from rankmill.llm.components import components

SF_SMALL = "/root/testdata/sf0.001"

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_words_equal_the_pattern():
    texts = ["a b  c", None, "", " x\ty\x0bz ", "é 日本\nü", "a\x1cb c d"]
    w = wordhash.words(pa.array(texts, pa.string()))
    got = [[w.data[a:b].tobytes().decode() for a, b in zip(w.starts[w.row == r], w.ends[w.row == r])] for r in range(len(texts))]
    assert got == [WORD.findall(t or "") for t in texts]
    h = wordhash.word_hashes(wordhash.words(pa.array(["ab b ab", "b ab"])))
    assert h[0] == h[2] == h[4] and h[1] == h[3] != h[0]


def test_equal_windows_share_their_anchor():
    rng = np.random.default_rng(1)
    g = rng.integers(0, 50, 400).astype(np.uint64)
    at = wordhash.winnow(g, np.ones(392, bool), 9)
    assert all(at[i] - i == np.argmin(g[i : i + 9]) for i in range(392))


def brute_op4(rows, window):
    first, out = {}, []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        ws = WORD.findall(t or "")
        gone = [False] * len(ws)
        for s in range(len(ws) - window + 1):
            if i is not None and first.get(tuple(ws[s : s + window]), i) < i:
                gone[s : s + window] = [True] * window
        for s in range(len(ws) - window + 1):
            if i is not None:
                first.setdefault(tuple(ws[s : s + window]), i)
        out.append((-1 if i is None else i, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return sorted(out)


def op4(df, window):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(df, window).collect())


def test_substring_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    base = [rng.choice("abcdefgh") for _ in range(200)]
    rows = []
    for i in range(80):
        ws = []
        for _ in range(rng.randint(0, 4)):
            a = rng.randrange(180)
            ws += [rng.choice("abc") * rng.randint(1, 3) for _ in range(rng.randint(0, 12))] + base[a : a + rng.randint(1, 25)]
        rows.append((i, " ".join(ws)))
    rows += [(200, "k " * 60), (201, "k " * 70), (202, rows[5][1]), (203, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for window in (6, 13):
        assert op4(df, window) == brute_op4(rows, window)


def test_substring_dedup_edges(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert op4(edge_docs, 13) == brute_op4(rows, 13)
    assert op4(no_docs, 13) == []
    carried = substring_dedup.substring_dedup(edge_docs, carry=True).filter("doc_id = 3").select("row.*").first().asDict()
    assert carried["a.b"] == 3 and carried["row"] == "r"


def test_substring_dedup_tells_texts_under_one_id_apart(spark):
    a, b = " ".join(f"w{i}" for i in range(20)), " ".join(f"v{i}" for i in range(20))
    rows = [(1, a), (5, a), (5, b)]
    got = op4(spark.createDataFrame(rows, "doc_id long, text string"), 13)
    assert got == [(1, 20, 0, a), (5, 20, 0, b), (5, 20, 20, "")]


def test_substring_dedup_finds_a_passage_in_every_text_under_an_id(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(9))
    rows = [(1, passage), (5, f"{a} {passage}"), (5, f"{b} {passage} {b}"), (5, f"{a} {passage}")]
    got = op4(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), 13)
    assert got == sorted([(1, 20, 0, passage), (5, 50, 20, a), (5, 50, 20, a), (5, 38, 20, f"{b} {b}")])


def test_op4_query_on_the_tables(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = [(i, n, r, hashlib.sha256(k.encode()).hexdigest()) for i, n, r, k in brute_op4([tuple(d) for d in docs], 13)]
    assert sorted(map(tuple, substring_dedup.op4_substring_dedup(spark, SF_SMALL).collect())) == want


def brute_op5(rows, least):
    count = collections.Counter()
    for _, t in rows:
        b = (t or "").encode()
        count.update(b[i : i + least] for i in range(len(b) - least + 1))
    out = []
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - least + 1):
            if count[b[i : i + least]] > 1:
                gone[i : i + least] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((-1 if d is None else d, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    return sorted(out)


def test_suffix_dedup_equals_brute_force(spark):
    rng = random.Random(5)
    base = "".join(rng.choice("abcé") for _ in range(300))
    rows = []
    for i in range(50):
        t = "".join(rng.choice("abcé") for _ in range(rng.randint(0, 100)))
        for _ in range(rng.randint(0, 3)):
            a = rng.randrange(250)
            t += base[a : a + rng.randint(5, 50)] + "".join(rng.choice("abc") for _ in range(rng.randint(0, 20)))
        rows.append((i, t))
    rows += [(100, "ab" * 40), (101, "ab" * 40), (102, None), (None, ""), (103, rows[3][1]), (104, "z" * 90), (104, "z" * 90), (105, "q" * 70), (None, rows[4][1])]
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 20).collect()
    assert sorted((-1 if r.row.doc_id is None else r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_op5(rows, 20)


class SeenWork(suffix_dedup.Work):
    def table(self, df):
        self.last = super().table(df)
        return self.last


@pytest.fixture
def many_ranges(spark):
    """Small shuffles keep their partitions."""
    names = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


def test_counts_of_a_hot_key_spread_over_ranges(spark, many_ranges):
    rng = random.Random(6)
    for hot in (0.9, 1.0, 0.0):
        rows = [(5, 5, t, i, rng.randrange(2)) if rng.random() < hot else (rng.randrange(9), rng.randrange(9), t, i, rng.randrange(2)) for t in range(60) for i in range(50)]
        work = SeenWork(spark)
        df = spark.createDataFrame(rows, "a long, b long, tid long, i long, cls long").repartition(3)
        got = {(r.tid, r.i): (r.before0, r.before1, r.name) for r in suffix_dedup.counts_before(work, df, ["a", "b"], classes=2).collect()}
        keys = sorted({r[:2] for r in rows})
        less = {k: tuple(sum(r[:2] < k and r[4] == c for r in rows) for c in (0, 1)) for k in keys}
        assert got == {(t, i): (*less[a, b], keys.index((a, b))) for a, b, t, i, _ in rows}
        assert max(r["count"] for r in work.last.filter("tid IS NOT NULL").groupBy("range").count().collect()) < len(rows) / 2


def test_suffix_dedup_of_hot_strings_over_many_ranges(spark, many_ranges):
    rng = random.Random(7)
    passage = "".join(rng.choice("xyz") for _ in range(40))
    rows = [(i, "".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) + (passage if i % 3 else "r" * rng.randint(0, 60))) for i in range(60)]
    got = suffix_dedup.suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 20).collect()
    assert sorted((r.row.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == brute_op5(rows, 20)


def test_suffix_dedup_of_nothing(no_docs):
    assert suffix_dedup.suffix_dedup(no_docs).collect() == []


def brute_op1(rows, n, percent):
    sets = {}
    for i, t in rows:
        ws = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(ws[j : j + n]) for j in range(len(ws) - n + 1)} if len(ws) >= n else ({tuple(ws)} if ws else set())
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = sorted((top(a), top(b)))
                    up[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def near_copies(rng, n, words, changes):
    base = [f"w{rng.randrange(400)}" for _ in range(words)]
    for _ in range(n):
        ws = list(base)
        for _ in range(rng.randint(0, changes)):
            ws[rng.randrange(words)] = f"z{rng.randrange(10**6)}"
        yield " ".join(ws)


def test_jaccard_components_equal_brute_force(spark, monkeypatch):
    rng = random.Random(9)
    texts = [*near_copies(rng, 60, 200, 6), *near_copies(rng, 40, 80, 3), *near_copies(rng, 40, 30, 1), *near_copies(rng, 40, 12, 1)]
    texts += [" ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += ["A b c", "a B c", "a b", "a b", "a", "", None, texts[0], texts[0]]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for n, percent, block, bits in ((3, 90, 512, 24), (3, 90, 16, 19), (5, 80, 16, 24)):
        monkeypatch.setattr(ngram_join, "BLOCK", block)
        monkeypatch.setattr(ngram_join, "FILTER_BITS", bits)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.jaccard_components(df, n, percent).collect()}
        assert got == brute_op1(rows, n, percent), (n, percent, block)


def test_jaccard_edges(edge_docs, no_docs):
    got = sorted(map(tuple, ngram_join.jaccard_components(edge_docs, 3, 90).filter("doc_id IS NOT NULL").collect()))
    rows = [(r.doc_id, r.text) for r in edge_docs.collect() if r.doc_id is not None]
    want = brute_op1(rows, 3, 90)
    assert got == sorted((i, *want[i]) for i, _ in rows)
    assert ngram_join.jaccard_components(edge_docs, 3, 90).filter("doc_id IS NULL AND component_id IS NULL").count() == 2
    assert ngram_join.jaccard_components(no_docs, 3, 90).collect() == []


def test_jaccard_ids_with_several_texts_equal_sql(spark):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(1, a), (2, b), (5, a), (5, b), (6, c + " end"), (7, c), (7, ""), (8, d), (9, d), (9, "one"), (10, "two")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    con = duckdb.connect()
    con.register("documents", df.toPandas())
    ok, message = compare(ngram_join.jaccard_components(df, 3, 90), con, ngram_join.ORACLE_SQL)
    assert ok, message


@pytest.mark.parametrize("edges", [[], [(i, i + 1) for i in range(40)], [(5, 3), (3, 9), (7, 8)]])
def test_components(spark, edges):
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = {x: 0 for e in edges for x in e} if len(edges) > 3 else {3: 3, 5: 3, 9: 3, 7: 7, 8: 7} if edges else {}
    assert got == want
