"""Operators 2, 3, 6, 7, 9 and 10."""

import random

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from harness import compare, duck
from pyspark.sql import functions as F

from rankmill.llm import bpe, decontaminate, langid, licenses, quality, toxicity

SF_SMALL = "/root/testdata/sf0.001"

SF = "/root/testdata/sf0.01"
PARTS = ["a", "th", "er", "ing", "'s", "'", "''", "'t", "'ll", " ", "  ", "\n", "<|endoftext|>", "<|end", "é", "é", "ﬁ", "日本", "😀", "İ", "ς", "1", "23", "!!", "...", "ñ", " ", "x" * 50, "thering" * 9]


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.load(bpe.tokenizer_json())


def test_tree_concatenation_equals_the_library(tokenizer):
    rng = random.Random(2)
    memo = bpe.Memo(tokenizer)
    for _ in range(300):
        t = "".join(rng.choice(PARTS) for _ in range(rng.randint(1, 300)))
        t = t.replace(" ", "") if rng.random() < 0.4 else t
        want = tokenizer.encode(t, add_special_tokens=False).ids
        sides = [bpe.Side.of(tokenizer, t[a:b], a) for a, b in bpe.halves(len(t), rng.choice([3, 17, 60, 200]))]
        assert bpe.concatenate_tree(tokenizer, t, sides).ids.tolist() == want
        ((ids, decoded),) = bpe.encode_words([t], memo)
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded == tokenizer.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("piece", [40, 1 << 15])
def test_bpe_rows(edge_docs, no_docs, tokenizer, piece):
    docs = edge_docs.withColumn("text", F.substring("text", 1, 4000)) if piece < 1000 else edge_docs
    rows = bpe.encode_decode(docs, piece_chars=piece).collect()
    assert len(rows) == edge_docs.count()
    for r in rows:
        want = tokenizer.encode(r.row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == want
        assert r.decoded == tokenizer.decode(want, skip_special_tokens=False)
    assert bpe.encode_decode(no_docs).collect() == []


def test_memo_keeps_words_in_use_and_stays_small(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_WORDS", 200)
    memo, plain, asked = bpe.Memo(tokenizer), bpe.Memo(tokenizer), []
    monkeypatch.setattr(memo, "plain", lambda word: asked.append(word) or plain.plain(word))
    for k in range(60):  # every third text goes without the frequent word
        words = [f"w{'abcdefghij'[j % 10]}{'abcdefghij'[j // 10]}" for j in range(k, k + 20)] + ["x" * (k + 1)] + ["river"] * (k % 3 > 0)
        text = " ".join(words + [w + "q" * (1 + k % 7) for w in words])
        ((ids, decoded),) = bpe.encode_words([text], memo)
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded == tokenizer.decode(want, skip_special_tokens=False)
        assert len(memo.known) + len(memo.old) <= 200
    assert asked.count(b"river") == 1


def test_closing_marks_are_words_of_their_own():
    assert bpe.separate_words("One, two!? (three) a.b, \u00f6. \u00f7. \u65e5. ..9;") == "one , two !? (three ) a.b , \u00f6 . \u00f7. \u65e5. ..9 ;".encode().split()


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.op3_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    n, right = got.count(), got.filter("lang = lang_pred").count()
    assert n > 100 and right >= 0.98 * n
    assert got.filter("score < 0 OR score > 1").count() == 0


def test_language_edges_and_switched_text(spark, edge_docs, no_docs):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    field = langid.train(docs, F.lit(True), max_rows=300)
    got = langid.identify(edge_docs, field)
    und = {r.row.doc_id for r in got.filter("language.lang = 'und'").collect()}
    assert got.count() == edge_docs.count() and und == {3, 4, 5, 11, None}
    assert langid.identify(no_docs, field).count() == 0
    assert langid.identify(edge_docs, None).filter("language.lang != 'und'").count() == 0
    assert langid.train(docs, F.lit(False)) is None
    half = [docs.filter(f"lang = '{x}' AND length(text) > 1500").orderBy("doc_id").first().text[:1400] for x in ("de", "fr")]
    shares = langid.identify(spark.createDataFrame([(1, half[0] + " " + half[1])], "doc_id long, text string"), field).first().language.shares
    assert shares[field.langs.index("de")] > 0.3 and shares[field.langs.index("fr")] > 0.3


def test_language_training_sees_whole_texts_and_rare_languages(spark):
    rng = random.Random(12)
    words = {x: [x + "".join(rng.choice(x + "aeiou") for _ in range(5)) for _ in range(40)] for x in "kmz"}
    prose = lambda x, n: " ".join(rng.choice(words[x]) for _ in range(n))
    header = prose("k", 700)  # a long beginning in another language
    hot = prose("k", 80)
    rows = [(i, hot if i % 2 else prose("k", 80), "k") for i in range(3000)]
    rows += [(5000 + i, f"{header} {prose('m', 3000)}", "m") for i in range(40)] + [(9000 + i, prose("z", 60), "z") for i in range(2)]
    field = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), F.lit(True), max_rows=60)
    assert field.langs == ["k", "m", "z"]
    probes = [(1, prose("m", 50), "m"), (2, prose("k", 50), "k"), (3, prose("z", 50), "z")]
    got = langid.identify(spark.createDataFrame(probes, "doc_id long, text string, lang string"), field).collect()
    assert all(r.language.lang == r.row.lang for r in got)


def test_forward_backward_equals_enumeration():
    import itertools

    import pyarrow as pa

    rng = np.random.default_rng(4)
    field = langid.Field(["a", "b"], rng.normal(size=(1 << langid.FEATURE_BITS, 2)).astype(np.float32), rng.normal(size=(2, 2)).astype(np.float32))
    w = langid.letter_words(pa.array(["ab cd ef", "x", "", "ab ab cd zz"]))
    e, move = field.emissions(w), np.exp(field.moves)
    for r, got in enumerate(field.shares(w)):
        at = np.flatnonzero(w.row == r)
        want, total = np.zeros(2), 0.0
        for path in itertools.product((0, 1), repeat=len(at)) if len(at) else []:
            p = np.prod([e[i, k] for i, k in zip(at, path)]) * np.prod([move[a, b] for a, b in zip(path, path[1:])])
            total += p
            for k in path:
                want[k] += p
        assert np.allclose(got, want / total if total else want, atol=1e-4)


def test_quality_equals_sql(spark):
    ok, message = compare(quality.op6_quality_rules(spark, SF_SMALL), duck(SF_SMALL), quality.ORACLE_SQL)
    assert ok, message


def test_quality_edges_equal_sql(spark, edge_docs, no_docs):
    rng = random.Random(8)
    extra = [(100 + i, " ".join(rng.choice("ab") for _ in range(n)), None, None, None, None) for i, n in enumerate((2, 3, 4, 60, 400))]
    extra += [(200, "- a\n- a\n\n* b\nend...\n" * 20, None, None, None, None), (201, "#*$ %&| <> x\r\ny\x0bz\x0c" * 40, None, None, None, None)]
    extra += [(202, " ".join(f"{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "xy") + " " + " ".join(f"{a}{b}{c}" for a in "abcdefgh" for b in "abcdefgh" for c in "xy"), None, None, None, None)]
    docs = edge_docs.union(spark.createDataFrame(extra, edge_docs.schema))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    got = quality.quality_rules(docs).select("row.doc_id", *[f"quality.{n}" for n in names])
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    ok, message = compare(got, con, quality.ORACLE_SQL)
    assert ok, message
    assert quality.quality_rules(no_docs).count() == 0


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = toxicity.op7_toxicity(spark, SF).join(labels, "doc_id").filter("held_out").toPandas()
    assert ((got["score"] >= 0) & (got["score"] <= 1)).all() and ((got["score"] >= 0.7) == (got["predicted"] == 1)).all()
    flagged, bad = got["predicted"] == 1, got["toxic"] == 1
    assert (flagged & bad).sum() >= 0.6 * bad.sum() and (flagged & ~bad).sum() <= 0.02 * (~bad).sum()


def test_grammar_contexts():
    g = toxicity.Grammar(toxicity.DEFAULT_TERMS, toxicity.DEFAULT_WEIGHTS)
    event = lambda t: dict(zip(toxicity.CONTEXTS, g.events(t)[0]))
    assert event("a moron walks")["plain"] == 3
    assert event("you are a Moron.")["targeted"] == 3
    assert event("he is not a moron")["negated"] == 3
    assert event("she said: fine. they claimed a moron")["reported"] == 3
    assert event("i will kill you")["threat"] == 3
    assert event("you. a moron")["targeted"] == 0  # a clause ends what a target governs
    score = {t: g.score(g.events(t)[0]) for t in ("you are a moron", "a moron", "not a moron", "a stone", "", None)}
    assert score["you are a moron"] > score["a moron"] > score["not a moron"] > score["a stone"] == score[""] == score[None]


def test_toxicity_edges(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None), (2, 7)], "doc_id long, toxic int")
    g = toxicity.train(edge_docs, labels, F.lit(True))  # one class only: the default lexicon
    assert g.terms == toxicity.DEFAULT_TERMS
    got = toxicity.score_documents(edge_docs, g)
    assert got.count() == edge_docs.count() and got.filter("toxicity.score IS NULL").count() == 0
    assert got.select("row.*").columns == edge_docs.columns
    assert toxicity.score_documents(no_docs, g).count() == 0


def test_licenses_equal_sql(spark):
    ok, message = compare(licenses.op9_license_scan(spark, SF), duck(SF), licenses.ORACLE_SQL)
    assert ok, message


def test_license_copies_and_changed_copies(spark, edge_docs, no_docs):
    rng = random.Random(3)
    rows = []
    for i in range(120):
        name, text = rng.choice(list(licenses.TEMPLATES.items()))
        w = text.split()
        if len(w) > 25 and i % 2:
            w[rng.randrange(len(w))] = "changed"
        pad = [" ".join(rng.choice(("stone", "river", "und", "the")) for _ in range(rng.randint(0, 90))) for _ in range(2)]
        rows.append((i, name, f"{pad[0]} {' '.join(w)} {pad[1]}"))
    got = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, want string, text string")).select("row.want", "licenses").collect()
    assert len(got) == 120 and all(r.want in r.licenses for r in got)
    assert [r.licenses for r in licenses.scan_licenses(edge_docs).collect()] == [[]] * edge_docs.count()
    assert licenses.scan_licenses(no_docs).collect() == []
    with pytest.raises(ValueError):
        licenses.scan_licenses(edge_docs, {"short": "two words"})


def test_decontamination_paths_agree_and_find_reordered_items(spark, edge_docs, no_docs):
    rng = random.Random(6)
    item = [" ".join(f"q{rng.randrange(900)}" for _ in range(30)) for _ in range(12)]
    bench = spark.createDataFrame([*enumerate(item), (50, "two words"), (51, ""), (52, None), (None, "null id here"), (53, item[3])], "item_id long, text string")
    noise = lambda n: " ".join(f"n{rng.randrange(900)}" for _ in range(n))
    w = [x.split() for x in item]
    rows = [
        (0, f"{noise(50)} {item[0].upper()}, {noise(50)}", [0]),
        (1, " ".join([*w[1][20:], noise(9), *w[1][10:20], noise(9), *w[1][:10]]), [1]),  # reordered
        (2, " ".join([noise(9), *w[2][:12], noise(30)]), []),  # too little of it
        (3, item[3], [3, 53]),
        (4, "say Two WORDS now", [50]),
        (5, None, []),
        (6, " ".join([*w[4][:10], *w[4][:10], *w[4][:10]]), []),  # repeats cover an item once
        (7, f"{item[5]} {noise(20)} {item[6]}", [5, 6]),
    ]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    for bound in (10**6, 0):
        got = {r.row.doc_id: r.contamination["items"] for r in decontaminate.decontaminate(docs, bench, max_broadcast_words=bound).collect()}
        assert got == {r[0]: r[2] for r in rows}, bound
        edge = decontaminate.decontaminate(edge_docs, bench, max_broadcast_words=bound)
        assert edge.count() == edge_docs.count() and edge.select("row.*").columns == edge_docs.columns
        assert decontaminate.decontaminate(no_docs, bench, max_broadcast_words=bound).count() == 0
        assert decontaminate.decontaminate(docs, bench.limit(0), max_broadcast_words=bound).filter("size(contamination.items) > 0").count() == 0


def test_items_without_an_id_contaminate(spark, tmp_path):
    item = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, f"a b {item} c"), (2, "a b c d e f"), (3, f"{item} v0 v1 v2 v3 v4 v5 v6")], "doc_id long, text string")
    bench = spark.createDataFrame([(None, item), (4, "v0 v1 v2 v3 v4 v5 v6")], "item_id long, text string")
    for bound in (decontaminate.MAX_BROADCAST_WORDS, 0):
        got = decontaminate.decontaminate(docs, bench, max_broadcast_words=bound).collect()
        assert sorted((r.row.doc_id, r.contamination["items"], r.contamination["coverage"]) for r in got) == [(1, [], 1.0), (2, [], 0.0), (3, [4], 1.0)], bound
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = decontaminate.op10_decontamination(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.contaminated for r in got} == {1: True, 2: False, 3: True}
    assert [r.doc_id for r in corpus_pipeline.drop_leaks(spark, docs, str(tmp_path)).collect()] == [2]


def test_tiling_marks_longest_first():
    a = np.arange(1, 30, dtype=np.uint64)
    assert decontaminate.tile(np.concatenate([a[15:], a[:15]]), a, 5) == 29
    assert decontaminate.tile(a[:4], a, 5) == 0
    assert decontaminate.tile(np.concatenate([a[:10], a[:10]]), a, 5) == 10


def test_op10_finds_every_whole_item(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    got = {r.doc_id: r.contaminated for r in decontaminate.op10_decontamination(spark, SF).collect()}
    assert len(got) == len(docs) and all(got[d.doc_id] for d in docs if any(i.text in (d.text or "") for i in items))
