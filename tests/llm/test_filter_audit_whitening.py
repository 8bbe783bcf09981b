"""Operators 11 to 13."""

import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from rankmill.llm import divergence, url_filter, whitening

CLASH = ", row string, host string, path string, keys long, a long, b long, x string, source long, `v.w` int"
TAIL = ("r", "h", "p", 1, 2, 3, "x", 4, 5)


# ------------------------------------------------------------------ operator 11
@pytest.mark.parametrize(("n", "share"), [(0, 0.0), (1, 1.0), (5_000, 0.0), (5_000, 0.001), (5_000, 0.3), (5_000, 0.9), (5_000, 1.0)])
def test_cascade_is_exact_over_its_universe(n, share):
    rng = np.random.default_rng(n + int(100 * share))
    a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for _ in range(2))
    listed = rng.random(n) < share
    levels = url_filter.unpack(url_filter.pack(url_filter.build_levels(a, b, listed)))
    assert (url_filter.contains(levels, a, b) == listed).all()
    if share == 0.001:  # a few listed keys take few bytes
        assert sum(len(bits) for _, _, bits in levels) < 64


def test_equal_hashes_of_a_listed_and_an_unlisted_key_are_reported():
    same = np.zeros(2, np.uint64)
    with pytest.raises(ValueError, match="same hashes"):
        url_filter.build_levels(same, same, np.array([True, False]))


def test_cascade_shards(spark):
    keys = spark.range(6000).select(F.concat(F.lit("p:"), (F.col("id") % 4000).cast("string")).alias("key"))
    listed = keys.filter("pmod(xxhash64(key), 7) = 0").union(spark.createDataFrame([("p:not there",), (None,)], "key string"))
    from rankmill.session import checkpoint_dir

    cascade = url_filter.build_cascade(keys, listed, f"{checkpoint_dir(spark)}/cascade-test", keys_per_shard=100)
    assert cascade.n_shards == 40
    rows = keys.distinct().select("key", F.xxhash64("key").alias("a"), F.xxhash64(F.lit("second"), "key").alias("b"), F.expr("pmod(xxhash64(key), 7) = 0").alias("want")).toPandas()
    got = cascade.reader()(rows["a"].to_numpy(), rows["b"].to_numpy())
    assert (got == rows["want"].to_numpy()).all()


URLS = [
    (1, "http://Www.Example.NET/en/1"), (2, "http://example.net/en"), (3, "https://a.example.com/de/x?y#z"), (4, "http://x.org/fr/"), (5, "http://org/fr/q"), (6, "http://borg/fr/"),
    (7, None), (8, ""), (9, "no scheme"), (10, "http://"), (11, "http://?utm_source=a"), (12, "http://net"), (13, "http://net/"), (14, "HTTP://NET/"), (15, "http://h.de/page?utm_source=f"),
    (16, "http://h.de/page#top"), (17, "http://h.de/other?xutm_source=f"), (18, "http://www.spam-farm.example.org/en/"), (19, "http://spam-farm/"), (20, "http://not-spam-farm.de/"),
    (21, "http://" + "a." * 200 + "spam-farm/"), (22, "http://spam-farm." + "a." * 200 + "b/"), (23, "a://b://c/d"), (24, "http://ÄÖ.net/ü"), (None, "http://x.org/fr/"), (1, "http://Www.Example.NET/en/1"),
    (25, "http://x.de/\n?utm_a=1"), (26, "file:///a/b"), (27, "http://u@example.net:80/en/"), (28, "http://free-bets.x/?q" + "é" * 40_000), (None, None),
]


def test_urls_against_the_twin(spark):
    pages = spark.createDataFrame([(i, u, *TAIL) for i, u in URLS], "page_id long, url string" + CLASH).repartition(3)
    out = url_filter.judge_urls(pages, url_filter.listed_keys(pages), keys_per_shard=5)
    got = out.select("row.page_id", "host", "path", "rule", "verdict", "listed").collect()
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", URLS)
    want = con.execute(url_filter.ORACLE_SQL).fetchall()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    by = {r.page_id: r for r in got}
    assert (by[1].host, by[1].rule, by[1].verdict) == ("www.example.net", "example.net/en/", "allow")
    assert (by[2].rule, by[2].verdict) == ("net/", "block")
    assert by[6].rule is None and by[5].rule == "org/fr/" and by[12].rule is None and by[13].rule == "net/"
    assert (by[7].host, by[7].path, by[7].verdict) == ("", "", "allow")
    assert [by[i].verdict for i in (15, 16, 17, 18, 20, 21, 22)] == ["block", "block", "allow", "block", "allow", "allow", "block"]
    assert out.select("row.`v.w`", "row.host").distinct().collect() == [(5, "h")]


def test_no_pages_and_no_list(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_filter.judge_urls(empty, url_filter.listed_keys(empty)).collect() == []
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    assert [r.verdict for r in url_filter.judge_urls(pages, spark.createDataFrame([], "key string")).collect()] == ["allow"]


# ------------------------------------------------------------------ operator 12
def brute_divergence(rows, min_docs, top):
    rows = [tuple(x or "" for x in r) for r in rows]
    docs, counts = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)
        docs[lang].update(set(found))
        counts[lang, source].update(found)
    out = []
    for lang in {x for x, _ in counts}:
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)
        sources = sorted(s for x, s in counts if x == lang)
        whole = sum((counts[lang, s] for s in sources), Counter())

        def prices(c, kept=kept):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q, p = prices(whole), {s: prices(counts[lang, s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:limit])]
    return out


def random_docs(rng, n):
    words = ["the", "The", "of", "stein", "Öl", "öl", "日本", "x", "y", "z", "zz", "é", "1", "a1b", "-", "\x00", "\u2028", "😀"]
    rows = []
    for _ in range(n):
        lang = rng.choice(["en", "en", "de", None, ""])
        source = rng.choice(["s1", "s1", "s1", "s2", "s3", "S4", "ü", None, "", "s5", "s6", "s7"])
        rows.append((" ".join(rng.choice(words) for _ in range(rng.randrange(30))) if rng.random() < 0.95 else None, lang, source))
    return rows + [("only here", "xx", "lonely"), (None, "yy", "a"), ("", "yy", "b"), ("Q" * 50_000 + " öl", "en", "s1")] + rows[:5]


@pytest.mark.parametrize(("min_docs", "slice_terms", "block", "held"), [(1, 1 << 16, 8, 200_000), (3, 2, 2, 5), (8, 1, 1, 1), (10**6, 4, 3, 50)])
def test_divergence_against_brute_force(spark, monkeypatch, min_docs, slice_terms, block, held):
    monkeypatch.setattr(divergence, "MIN_SLICES", 1)
    rows = random_docs(random.Random(min_docs), 150)
    # the columns carry other names, and the usual names other things
    df = spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], "t string, l string, s string, text long, lang long, term long, `a.b` long").repartition(4)
    got = divergence.source_divergence(df, min_docs, slice_terms, block, 4, held, text="t", lang="l", source="s").collect()
    assert sorted(map(tuple, got)) == sorted(brute_divergence(rows, min_docs, 4))


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(spark.createDataFrame([], "text string, lang string, source string")).collect() == []


def test_prices_do_not_overflow(spark):
    counts = [0, 1, 7, 10**12, 10**15 - 1]
    want = [1 + 10**9 * (c + 5) // (10**15 + 5 * 10**7) for c in counts]
    assert divergence.shares(np.array(counts), 10**15, 10**7).tolist() == want
    df = spark.createDataFrame([(c,) for c in counts], "c long").select("c", divergence.share(F.col("c"), F.lit(10**15), F.lit(10**7)).alias("p"))
    assert [r.p for r in df.orderBy("c").collect()] == want


@pytest.mark.parametrize("seed", range(20))
def test_merge_is_the_sum_over_the_union(seed):
    rng = random.Random(seed)
    a, b = ({rng.randrange(60): rng.randrange(100, 10**6) for _ in range(rng.choice([0, 1, 5, 60]))} for _ in range(2))
    za, zb = rng.randrange(100), rng.randrange(100)
    arrays = [np.array(x, np.int64) for d in (a, b) for x in (sorted(d), [d[k] for k in sorted(d)])]
    want = sum(abs(a.get(k, za) - b.get(k, zb)) for k in a.keys() | b.keys())
    assert divergence.merge(arrays[0], arrays[1], za, arrays[2], arrays[3], zb) == (want, len(a.keys() | b.keys()))


# ------------------------------------------------------------------ operator 13
@pytest.mark.parametrize("d", [1, 2, 3, 8, 33])
@pytest.mark.parametrize("kind", ["normal", "identity", "low rank", "clusters", "steep", "diagonal", "zero"])
def test_spectral_divide_and_conquer(d, kind):
    rng = np.random.default_rng(d)
    q, _ = np.linalg.qr(rng.normal(size=(d, d)))
    spectrum = {"clusters": np.repeat([7.0, 7.0, 1.0, 1e-3], d)[:d], "steep": 10.0 ** -np.arange(d).clip(0, 13), "low rank": np.where(np.arange(d) < max(1, d // 3), 5.0 + np.arange(d), 0.0)}
    a = {
        "normal": np.cov(rng.normal(size=(400, d)).T, bias=True).reshape(d, d),
        "identity": 3.0 * np.eye(d),
        "diagonal": np.diag(np.arange(d, dtype=float)),
        "zero": np.zeros((d, d)),
    }.get(kind)
    if a is None:
        a = q @ np.diag(spectrum[kind]) @ q.T
        a = (a + a.T) / 2
    e, v = whitening.spectral(a)
    scale = max(1e-300, np.linalg.norm(a))
    assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-13 * d * scale
    assert np.linalg.norm(a @ v - v * e) <= 1e-13 * d * scale and np.linalg.norm(v.T @ v - np.eye(d)) <= 1e-13 * d
    assert (np.diff(e) <= 1e-13 * scale).all()


def test_polar_factor():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(40, 40))
    a = a + a.T
    w, v = np.linalg.eigh(a)
    assert np.abs(whitening.polar(a) - (v * np.sign(w)) @ v.T).max() < 1e-12


def brute_whitening(vectors, top):
    xs = [tuple(math.floor(256 * float(np.float32(c))) for c in v) for v in vectors]
    fit = sorted(set(xs))
    n, d = len(fit), len(fit[0])
    s = [sum(x[i] for x in fit) for i in range(d)]
    m = np.array(fit, float) - np.array(s) / n
    v = m.T @ m / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:top], q[:, ::-1][:, :top]
    return [(n, sum((n * c - t) ** 2 for c, t in zip(x, s))) for x in xs], (np.array(xs) - np.array(s) / n) @ q / np.sqrt(e), e / np.trace(v)


def test_whitening_against_eigh(spark):
    rng = np.random.default_rng(5)
    base = (rng.normal(size=(300, 12)) @ np.diag(np.linspace(1, 3, 12)) @ rng.normal(size=(12, 12))).astype(np.float32) * 0.3
    vectors = [v.tolist() for v in base] + [base[0].tolist()] * 100 + [base[1].tolist()]
    df = spark.createDataFrame([(i, v, *TAIL) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>" + CLASH).repartition(5)
    got = whitening.whiten(df, top=4).select("row.vec_id", "n", "deviation", "whitened", "explained", "identity_error", "row.`v.w`").orderBy("vec_id").collect()
    facts, white, explained = brute_whitening(vectors, 4)
    assert [(r.n, r.deviation) for r in got] == facts and {r["v.w"] for r in got} == {5}
    w = np.array([r.whitened for r in got])
    sign = np.sign((w * white).sum(axis=0))
    assert np.abs(w * sign - white).max() < 1e-9
    assert np.abs(np.array(got[0].explained) / explained - 1).max() < 1e-12 and all(r.identity_error == got[0].identity_error < 1e-10 for r in got)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, -0.001]), (2, None), (3, [1.0, None, 2.0]), (4, [nan, 1.0, 1.0]), (5, [inf, 1.0, 1.0]), (6, [-inf, 0.0, 0.0]), (7, [3.0, 1.0]), (8, []), (None, [1.0, 2.0, -0.001]), (9, [0.0, -0.0, 5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.row.vec_id: r for r in whitening.whiten(df).collect()}
    assert set(got) == {1, 7, 8, None, 9} and {r.n for r in got.values()} == {4}
    assert got[1].whitened == got[None].whitened and all(math.isfinite(x) for r in got.values() for x in r.whitened)
    assert got[1].identity_error < 1e-9  # three components of four distinct vectors have spread
    one = whitening.whiten(df.filter("vec_id = 1")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, [0.0] * 3, [0.0] * 3)]
    huge = whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [1e10]), (3, [-1.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.row.vec_id: r.deviation is None for r in huge}[1] and len(huge) == 3


def test_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [None])], schema)).collect() == []
    assert [r.whitened for r in whitening.whiten(spark.createDataFrame([(1, [])], schema)).collect()] == [[]]
