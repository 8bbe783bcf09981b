"""Operator 1: wide bitmaps and the looks at groups with many pairs."""

import random

import numpy as np
import pytest

from rankmill.llm import ngram_join as J


@pytest.mark.parametrize("percent", [80, 90])
def test_wide_bitmaps_never_exceed_the_difference(percent):
    rng = np.random.default_rng(percent)
    base = rng.integers(0, 1 << 63, 6000, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[: n - e], rng.integers(0, 1 << 63, e, dtype=np.uint64)])) for n in (40, 300, 1500, 2100, 5800, 6000) for e in (0, 3, 30)]
    sets += [base, np.unique(base[:5900]), base[:0], base[:1]]
    blobs = np.array([J.wide_parity(s, percent) for s in sets] + [None], object)[:-1]
    wide = J._WideParity(blobs)
    i, j = np.triu_indices(len(sets), 1)
    got = wide.differ(i, j)
    true = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j)])
    assert (got <= true).all()
    # large sets that differ by twice what a link may are told apart, and links pass
    size = np.array([len(s) for s in sets])
    allowed = size[i] + size[j] - 2 * (-(-percent * (size[i] + size[j]) // (100 + percent)))
    far = (np.minimum(size[i], size[j]) > 1400) & (true > 2 * allowed) & (np.maximum(size[i], size[j]) < 1.5 * np.minimum(size[i], size[j]))
    assert far.any() and (got[far] > allowed[far]).all()
    assert J.wide_parity(base[:0], percent) is None


def _chained(rng, families, members, words, step):
    """Families in which only neighbours are linked, so that components grow by chains."""
    out, number = [], 0
    for f in range(families):
        text = [f"w{f}x{rng.randrange(10**6)}" for _ in range(words)]
        for _ in range(members):
            number += 1
            out.append((number, " ".join(text)))
            for _ in range(step):
                text[rng.randrange(words)] = f"n{rng.randrange(10**9)}"
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("words", "step", "members"), [(60, 1, 40), (1500, 12, 24)])
def test_families_in_small_blocks_lose_no_link(spark, monkeypatch, words, step, members):
    monkeypatch.setattr(J, "BLOCK", 5)
    rng = random.Random(words)
    rows = _chained(rng, 3, members, words, step)
    sets = {d: {tuple(t.split()[i : i + 3]) for i in range(words - 2)} for d, t in rows}
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    got = {r.doc_id: r.component_id for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90).collect()}
    assert got == {d: root(d) for d in sets}


def test_groups_keep_only_sizes_that_can_be_linked(spark):
    """Of rows that share a token, those without a partner of a fitting size go before they are dealt on."""
    import pyarrow as pa

    rows = [(7, 100, 1, 1), (7, 112, 2, 2), (7, 112, 2, 2), (7, 90, 3, 3), (7, 500, 4, 4), (8, 10, 1, 1), (8, 12, 2, 2), (9, 5, 6, 6), (9, 5, 6, 6)]
    rows = sorted(rows)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows]), pa.array([r[3] for r in rows])], ["token", "size", "s1", "s2"])
    got = [tuple(r.values()) for b in J._shared_tokens(90, 2)([batch.slice(0, 3), batch.slice(3)]) for r in b.to_pylist()]
    assert got == [(7, 0, 1, 3, 3), (7, 0, 1, 1, 1)]


def test_first_pairs_use_the_wide_bitmaps(spark, tmp_path, monkeypatch):
    """Long texts that share passages but are no near copies reach no set comparison."""
    rng = random.Random(5)
    # every two texts have a passage of their own, so that the rarest tokens are shared ones
    passage = {(i, k): " ".join(f"s{rng.randrange(10**9)}" for _ in range(500)) for k in range(7) for i in range(k)}
    rows = [(k, " ".join(t for ik, t in passage.items() if k in ik)) for k in range(7)]
    rows += [(100, rows[0][1]), (101, rows[0][1] + " tail")]
    monkeypatch.setattr(J, "checkpoint_dir", lambda spark: str(tmp_path))
    got = {r.doc_id: r.component_id for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert got == {k: 0 if k > 99 else k for k, _ in rows}
    (sets,) = tmp_path.glob("ngram-join-*/sets")
    assert spark.read.parquet(str(sets)).count() == 2


def test_no_stage_runs_two_python_functions(spark, monkeypatch):
    """Each one takes a worker process of every running task, and its memory stays with it."""
    plans = []

    def written(df, path):
        plans.append((path, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, path)

    real = J.written
    monkeypatch.setattr(J, "written", written)
    rng = random.Random(3)
    docs = spark.createDataFrame(_chained(rng, 2, 6, 120, 2), "doc_id long, text string")
    out = J.jaccard_components(docs, 3, 90)
    plans.append(("result", out._jdf.queryExecution().executedPlan().toString()))
    assert len(plans) > 8
    for path, plan in plans:
        # walk up from every Python function: an exchange comes before the next one
        above = {}
        for line in plan.splitlines():
            depth = len(line) - len(line.lstrip(" :+-*()0123456789"))
            above = {d: x for d, x in above.items() if d < depth}
            name = line.lstrip(" :+-*()0123456789")
            near = max(above, default=None)
            state = above[near] if near is not None else False
            if "InArrow" in name.split(" ")[0] or "MapInArrow" in name[:24]:
                assert not state, (path, plan)
                state = True
            elif "Exchange" in name.split(" ")[0]:
                state = False
            above[depth] = state


@pytest.mark.parametrize("slices", [1, 3])
def test_the_sketch_counts_every_shingle(spark, slices):
    rng = random.Random(slices)
    rows = [(" ".join(rng.choice("abcdefgh") + str(rng.randrange(3)) for _ in range(rng.choice((1, 2, 3, 40)))),) for _ in range(200)]
    got = J.token_frequency(spark.createDataFrame(rows, "text string").repartition(slices), 3)
    want = np.zeros(1 << J.SKETCH_BITS, np.int64)
    for (text,) in rows:
        w = J.wh.words(J.pa.array([text]))
        for cell in J._cell(J.wh.ngram_hashes(J.wh.word_hashes(w), 3)):
            want[cell] += 1
    assert (got == np.frexp(want.astype(float))[1]).all()
