"""Operator 10 — benchmark decontamination by greedy string tiling.

Texts and benchmark items become lower-case words of letters and digits. A
document is a candidate for an item when it has one of the item's seeds (all its
runs of ``seed_words`` words; an item with fewer words is one seed). Greedy
string tiling then covers the pair: running Karp-Rabin looks for common runs of
the greatest length first, marks them so that no word is used twice, and goes on
with shorter ones down to ``seed_words``. An item whose covered share reaches
``coverage`` contaminates the document, whatever the order of its passages.

Seeds are joined in one of two ways with equal results. While the benchmark has
at most ``MAX_BROADCAST_WORDS`` words (counted first), its words and seeds go to
every task, and a document is tested where it is read, without a shuffle. Beyond
that, seeds of both sides are dealt by hash and joined, and candidate pairs fetch
text and item by id; seeds are distinct per document before that shuffle, and
Spark splits skewed seeds, of which the benchmark side has few rows.

Defined cases: null and empty texts, and items without words, match nothing; an
item with a null id counts like others, so its documents have a coverage above 0,
but it is not in the list of ids;
null ids stay null; rows that repeat an id are judged one by one on the broadcast
path, and together on the other if their texts are equal too. Equal items are
one. Other columns are kept in ``row``, whatever their names. Empty tables give
empty results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankmill.llm import wordhash as wh

SEED_WORDS = 5
COVERAGE = 0.8
MAX_BROADCAST_WORDS = 2_000_000

# ASCII bytes that are no letter and no digit part words; bytes of other characters belong to words.
_APART = np.array([not (chr(b).isalnum() or b >= 128) for b in range(256)])


def hashed_words(texts: pa.Array) -> tuple[wh.Words, np.ndarray]:
    w = wh.words(texts, lower=True, separators=_APART)
    return w, wh.word_hashes(w)


def _seed_table(items: list[np.ndarray], k: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Run length -> (sorted seed hashes, item numbers), for ``k`` and for the lengths of shorter items."""
    by_length: dict[int, list] = {}
    for i, h in enumerate(items):
        n = min(k, len(h))
        if n:
            seeds = np.unique(wh.ngram_hashes(h, n))
            by_length.setdefault(n, []).append((seeds, np.full(len(seeds), i)))
    table = {}
    for n, parts in by_length.items():
        seeds, owner = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        order = np.lexsort((owner, seeds))
        table[n] = seeds[order], owner[order]
    return table


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> int:
    """Words of ``item`` covered by greedy string tiling with runs of at least ``least`` words.

    Running Karp-Rabin: at each length the hashes of the unmarked runs of the
    item are looked up among those of the document; matches are extended as far
    as they go, longest first.
    """
    free_doc, free_item = np.ones(len(doc), bool), np.ones(len(item), bool)
    least = max(1, min(least, len(item)))
    # only places near a common seed can be part of a run
    common = np.isin(wh.ngram_hashes(doc, least), wh.ngram_hashes(item, least))
    if not common.any():
        return 0
    length = min(len(item), int(_longest(common)) + least - 1)
    while length >= least:
        g_item, g_doc = wh.ngram_hashes(item, length), wh.ngram_hashes(doc, length)
        ok_item = _all_free(free_item, length)
        places = np.flatnonzero(_all_free(free_doc, length) & np.isin(g_doc, g_item[ok_item]))
        for p in places:
            if not free_doc[p : p + length].all():
                continue
            for q in np.flatnonzero(g_item == g_doc[p]):
                if free_item[q : q + length].all():
                    free_doc[p : p + length] = False
                    free_item[q : q + length] = False
                    break
        length -= 1
    return int((~free_item).sum())


def _longest(flags: np.ndarray) -> int:
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return int((edges[1::2] - edges[::2]).max(initial=0))


def _all_free(free: np.ndarray, length: int) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(~free)])
    return sums[length:] == sums[:-length] if len(free) >= length else np.zeros(0, bool)


def _near(doc: np.ndarray, item: np.ndarray, least: int) -> np.ndarray:
    """The document's words within common runs, a mark between runs: tiling sees the same matches."""
    least = max(1, min(least, len(item)))
    hit = np.flatnonzero(np.isin(wh.ngram_hashes(doc, least), wh.ngram_hashes(item, least)))
    keep = np.zeros(len(doc) + 1, np.int64)
    np.add.at(keep, hit, 1)
    np.add.at(keep, hit + least, -1)
    keep = np.cumsum(keep[:-1]) > 0
    at = np.flatnonzero(keep)
    out = doc[at]
    gaps = np.flatnonzero(np.diff(at) > 1) + 1
    # the marks are hashes that no word of the pair has
    return np.insert(out, gaps, wh.mix(np.arange(1, len(gaps) + 1, dtype=np.uint64) ^ np.uint64(0xC0FFEE)))


def _found(h: np.ndarray, first: np.ndarray, rows: np.ndarray, numbers: np.ndarray, items: list[np.ndarray], k: int, coverage: float):
    """(row, item number, covered share) of the candidate pairs that pass."""
    for r, i in zip(rows, numbers, strict=True):
        doc, item = h[first[r] : first[r + 1]], items[i]
        share = tile(_near(doc, item, k), item, k) / len(item)
        if share >= coverage:
            yield int(r), int(i), share


def candidates(w: wh.Words, h: np.ndarray, table: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, item number) pairs that share a seed."""
    rows, numbers = [], []
    for n, (seeds, owner) in table.items():
        g = wh.ngram_hashes(h, n)
        at = np.flatnonzero(wh.whole(w.row, n))
        lo = np.searchsorted(seeds, g[at])
        hit = lo < len(seeds)
        hit[hit] = seeds[lo[hit]] == g[at][hit]
        at, lo = at[hit], lo[hit]
        many = np.searchsorted(seeds, g[at], side="right") - lo
        rows.append(np.repeat(w.row[at], many))
        numbers.append(owner[np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pairs = np.unique(np.stack([np.concatenate(rows), np.concatenate(numbers)], 1), axis=0)
    return pairs[:, 0], pairs[:, 1]


_FOUND = "contamination struct<items:array<bigint>,coverage:double>"


def _found_column(n_rows: int, found: dict[int, list]) -> pa.Array:
    items = [sorted(i for i, _ in found.get(r, []) if i is not None) for r in range(n_rows)]
    best = [max((c for _, c in found.get(r, [])), default=0.0) for r in range(n_rows)]
    return pa.StructArray.from_arrays([pa.array(items, pa.list_(pa.int64())), pa.array(best, pa.float64())], ["items", "coverage"])


def _broadcast_path(rows: DataFrame, bench: list, k: int, coverage: float) -> DataFrame:
    ids, texts = [b[0] for b in bench], pa.array([b[1] for b in bench], pa.string())
    shared = rows.sparkSession.sparkContext.broadcast((ids, texts.to_pylist()))

    def run(batches):
        ids, texts = shared.value
        w, h = hashed_words(pa.array(texts, pa.string()))
        items = [h[w.first[i] : w.first[i + 1]] for i in range(len(ids))]
        table = _seed_table(items, k)
        for batch in batches:
            for part in wh.slices(batch, "__text"):
                w, h = hashed_words(part.column("__text"))
                found: dict[int, list] = {}
                for r, i, share in _found(h, w.first, *candidates(w, h, table), items, k, coverage):
                    found.setdefault(r, []).append((ids[i], share))
                yield pa.RecordBatch.from_arrays([part.column("row"), _found_column(part.num_rows, found)], ["row", "contamination"])

    return rows.mapInArrow(run, wh.schema_with(rows.schema["row"], _FOUND))


def _seed_rows(name: str, lengths: list[int], k: int | None):
    """Distinct (seed, id) rows of every text; with ``k`` an item's own seeds only."""

    def run(batches):
        for batch in batches:
            for part in wh.slices(batch, "__text"):
                w, h = hashed_words(part.column("__text"))
                key = part.column(name).to_numpy(zero_copy_only=False)
                for n in lengths:
                    ok = wh.whole(w.row, n)
                    if k is not None:
                        ok &= (np.minimum(w.counts, k) == n)[w.row[: len(ok)]]
                    g, row = wh.ngram_hashes(h, n)[ok], w.row[: len(ok)][ok]
                    order = np.lexsort((row, g))
                    g, row = g[order], row[order]
                    new = wh.group_starts(g, row) if len(g) else np.zeros(0, bool)
                    yield pa.RecordBatch.from_arrays([pa.array(wh.signed(g[new])), pa.array(np.full(new.sum(), n)), pa.array(key[row[new]], pa.string())], ["seed", "n", name])

    return run


def _shuffle_path(rows: DataFrame, items: DataFrame, k: int, coverage: float) -> DataFrame:
    lengths = list(range(1, k + 1))
    items = items.withColumn("__item", F.md5(F.concat_ws("|", F.coalesce(F.col("item_id").cast("string"), F.lit("null")), "__text")))
    rows = rows.withColumn("__doc", F.md5(F.concat(F.coalesce(F.col("row.doc_id").cast("string"), F.lit("null")), F.lit("|"), F.coalesce("__text", F.lit("")))))
    of_items = items.select("__item", "__text").mapInArrow(_seed_rows("__item", lengths, k), "seed long, n long, __item string")
    of_docs = rows.select("__doc", "__text").mapInArrow(_seed_rows("__doc", lengths, None), "seed long, n long, __doc string")
    pairs = of_docs.join(of_items, ["seed", "n"]).select("__doc", "__item").distinct()
    pairs = pairs.join(items.select("__item", "item_id", F.col("__text").alias("__item_text")), "__item")
    pairs = pairs.join(rows.select("__doc", "__text").dropDuplicates(["__doc"]), "__doc")

    def run(batches):
        for batch in batches:
            for part in wh.slices(batch, "__text"):
                w, h = hashed_words(part.column("__text"))
                wi, hi = hashed_words(part.column("__item_text"))
                items = [hi[wi.first[i] : wi.first[i + 1]] for i in range(part.num_rows)]
                every = np.arange(part.num_rows)
                got = list(_found(h, w.first, every, every, items, k, coverage))
                at = [g[0] for g in got]
                yield pa.RecordBatch.from_arrays([part.column("__doc").take(pa.array(at, pa.int64())), part.column("item_id").take(pa.array(at, pa.int64())), pa.array([g[2] for g in got], pa.float64())], ["__doc", "item_id", "share"])

    tiled = pairs.select("__doc", "item_id", "__text", "__item_text").mapInArrow(run, "__doc string, item_id long, share double")
    found = tiled.groupBy("__doc").agg(F.sort_array(F.collect_set("item_id")).alias("items"), F.max("share").alias("coverage"))
    joined = rows.join(found, "__doc", "left")
    return joined.select("row", F.struct(F.coalesce("items", F.expr("array()").cast("array<bigint>")).alias("items"), F.coalesce("coverage", F.lit(0.0)).alias("coverage")).alias("contamination"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, seed_words: int = SEED_WORDS, coverage: float = COVERAGE, max_broadcast_words: int = MAX_BROADCAST_WORDS) -> DataFrame:
    """One row per document: ``row`` (all its columns) and ``contamination`` (items found, best coverage)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("__text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("__text"))
    items = items.filter("__text IS NOT NULL").distinct()
    words = items.agg(F.coalesce(F.sum(F.octet_length("__text") / 2 + 1), F.lit(0)).alias("n")).first()["n"]  # an upper bound
    if words <= max_broadcast_words:
        bench = sorted(((r["item_id"], r["__text"]) for r in items.collect()), key=lambda b: (b[0] is None, b[0] or 0, b[1]))
        return _broadcast_path(rows, bench, seed_words, coverage)
    return _shuffle_path(rows, items, seed_words, coverage)


def is_contaminated() -> Column:
    """Some item was found, be its id null or not: what is found covers words."""
    return F.col("contamination.coverage") > 0


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """doc_id, contaminated, item_ids, coverage for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("row.doc_id", is_contaminated().alias("contaminated"), F.col("contamination.items").alias("item_ids"), F.col("contamination.coverage").alias("coverage"))
