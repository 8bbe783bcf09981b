"""Operator 4 — substring dedup by seed and extend over word sequences.

A word of a document goes when a run of ``window`` words that covers it also
starts in a document with a smaller id. Steps, each one Spark job stage:

1. *Seed*: every text is winnowed. Of the k-grams inside each run of ``window``
   words the one with the least hash is an anchor, so equal runs have an equal
   anchor at an equal offset. Anchors are dealt by hash; those of two or more
   documents are shared.
2. *Extend*: texts with shared anchors are joined with their anchor places. Each
   anchor is extended both ways to the runs of ``window`` words that chose it;
   runs are dealt by a 128-bit hash, and all but those of the smallest id match.
3. Matching runs that touch or overlap make a maximal repeat; its words go.

Hot groups are pre-aggregated before each shuffle: within a slice of texts an
anchor or run that several documents have is settled on the spot, and one row
for the slice goes on. So a passage in a third of all rows costs one row per
slice (some thousand documents), not one per document. Whole copies are found
first, by hash, and their runs are not dealt at all.

Defined cases: a null or empty text has no words; a text with fewer than
``window`` words loses nothing; a null id is smaller than no id and loses
nothing; rows that repeat an id and its text each get the same result and are
no copies of each other; rows with equal ids never match each other. An empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.llm import wordhash as wh

WINDOW = 13
SEED_WORDS = 5

# A text's tag (31 bits of its checksum) tells texts under one id apart;
# run = tag * 2^32 + 2 * (first word + 1) + (1 if the run's words occur again in the text).
_TAG_SHIFT = 32
# A seed row's place is 4 * (word or hash) + kind; narrow rows make the largest shuffle small.
_KNOWN, _OPEN, _MARK, _COPY = 0, 1, 2, 3
_SEED_SCHEMA = "key long, doc_id long, place long"
_SEED_ARROW = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64())])
# A run row whose key2 is 0 is settled.
_RUN_SCHEMA = "key long, key2 long, doc_id long, run long"
_RUN_ARROW = pa.schema([("key", pa.int64()), ("key2", pa.int64()), ("doc_id", pa.int64()), ("run", pa.int64())])


def _batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _spread(doc: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Keys that deal settled rows evenly."""
    return wh.signed(wh.mix(doc.astype(np.uint64) ^ (pos.astype(np.uint64) << np.uint64(40))))


def _several(new: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row of sorted (group, doc): group number, the group's least id, whether it has two ids."""
    group = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(new)) - 1
    return group, doc[first][group], (doc[last] != doc[first])[group]


def _copy_mark(text_hash: np.ndarray) -> np.ndarray:
    """A negative place that says: the text with this hash copies an earlier document."""
    return -1 - (text_hash >> np.uint64(34)).astype(np.int64)


def _seed_rows(window: int, k: int):
    def run(batches):
        for batch in batches:
            for part in wh.slices(batch):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
                w = wh.words(part.column("text"))
                h = wh.word_hashes(w)
                long = w.counts >= window
                whole1, whole2 = wh.row_hashes(h, w), wh.row_hashes(h, w, salt=0x51ED)
                rows = np.flatnonzero(long)
                rows = rows[np.lexsort((ids[rows], whole2[rows], whole1[rows]))]
                new = wh.group_starts(whole1[rows], whole2[rows])
                same, least, _ = _several(new, ids[rows]) if len(rows) else (rows, ids[rows], None)
                copy = rows[ids[rows] > least]
                lead = rows[new]
                text = np.arange(len(ids))  # the first row with the row's text
                text[rows] = lead[same]
                skip = np.zeros(len(ids), bool)
                skip[copy] = True
                yield _batch(_SEED_ARROW, _spread(ids[copy], copy), ids[copy], 4 * _copy_mark(whole2[copy]) + _KNOWN)
                yield _batch(_SEED_ARROW, wh.signed(whole1[lead]), ids[lead], wh.signed(whole2[lead] | np.uint64(_COPY)))
                ok = wh.whole(w.row, window)
                if not len(ok):
                    continue
                ok &= ~skip[w.row[: len(ok)]]
                g = wh.ngram_hashes(h, k)
                at = wh.winnow(g, ok, window - k + 1)
                at = wh.distinct_sorted(at[at >= 0])
                doc, own, pos, key = ids[w.row[at]], text[w.row[at]], w.position()[at], g[at]
                order = np.lexsort((own, doc, key))
                doc, own, pos, key = doc[order], own[order], pos[order], key[order]
                # _extend finds the repeats in a text again, but other texts under the id have places of their own
                once = wh.group_starts(key, doc, own) if len(key) else np.zeros(0, bool)
                doc, pos, key = doc[once], pos[once], key[once]
                new = wh.group_starts(key)
                _, _, many = _several(new, doc) if len(key) else (None, None, new)
                mark = new & many
                for pick, kind in ((many, _KNOWN), (mark, _MARK), (~many, _OPEN)):
                    deal = _spread(doc[pick], pos[pick]) if kind == _KNOWN else wh.signed(key[pick])
                    yield _batch(_SEED_ARROW, deal, doc[pick], 4 * pos[pick] + kind)

    return run


def _shared_places(batches):
    """(doc_id, pos) of anchors that two documents have; a negative pos marks a copy of an earlier document."""
    schema = pa.schema([("doc_id", pa.int64()), ("pos", pa.int32())])
    for c in wh.whole_groups(batches, ["key"]):
        kind, pos = c["place"] & 3, c["place"] >> 2
        text = np.where(kind == _COPY, pos, -1)  # the second half of a whole text's hash
        order = np.lexsort((c["doc_id"], text, c["key"]))
        key, doc, kind, pos, text = c["key"][order], c["doc_id"][order], kind[order], pos[order], text[order]
        new = wh.group_starts(key, text)
        group, least, many = _several(new, doc)
        # a mark stands for two documents of its slice, so it settles its group alone
        marked = np.zeros(group[-1] + 1, bool)
        marked[group[kind == _MARK]] = True
        out = (kind == _KNOWN) | ((kind == _OPEN) & (many | marked[group])) | ((kind == _COPY) & (doc > least))
        mark = _copy_mark(pos.astype(np.uint64) << np.uint64(2))
        yield _batch(schema, doc[out], np.where(kind == _COPY, mark, pos)[out])


def _extend(window: int, k: int):
    def extend(batches):
        for batch in batches:
            for part in wh.slices(batch):
                ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
                tags = part.column("tag").to_numpy(zero_copy_only=False).astype(np.int64)
                places = part.column("places")
                w = wh.words(part.column("text"))
                flat = places.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                size = np.diff(np.frombuffer(places.buffers()[1], np.int32)[places.offset : places.offset + len(places) + 1])
                owner = np.repeat(np.arange(len(ids)), size)
                copy = np.zeros(len(ids), bool)
                h = wh.word_hashes(w)
                copy[owner[flat == _copy_mark(wh.row_hashes(h, w, salt=0x51ED))[owner]]] = True
                yield _batch(_RUN_ARROW, _spread(ids[copy], tags[copy]), np.zeros(copy.sum(), np.int64), ids[copy], tags[copy] << _TAG_SHIFT)
                ok = wh.whole(w.row, window)
                if not len(ok):
                    continue
                fits = (flat >= 0) & (flat < w.counts[owner] - k + 1) & ~copy[owner]
                seeds = (w.first[owner] + flat)[fits]
                g = wh.ngram_hashes(h, k)
                own = g ^ wh.mix(w.row[: len(g)].astype(np.uint64))  # an anchor within its text
                at = wh.winnow(g, ok, window - k + 1)
                start = np.flatnonzero(at >= 0)
                start = start[np.isin(own[at[start]], own[seeds])]
                h1 = wh.ngram_hashes(h, window)[start]
                h2 = wh.ngram_hashes(wh.word_hashes(w, 1), window)[start] | np.uint64(1)
                row = w.row[start]
                doc, run = ids[row], (tags[row] << _TAG_SHIFT) + 2 * (w.position()[start] + 1)
                order = np.lexsort((run, doc, h2, h1))
                h1, h2, doc, run = h1[order], h2[order], doc[order], run[order]
                # a run that repeats within a text is one row, marked so that _cut finds the repeats again
                once = wh.group_starts(h1, h2, run >> _TAG_SHIFT, doc) if len(doc) else np.zeros(0, bool)
                first = np.flatnonzero(once)
                several = np.diff(np.append(first, len(doc))) > 1
                h1, h2, doc, run = h1[first], h2[first], doc[first], run[first] + several
                new = wh.group_starts(h1, h2)
                _, least, _ = _several(new, doc) if len(doc) else (None, doc, None)
                known = doc > least
                yield _batch(_RUN_ARROW, np.where(known, _spread(doc, run), wh.signed(h1)), np.where(known, 0, wh.signed(h2)), doc, run)

    return extend


def _matches(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("run", pa.int64())])
    for c in wh.whole_groups(batches, ["key", "key2"]):
        _, least, _ = _several(wh.group_starts(c["key"], c["key2"]), c["doc_id"])
        out = (c["key2"] == 0) | (c["doc_id"] > least)
        yield _batch(schema, c["doc_id"][out], c["run"][out])


def matching_runs(docs: DataFrame, dealt: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS) -> DataFrame:
    """(doc_id, runs): packed (tag, first word) of the runs of ``window`` words that start in an earlier document.

    ``docs`` has doc_id, tag and text; ``dealt`` are the same rows dealt by
    doc_id. First word -1 says that all of the text copies an earlier document.
    """
    seeds = docs.select("doc_id", "text").mapInArrow(_seed_rows(window, seed_words), _SEED_SCHEMA)
    seeds = seeds.repartition("key").sortWithinPartitions("key", "doc_id")
    places = seeds.mapInArrow(_shared_places, "doc_id long, pos int")
    places = places.groupBy("doc_id").agg(F.collect_set("pos").alias("places"))
    seeded = dealt.join(places, "doc_id")
    runs = seeded.mapInArrow(_extend(window, seed_words), _RUN_SCHEMA)
    runs = runs.repartition("key", "key2").sortWithinPartitions("key", "key2", "doc_id")
    runs = runs.mapInArrow(_matches, "doc_id long, run long")
    return runs.groupBy("doc_id").agg(F.collect_set("run").alias("runs"))


def _with_repeats(words: list[bytes], at: np.ndarray, several: np.ndarray, window: int) -> np.ndarray:
    """``at`` and all places whose ``window`` words equal those at a place of ``several``."""
    number: dict[bytes, int] = {}
    codes = wh.mix(np.array([number.setdefault(x, len(number)) for x in words], np.uint64))
    g = wh.ngram_hashes(codes, window)
    return np.union1d(at, np.flatnonzero(np.isin(g, g[several])))


def _cut(window: int, carry: bool):
    names = [*(["row"] if carry else []), "doc_id", "kept_text", "n_words", "n_removed", *(["text"] if carry else [])]

    def run(batches):
        for batch in batches:
            for part in wh.slices(batch):
                kept, n_words, n_removed = [], [], []
                for text, tag, runs in zip(*(part.column(c).to_pylist() for c in ("text", "tag", "runs")), strict=True):
                    words = (text or "").encode().split()
                    out, gone = words, 0
                    if runs:
                        runs = np.array(runs)
                        mine = runs[(runs >> _TAG_SHIFT) == tag] & ((1 << _TAG_SHIFT) - 1)
                        at = (mine >> 1) - 1
                        if (mine & 1).any():
                            at = _with_repeats(words, at, at[(mine & 1) == 1], window)
                        delta = np.zeros(len(words) + 1, np.int64)
                        if (at < 0).any():
                            delta[0], delta[-1] = 1, -1
                        else:
                            delta[at] += 1
                            delta[at + window] -= 1
                        hit = np.cumsum(delta[:-1]) > 0
                        gone = int(hit.sum())
                        out = [words[i] for i in np.flatnonzero(~hit)]
                    kept.append(b" ".join(out).decode())
                    n_words.append(len(words))
                    n_removed.append(gone)
                cols = [part.column("doc_id"), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
                yield pa.RecordBatch.from_arrays([part.column("row"), *cols, part.column("text")] if carry else cols, names=names)

    return run


def substring_dedup(docs: DataFrame, window: int = WINDOW, seed_words: int = SEED_WORDS, carry: bool = False) -> DataFrame:
    """One row per document: doc_id, kept_text (words joined by a space), n_words, n_removed.

    ``carry`` adds the text and the struct ``row`` with the input's other columns,
    whatever their names. See the module text for the method and the defined cases. Texts
    are dealt by id once; both joins read that exchange.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # an alias would keep Spark from seeing that both uses of the exchange are the same
    base = docs.select(
        F.col("doc_id") if dict(docs.dtypes)["doc_id"] == "bigint" else F.col("doc_id").cast("long").alias("doc_id"),
        F.crc32(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit((1 << 31) - 1)).alias("tag"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *([F.struct(*[F.col(f"`{c}`") for c in rest], F.lit(True).alias("__row")).alias("row")] if carry else []),
    )
    named = base.filter("doc_id IS NOT NULL")
    dealt = named.repartition("doc_id")
    runs = matching_runs(named, dealt, window, seed_words)
    joined = dealt.join(runs, "doc_id", "left")
    joined = joined.unionByName(base.filter("doc_id IS NULL"), allowMissingColumns=True)
    out = "doc_id long, kept_text string, n_words long, n_removed long"
    if carry:
        out = wh.schema_with(base.schema["row"], out + ", text string")
    return joined.select("doc_id", "tag", "text", "runs", *(["row"] if carry else [])).mapInArrow(_cut(window, carry), out)


def op4_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Contract query: doc_id, n_words, n_removed, kept_sha256 for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return substring_dedup(docs).select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))



#: DuckDB twin.
ORACLE_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT rid, doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS i FROM d WHERE len(w) >= {WINDOW}),
g AS (SELECT rid, doc_id, i, array_to_string(w[i:i + {WINDOW} - 1], ' ') AS g FROM s),
m AS (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS least FROM g),
r AS (SELECT DISTINCT rid, unnest(range(i, i + {WINDOW})) AS p FROM m WHERE least < doc_id),
u AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
k AS (SELECT rid, count(*) AS kept, string_agg(word, ' ' ORDER BY p) AS t FROM u ANTI JOIN r USING (rid, p) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(kept, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN k USING (rid)
"""
