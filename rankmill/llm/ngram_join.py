"""Operator 1 — n-gram Jaccard join with filters under several global token orders.

Documents are sets of word n-grams (as hashes). Equal sets are one node from the
start, so copies cost one row each. Under one global order of all tokens, two
sets of similarity t or more share a token among the first
``n - ceil(t n) + 1`` of either; that holds under any order, so a pair must pass
under each of several. All orders put frequent tokens last (by a count over all
documents in a sketch of fixed size) and break ties by a hash of their own, so
they differ and their filters are nearly independent.

1. The first order's prefix tokens are dealt by token, with the size of the set;
   nodes remain that have another of a size that can be linked in their group. Groups
   above ``BLOCK`` nodes are dealt again as pairs of blocks, so no task holds more than
   two blocks.
2. Pairs of a group are held against the length filter and a parity bitmap: the
   bits in which two bitmaps differ are a lower bound of the tokens in which the
   sets differ. This never loses a link. The short bitmap tells small sets apart; rows
   that are in a passing pair are dealt again with bitmaps as wide as their sets need.
3. Pairs that pass are checked under the other orders, on prefixes that are longer by
   l - 1 tokens and so share l in every link; of what passes, the whole sets are
   compared.
4. Of a group's pairs, one or two per node are checked first. When the components
   of those links are known, groups that have more pairs are looked at again:
   one pair for every two components that a group could join, and, when those are
   known, every pair that still lies between components. So a family of near copies is not written out as all its pairs, yet
   no link between components is lost.

Sets are made again from the texts of the nodes that are in some pair; a filter of
fixed size over their ids keeps other sets out of that shuffle. Later looks compare
few of them: a filter over the names in their pairs keeps the others out. Where a filter
is too small for its ids it lets more sets through, and the join still drops them.

Defined cases: a text with fewer words than ``n`` is one n-gram of all its words;
texts without words have empty sets and link with nothing; null ids link with
nothing and get a null component; ids are the vertices, so rows that repeat an id
are one vertex. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankmill.llm import wordhash as wh
from rankmill.llm.components import components, written
from rankmill.session import checkpoint_dir

ORDERS = 3
SKETCH_BITS = 21
SKETCH_BLOCK = 1 << 16
PARITY_BITS = 512
WIDE = 16
LOOKS = 2
BLOCK = 512
SLICE_BYTES = 1 << 20  # texts hashed at a time: bounds the memory of a task
FILTER_BITS = 24

_U = np.uint64
_SALTS = [_U(0x243F6A8885A308D3), _U(0x13198A2E03707344), _U(0xA4093822299F31D0), _U(0x082EFA98EC4E6C89)]
_PARITY_SALT, _SIGN_SALT, _SKETCH_SALT, _WIDE_SALT = _U(0x452821E638D01377), _U(0xBE5466CF34E90C6C), _U(0xC0AC29B7C97C50DD), _U(0x3F84D5B5B5470917)
_WORDS = PARITY_BITS // 64
_P = [f"p{i}" for i in range(_WORDS)]
_P_TYPE = ", ".join(f"{p} long" for p in _P)


def document_sets(part: pa.RecordBatch, n: int) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of every text of a slice."""
    w = wh.words(part.column("text"), lower=True)
    h = wh.word_hashes(w)
    g, counts, alone = wh.ngram_hashes(h, n), w.counts, wh.row_hashes(h, w)
    out = []
    for r, size in enumerate(counts.tolist()):
        at = w.first[r]
        out.append(np.unique(g[at : at + size - n + 1]) if size >= n else alone[r : r + 1] if size else alone[:0])
    return out


def needed(size: int, percent: int) -> int:
    """ceil(percent * size / 100)."""
    return -(-percent * size // 100)


def prefix_size(size: int, percent: int) -> int:
    return size - needed(size, percent) + 1


def prefix(tokens: np.ndarray, order: int, frequency: np.ndarray, size: int) -> np.ndarray:
    """The first ``size`` tokens under one order, as 64-bit names (a bijection per order)."""
    names = wh.mix(tokens ^ _SALTS[order])
    if size >= len(names):
        return names
    rank = (frequency[_cell(tokens)].astype(np.uint64) << _U(58)) | (names >> _U(6))
    return names[np.argpartition(rank, size - 1)[:size]] if len(np.unique(rank)) == len(rank) else names[np.lexsort((names, rank))[:size]]


def prefix_filters(tokens: np.ndarray, frequency: np.ndarray, percent: int) -> bytes:
    """What the pair filter needs of a set: longer prefixes under the other orders, as 32-bit marks.

    Prefixes with l - 1 more tokens share l tokens or more in every link. The
    blob holds l, the prefix size, and per order the number of distinct marks
    and the marks.
    """
    p = prefix_size(len(tokens), percent)
    share = max(1, p // 2)
    parts = [np.array([share, min(p - 1 + share, len(tokens))], np.uint64)]
    for order in range(1, ORDERS):
        marks = np.unique(prefix(tokens, order, frequency, p - 1 + share) >> _U(32))
        parts += [np.array([len(marks)], np.uint64), marks]
    return np.concatenate(parts).astype("<u4").tobytes()


def pass_filters(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two blobs (as 32-bit integers) share enough marks under every other order."""
    need = int(min(a[0], b[0]))
    at, bt = 2, 2
    for _ in range(1, ORDERS):
        na, nb = int(a[at]), int(b[bt])
        common = len(np.intersect1d(a[at + 1 : at + 1 + na], b[bt + 1 : bt + 1 + nb], assume_unique=True))
        # tokens that fell on one mark may be shared without being seen
        if common < need - (int(a[1]) - na) - (int(b[1]) - nb):
            return False
        at, bt = at + 1 + na, bt + 1 + nb
    return True


def _cell(tokens: np.ndarray) -> np.ndarray:
    return (wh.mix(tokens ^ _SKETCH_SALT) >> _U(64 - SKETCH_BITS)).astype(np.int64)


def _signature(tokens: np.ndarray) -> tuple[int, int]:
    a = wh.mix(np.array([wh.mix(tokens).sum(dtype=np.uint64)]) ^ _U(len(tokens)))
    b = wh.mix(np.array([wh.mix(tokens ^ _SIGN_SALT).sum(dtype=np.uint64)]) ^ _U(len(tokens)))
    return int(wh.signed(a)[0]), int(wh.signed(b)[0])


def _parity(tokens: np.ndarray) -> np.ndarray:
    bits = np.bincount((wh.mix(tokens ^ _PARITY_SALT) >> _U(55)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def wide_parity(tokens: np.ndarray, percent: int) -> bytes | None:
    """A parity bitmap of ``WIDE`` bits and more for every token by which a link of this size may
    differ, so that it still tells large sets apart; null where the short bitmap is as wide."""
    n = len(tokens)
    bits = 1 << (WIDE * 2 * (n - -(-percent * 2 * n // (100 + percent)))).bit_length()
    if bits <= PARITY_BITS:
        return None
    at = wh.mix(tokens ^ _WIDE_SALT) & _U(bits - 1)
    return np.packbits((np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def token_frequency(docs: DataFrame, n: int) -> np.ndarray:
    """Frequency class (bits of the count) of every sketch cell, over all documents; fixed size 2^SKETCH_BITS bytes."""

    def count(batches):
        cells = np.zeros(1 << SKETCH_BITS, np.int32)
        for batch in batches:
            for part in wh.slices(batch, limit=SLICE_BYTES):
                w = wh.words(part.column("text"), lower=True)
                g = wh.ngram_hashes(wh.word_hashes(w), n)
                np.add.at(cells, _cell(g[wh.whole(w.row, n)]), 1)  # in place: a slice has far fewer tokens than the sketch cells
        blocks = cells.astype("<i4", copy=False).reshape(-1, SKETCH_BLOCK)
        some = [i for i in range(len(blocks)) if blocks[i].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([blocks[i].tobytes() for i in some], pa.binary())], ["block", "cells"])

    def add(table: pa.Table) -> pa.Table:
        total = np.zeros(SKETCH_BLOCK, np.int64)
        for c in table.column("cells"):
            total += np.frombuffer(c.as_buffer(), "<i4")
        bits = np.frexp(total.astype(float))[1].astype(np.uint8)
        return pa.table({"block": table.column("block").slice(0, 1), "cells": pa.array([bits.tobytes()], pa.binary())})

    rows = docs.mapInArrow(count, "block int, cells binary").groupBy("block").applyInArrow(add, "block int, cells binary").collect()
    out = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCK * SKETCH_BLOCK, np.uint8).reshape(-1, SKETCH_BLOCK)
    for r in rows:
        out[r["block"]] = np.frombuffer(r["cells"], np.uint8)
    return out.ravel()


def _nodes(n: int, percent: int):
    def run(batches):
        for batch in batches:
            for part in wh.slices(batch, limit=SLICE_BYTES):
                sets = document_sets(part, n)
                signs = [_signature(s) if len(s) else (None, None) for s in sets]
                parity = np.array([_parity(s) for s in sets]).reshape(-1, _WORDS)
                cols = [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([s[0] for s in signs], pa.int64()), pa.array([s[1] for s in signs], pa.int64())]
                wide = pa.array([wide_parity(s, percent) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*cols, *(pa.array(parity[:, i]) for i in range(_WORDS)), wide], ["doc_id", "n_shingles", "s1", "s2", *_P, "wide"])

    return run


def _prefix_rows(n: int, percent: int, shared):
    def run(batches):
        frequency = shared.value
        for batch in batches:
            for part in wh.slices(batch, limit=SLICE_BYTES):
                seen, tokens, sizes, first, second = set(), [], [], [], []
                for s in document_sets(part, n):
                    if not len(s) or (sign := _signature(s)) in seen:
                        continue
                    seen.add(sign)
                    p = wh.signed(prefix(s, 0, frequency, prefix_size(len(s), percent)))
                    tokens.append(p)
                    sizes.append(np.full(len(p), len(s), np.int32))
                    first.append(np.full(len(p), sign[0]))
                    second.append(np.full(len(p), sign[1]))
                if tokens:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (tokens, sizes, first, second)], ["token", "size", "s1", "s2"])

    return run


def _shared_tokens(percent: int, block: int):
    """Distinct (token, node) rows whose token another node has that could be linked by its size, numbered within the token."""

    def run(batches):
        for c in wh.whole_groups(batches, ["token"]):  # by size within the token
            c = {k: v[wh.group_starts(c["token"], c["s1"], c["s2"])] for k, v in c.items()}
            size = c["size"].astype(np.int64)
            # of the sizes in order, the nearest one is a neighbour
            near = (c["token"][1:] == c["token"][:-1]) & (100 * size[:-1] >= percent * size[1:])
            keep = np.append(near, False) | np.append(False, near)
            token, s1, s2 = c["token"][keep], c["s1"][keep], c["s2"][keep]
            if not len(token):
                continue
            begin = np.flatnonzero(wh.group_starts(token))
            rows = np.diff(np.append(begin, len(token)))
            at = np.arange(len(token)) - np.repeat(begin, rows)
            blocks = np.repeat((rows - 1) // block + 1, rows)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (token, at // block, blocks, s1, s2)], ["token", "block", "blocks", "s1", "s2"])

    return run


class _WideParity:
    """Bits in which wide bitmaps of a stream's rows differ; the longer of two is folded to the shorter."""

    def __init__(self, blobs: np.ndarray):
        size = np.array([len(b) if b is not None else 0 for b in blobs])
        self.size, self.tables, self.place = size, {}, {}
        for m in np.unique(size[size > 0]).tolist():
            rows = np.flatnonzero((size == m) | (size == 2 * m))  # linked sets are nearly of one size
            table = np.zeros((len(rows), m), np.uint8)
            for k, r in enumerate(rows.tolist()):
                b = np.frombuffer(blobs[r], np.uint8)
                table[k] = b if len(b) == m else b[:m] ^ b[m:]
            self.place[m] = np.full(len(size), -1)
            self.place[m][rows] = np.arange(len(rows))
            self.tables[m] = table.view(np.uint64)

    def differ(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """A lower bound of the tokens in which the sets of rows i and j differ (0 without a bitmap)."""
        out = np.zeros(len(i), np.int64)
        least, most = np.minimum(self.size[i], self.size[j]), np.maximum(self.size[i], self.size[j])
        for m in np.unique(least[(least > 0) & (most <= 2 * least)]).tolist():
            at = np.flatnonzero((least == m) & (most <= 2 * m))
            for lo in range(0, len(at), 4096):
                k = at[lo : lo + 4096]
                out[k] = np.bitwise_count(self.tables[m][self.place[m][i[k]]] ^ self.tables[m][self.place[m][j[k]]]).sum(1)
        return out


def _passing(c: dict[str, np.ndarray], percent: int, labels: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group of every row, first rows, second rows) of the pairs that pass length and parity filters.

    Where both rows' least shared tokens are equal, only that token's group
    reports the pair. With ``labels`` pairs of one component are left out.
    """
    new = wh.group_starts(c["token"], c["cell"])
    group = np.cumsum(new) - 1
    wide = _WideParity(c["wide"]) if "wide" in c else None
    bits = np.stack([c[p] for p in _P], 1).view(np.uint64)
    size, block = c["n_shingles"], c["block"]
    cross = c["cell"] >= 0  # two different blocks; else one block
    left, right = [], []
    live = np.arange(len(group))
    for lag in range(1, len(group)):
        live = live[live + lag < len(group)]
        live = live[group[live] == group[live + lag]]
        if not len(live):
            break
        i, j = live, live + lag
        ok = ~cross[i] | (block[i] != block[j])
        ok &= (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j])) & ((c["low"][i] != c["low"][j]) | (c["low"][i] == c["token"][i]))
        if labels:
            ok &= c["label"][i] != c["label"][j]
        i, j = i[ok], j[ok]
        both = size[i] + size[j]
        allowed = both - 2 * (-(-percent * both // (100 + percent)))
        ok = np.bitwise_count(bits[i] ^ bits[j]).sum(1) <= allowed
        if wide is not None:
            ok[ok] = wide.differ(i[ok], j[ok]) <= allowed[ok]
        left.append(i[ok])
        right.append(j[ok])
    none = np.zeros(0, np.int64)
    return group, np.concatenate(left) if left else none, np.concatenate(right) if right else none


_NODE_ROW = ["token", "cell", "block", "low", "n_shingles", "s1", "s2", *_P]
_ROW_TYPE = f"token long, cell long, block long, low long, n_shingles long, s1 long, s2 long, {_P_TYPE}"
_PAIR_TYPE = f"a1 long, a2 long, b1 long, b2 long, later boolean, {_ROW_TYPE}, wide binary"


def _pair_batch(c: dict, i: np.ndarray, j: np.ndarray, later_rows: np.ndarray) -> pa.RecordBatch:
    swap = (c["s1"][i] > c["s1"][j]) | ((c["s1"][i] == c["s1"][j]) & (c["s2"][i] > c["s2"][j]))
    a, b = np.where(swap, j, i), np.where(swap, i, j)
    pairs = [pa.array(np.concatenate([x, np.zeros(len(later_rows), np.int64)])) for x in (c["s1"][a], c["s2"][a], c["s1"][b], c["s2"][b])]
    later = pa.array(np.concatenate([np.zeros(len(a), bool), np.ones(len(later_rows), bool)]))
    kinds = {k: pa.int64() for k in _NODE_ROW} | {"wide": pa.binary()}
    rows = [pa.concat_arrays([pa.nulls(len(a), t), pa.array(c[k][later_rows], t)]) for k, t in kinds.items()]
    return pa.RecordBatch.from_arrays([*pairs, later, *rows], ["a1", "a2", "b1", "b2", "later", *kinds])


def _passing_rows(percent: int):
    """The rows that are in some pair that passes."""

    def run(batches):
        for c in wh.whole_groups(batches, ["token", "cell"]):
            _, i, j = _passing(c, percent, False)
            some = np.union1d(i, j)
            yield pa.RecordBatch.from_arrays([pa.array(c[k][some]) for k in _NODE_ROW], _NODE_ROW)

    return run


def _first_pairs(percent: int):
    """A passing pair or two for every node that has one, and the rows of groups with more pairs, for the second look."""

    def run(batches):
        for c in wh.whole_groups(batches, ["token", "cell"]):
            group, i, j = _passing(c, percent, False)
            _, back = np.unique(j, return_index=True)
            _, ahead = np.unique(i, return_index=True)
            some = np.union1d(back, ahead)
            more = np.bincount(group[i], minlength=group[-1] + 1) > np.bincount(group[i[some]], minlength=group[-1] + 1)
            yield _pair_batch(c, i[some], j[some], np.flatnonzero(more[group]))

    return run


def _other_pairs(percent: int, every: bool):
    """Passing pairs of different components: one per pair of components and group, or all of them."""

    def run(batches):
        for c in wh.whole_groups(batches, ["token", "cell"]):
            group, i, j = _passing(c, percent, True)
            if not every and len(i):
                x, y = c["label"][i], c["label"][j]
                _, first = np.unique(np.stack([group[i], np.minimum(x, y), np.maximum(x, y)]), axis=1, return_index=True)
                i, j = i[first], j[first]
            yield _pair_batch(c, i, j, np.zeros(0, np.int64)).select(["a1", "a2", "b1", "b2"])

    return run


def _id_bits(ids: np.ndarray) -> list[np.ndarray]:
    h = wh.mix(ids.astype(np.uint64))
    return [(h >> _U(64 - FILTER_BITS)).astype(np.int64), (h & _U((1 << FILTER_BITS) - 1)).astype(np.int64)]


def id_filter(ids: DataFrame) -> np.ndarray:
    """2^FILTER_BITS bits (packed) of which those of every id are set."""

    def mark(batches):
        bits = np.zeros(1 << FILTER_BITS, bool)
        for b in batches:
            for at in _id_bits(b.column(0).to_numpy(zero_copy_only=False)):
                bits[at] = True
        blocks = np.packbits(bits).reshape(-1, SKETCH_BLOCK)
        some = [i for i in range(len(blocks)) if blocks[i].any()]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([blocks[i].tobytes() for i in some], pa.binary())], ["block", "cells"])

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(SKETCH_BLOCK, np.uint8)
        for c in table.column("cells"):
            total |= np.frombuffer(c.as_buffer(), np.uint8)
        return pa.table({"block": table.column("block").slice(0, 1), "cells": pa.array([total.tobytes()], pa.binary())})

    out = np.zeros(1 << FILTER_BITS >> 3, np.uint8).reshape(-1, SKETCH_BLOCK)
    for r in ids.mapInArrow(mark, "block int, cells binary").groupBy("block").applyInArrow(merge, "block int, cells binary").collect():
        out[r["block"]] = np.frombuffer(r["cells"], np.uint8)
    return out.ravel()


def _in_filter(ids: pa.Array, bits: np.ndarray) -> pa.Array:
    keep = np.ones(len(ids), bool)
    for at in _id_bits(ids.to_numpy(zero_copy_only=False)):
        keep &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
    return pa.array(keep)


def _pass_filter(shared, column: str):
    def run(batches):
        for batch in batches:
            yield batch.filter(_in_filter(batch.column(column), shared.value))

    return run


def _sets(n: int, percent: int, shared, members):
    """Sets of the documents whose ids pass the filter ``members``; a function of its own before
    this one would take a second Python worker of every running task."""

    def run(batches):
        for batch in batches:
            for part in wh.slices(batch.filter(_in_filter(batch.column("doc_id"), members.value)), limit=SLICE_BYTES):
                found = {}  # of rows that repeat an id and a text one is enough
                for node, s in zip(part.column("doc_id").to_pylist(), document_sets(part, n), strict=True):
                    if len(s):
                        found.setdefault((node, *_signature(s)), s)
                keys = [pa.array([k[i] for k in found], pa.int64()) for i in range(3)]
                filters = pa.array([prefix_filters(s, shared.value, percent) for s in found.values()], pa.binary())
                yield pa.RecordBatch.from_arrays([*keys, filters, pa.array([s.tobytes() for s in found.values()], pa.binary())], ["node", "s1", "s2", "filters", "tokens"])

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * common >= percent * (len(a) + len(b) - common)


def _test_pairs(kind: str, test, names: list[str]):
    def run(batches):
        for batch in batches:
            both = zip(batch.column("x"), batch.column("y"), strict=True)
            ok = pa.array([test(np.frombuffer(x.as_buffer(), kind), np.frombuffer(y.as_buffer(), kind)) for x, y in both], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(ok) for c in names], names)

    return run


def joined_components(label: DataFrame, links: DataFrame) -> DataFrame:
    """``label`` (id, component) after more links (a, b): a graph of the components that they touch is enough."""
    of_a, of_b = (label.select(F.col("id").alias(e), F.col("component").alias(f"of_{e}")).hint("merge") for e in "ab")
    edges = links.join(of_a, "a", "left").join(of_b, "b", "left").select(F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b"))
    moved = components(edges)
    to = moved.select(F.col("id").alias("component"), F.col("component").alias("to")).hint("merge")
    kept = label.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return kept.union(moved.join(label.hint("merge"), "id", "left_anti").select("id", "component"))


def jaccard_components(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text); see the module text."""
    spark = docs.sparkSession
    folder = f"{checkpoint_dir(spark)}/ngram-join-{uuid.uuid4().hex}"
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    named = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL AND text != ''")
    frequency = spark.sparkContext.broadcast(token_frequency(named.select("text"), n))

    every = written(docs.mapInArrow(_nodes(n, percent), f"doc_id long, n_shingles long, s1 long, s2 long, {_P_TYPE}, wide binary"), f"{folder}/documents")
    nodes = every.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("node"), F.first("n_shingles").alias("n_shingles"), *[F.first(p).alias(p) for p in _P])
    nodes = written(nodes, f"{folder}/nodes")  # many joins below read it

    # ids that have several sets are one vertex: their nodes are linked with the id
    lo, hi = F.min(F.struct("s1", "s2")).alias("lo"), F.max(F.struct("s1", "s2")).alias("hi")
    mixed = every.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(lo, hi).filter("NOT (lo <=> hi)").select("doc_id")
    same = every.join(mixed, "doc_id", "left_semi").join(nodes.select("s1", "s2", "node"), ["s1", "s2"]).select(F.col("node").alias("a"), F.col("doc_id").alias("b"))
    same = written(same.filter("a != b").distinct(), f"{folder}/same")

    rows = named.select("text").mapInArrow(_prefix_rows(n, percent, frequency), "token long, size int, s1 long, s2 long")
    rows = rows.repartition("token").sortWithinPartitions("token", "size", "s1", "s2")
    rows = written(rows.mapInArrow(_shared_tokens(percent, BLOCK), "token long, block long, blocks long, s1 long, s2 long"), f"{folder}/shared")
    # tables that grow with the corpus are merged, or the driver would hold a copy of each for a broadcast
    rows = rows.withColumn("low", F.min("token").over(Window.partitionBy("s1", "s2"))).join(nodes.drop("node").hint("merge"), ["s1", "s2"])
    # one row per pair of blocks that the node's block is in; cell -1 - block: the block with itself
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cell = F.when(F.col("other") == F.col("block"), -1 - F.col("block")).otherwise(F.least("block", "other") * F.col("blocks") + F.greatest("block", "other"))
    rows = rows.withColumn("cell", cell.cast("long")).select(*_NODE_ROW)

    def by_group(rows: DataFrame) -> DataFrame:
        return rows.repartition("token", "cell").sortWithinPartitions("token", "cell", "block")

    passing = written(by_group(rows).mapInArrow(_passing_rows(percent), _ROW_TYPE), f"{folder}/passing")
    wide = every.filter("wide IS NOT NULL").groupBy("s1", "s2").agg(F.first("wide").alias("wide")).hint("merge")
    passing = passing.join(wide, ["s1", "s2"], "left").select(*_NODE_ROW, "wide")
    found = written(by_group(passing).mapInArrow(_first_pairs(percent), _PAIR_TYPE), f"{folder}/found")

    ends = ["a1", "a2", "b1", "b2"]
    pairs = written(found.filter("NOT later").select(*ends).distinct(), f"{folder}/pairs")
    ids = nodes.select("s1", "s2", "node").hint("merge")
    active = pairs.select(F.col("a1").alias("s1"), F.col("a2").alias("s2")).union(pairs.select("b1", "b2")).distinct().join(ids, ["s1", "s2"])
    active = written(active, f"{folder}/active")
    members = spark.sparkContext.broadcast(id_filter(active.select("node")))
    # any document with a node's id and signature stands for it
    key = ["node", "s1", "s2"]
    sets = named.mapInArrow(_sets(n, percent, frequency, members), "node long, s1 long, s2 long, filters binary, tokens binary")
    sets = written(sets.join(active.hint("merge"), key).dropDuplicates(key), f"{folder}/sets")

    def tested(some: DataFrame, column: str, kind: str, test, few: bool) -> DataFrame:
        """The pairs whose two values of ``column`` pass ``test``, with their nodes a and b; ``few``: sets that are in no pair stay where they are."""
        table = sets.select("s1", "s2", "node", column)
        if few:
            named_here = spark.sparkContext.broadcast(id_filter(some.select("a1").union(some.select("b1"))))
            table = table.mapInArrow(_pass_filter(named_here, "s1"), table.schema)
        x = table.select(F.col("s1").alias("a1"), F.col("s2").alias("a2"), F.col("node").alias("a"), F.col(column).alias("x")).hint("merge")
        y = table.select(F.col("s1").alias("b1"), F.col("s2").alias("b2"), F.col("node").alias("b"), F.col(column).alias("y")).hint("merge")
        good = some.join(x, ends[:2]).join(y, ends[2:])
        return good.mapInArrow(_test_pairs(kind, test, [*ends, "a", "b"]), "a1 long, a2 long, b1 long, b2 long, a long, b long")

    def verified(some: DataFrame, folder: str, few: bool) -> DataFrame:
        """Links (a, b) by node id: the filters of the other orders first, then the whole sets of what passes."""
        good = written(tested(some, "filters", "<u4", pass_filters, few).select(*ends), f"{folder}-filtered")
        return tested(good, "tokens", "<u8", lambda x, y: linked(x, y, percent), True).select("a", "b")

    # one pair per node first; the others only where the components differ
    turned = pairs.select(F.col("b1").alias("a1"), F.col("b2").alias("a2"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
    chosen = pairs.union(turned).groupBy("a1", "a2").agg(F.min(F.struct("b1", "b2")).alias("b")).select("a1", "a2", "b.b1", "b.b2")
    small, large = F.least(F.struct("a1", "a2"), F.struct(F.col("b1").alias("a1"), F.col("b2").alias("a2"))), F.greatest(F.struct("a1", "a2"), F.struct(F.col("b1").alias("a1"), F.col("b2").alias("a2")))
    chosen = chosen.select(small.alias("p"), large.alias("q")).select("p.a1", "p.a2", F.col("q.a1").alias("b1"), F.col("q.a2").alias("b2")).distinct()
    chosen = written(chosen, f"{folder}/chosen")
    label = components(verified(chosen, f"{folder}/chosen", False).union(same))

    def labelled(name: str) -> DataFrame:
        of_set = ids.join(label.hint("merge"), ids["node"] == label["id"], "left").select("s1", "s2", F.coalesce("component", "node").alias("label"))
        return written(of_set, f"{folder}/{name}").hint("merge")

    of_set = labelled("components")
    la = of_set.select(F.col("s1").alias("a1"), F.col("s2").alias("a2"), F.col("label").alias("la")).hint("merge")
    lb = of_set.select(F.col("s1").alias("b1"), F.col("s2").alias("b2"), F.col("label").alias("lb")).hint("merge")
    rest = pairs.join(chosen.hint("merge"), ends, "left_anti").join(la, ends[:2]).join(lb, ends[2:]).filter("la != lb").select(*ends)
    # the groups with more pairs: a pair of nodes that could join two components each, as long as
    # components join; then whatever passes between those that are left
    later, tried = found.filter("later").select(*_NODE_ROW, "wide"), chosen
    for look in range(LOOKS):
        again = by_group(later.join(of_set, ["s1", "s2"]).select(*_NODE_ROW, "wide", "label"))
        more = again.mapInArrow(_other_pairs(percent, look == LOOKS - 1), "a1 long, a2 long, b1 long, b2 long")
        more = (more.union(rest) if look == 0 else more).distinct().join(tried.hint("merge"), ends, "left_anti")
        more = written(more, f"{folder}/more-{look}")
        if not more.isEmpty():
            tried = tried.union(more)
            second = written(verified(more, f"{folder}/more-{look}", True), f"{folder}/links-{look}")
            if not second.isEmpty():
                label = written(joined_components(label, second), f"{folder}/labels-{look}")
                of_set = labelled(f"components-{look}")

    placed = every.join(ids, ["s1", "s2"], "left").withColumn("node", F.coalesce("node", "doc_id"))
    placed = placed.join(label.withColumnRenamed("id", "node").hint("merge"), "node", "left")
    return placed.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node")).alias("component_id"))


def op1_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Contract query: 3-word shingles, similarity of 0.9 or more."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), n=3, percent=90)


#: DuckDB twin of the contract query: all pairs that share a shingle, then reachability.
ORACLE_SQL = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT rid, doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT rid, doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM p),
n AS (SELECT rid, doc_id, count(*) AS n FROM s GROUP BY rid, doc_id),
c AS (SELECT a.rid AS x, b.rid AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.rid < b.rid GROUP BY 1, 2),
l AS (SELECT nx.doc_id AS a, ny.doc_id AS b FROM c JOIN n nx ON nx.rid = x JOIN n ny ON ny.rid = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(id, m) AS (SELECT DISTINCT doc_id, doc_id FROM d UNION SELECT r.id, e.b FROM r JOIN e ON r.m = e.a),
k AS (SELECT id, min(m) AS component_id FROM r GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id FROM d LEFT JOIN n USING (rid) LEFT JOIN k ON k.id = d.doc_id
"""
