"""Operator 2 — BPE encoding and decoding by tree concatenation.

A text of up to ``piece_chars`` characters is encoded where it is read. A longer
one is halved again and again; the pieces are rows of their own, dealt over the
tasks and encoded in parallel. Their token sequences are then joined as a tree:
at each join a window of text around the cut is encoded, and it grows until its
tokens agree with the left side's before the cut and with the right side's after
it. The result is the left side's tokens up to the agreement, the window's
tokens, and the right side's after it.

Why that is exact: two sides and the window agree on ``AGREE`` neighbouring
tokens (ids and places) away from the window's own ends. So every neighbouring
pair of the result is a neighbouring pair of a real encoding, which is what
makes a BPE sequence the encoding of its text, and word splits restart at each
split alike. A window that never agrees grows to the whole text of both sides.

Pieces are cut anywhere, also inside a word without any split. Words between
ASCII white space never share a token in this vocabulary, so only the runs at a
piece's edges (all of it, if it has no white space) need joining; within the
rest each distinct word is encoded once (``encode_words``), and a memo of bounded
size keeps the ids and the decoded form of recent words.

Tokenizer files are read on the driver from a path (a parameter) and broadcast:
their size is that of a vocabulary, whatever the input. Defined cases: null and
empty texts have no tokens; special token strings in a text become those tokens,
as the library does by default; repeated rows and null ids are kept row by row;
other columns stay in ``row``. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
import struct
import sys
import types
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.llm import wordhash as wh

TOKENIZER = "word_bpe_49k.json"
PIECE_CHARS = 1 << 15
MEMO_WORDS = 400_000
SLICE_BYTES = 1 << 20  # texts encoded at a time: bounds the memory of a task
FIRST_WINDOW = 64  # characters on each side of a cut; longer than any special token
AGREE = 2

_OUT = "ids binary, decoded string"


def tokenizer_json(path: str | None = None) -> str:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read()


def load(json_text: str):
    """Tokenizer without truncation and padding; one thread, as Spark gives each task one core."""
    import os

    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_str(json_text)
    t.no_truncation()
    t.no_padding()
    return t


# ASCII marks from a letter or digit to the word's end are a token split of their own.
# The pattern begins with the marks, as a search for one set of bytes is fast; what stands before is looked at from there.
_MARKS = re.compile(rb"[!-/:-@\[-`{-~](?:(?<=[a-z0-9].)|(?<=\xc3[\x9f-\xb6\xb8-\xbf].))[!-/:-@\[-`{-~]*(?=[\x09-\x0D\x20]|$)")


def separate_words(text: str) -> list[bytes]:
    """Parts of a text that never share a token: runs without ASCII white space, closing marks apart.

    The tokenizer folds case, so ASCII letters are folded first. Texts with
    ``<|``, which may begin a special token, are only cut at white space.
    """
    data = text.encode()
    if b"<|" in data:
        return data.split()
    return _MARKS.sub(rb" \g<0>", data.lower()).split()


# Lower-case ASCII and Latin-1 letters: such a word is one split, and normalisation leaves it as it is.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")


def byte_symbols() -> list[str]:
    """The byte-level alphabet: printable Latin-1 bytes stand for themselves, the others for 256, 257, ..."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(256 + rest.index(b)) for b in range(256)]


class Memo:
    """Ids and decoded form of distinct words, in two generations of about ``MEMO_WORDS`` / 2.

    When the younger one (``known``) is full it becomes the older one, and a word of the
    older that is seen again comes back. So words in use stay, and rare ones go.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.known, self.old = tokenizer, {}, {}
        self.model, self.symbols = tokenizer.model, byte_symbols()

    def plain(self, word: bytes) -> tuple[bytes, str]:
        """A word that is one split, straight to the model's merges."""
        tokens = self.model.tokenize(word.decode() if word.isascii() else "".join([self.symbols[b] for b in word]))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens]), " ".join([t.value for t in tokens])

    def learn(self, texts: list[list[bytes]]) -> None:
        here = set(chain.from_iterable(texts))
        new = here.difference(self.known)
        if len(self.known) + len(new) > MEMO_WORDS // 2:
            self.old, self.known, new = self.known, {}, here
        self.known.update((w, self.old[w]) for w in new if w in self.old)
        new = new.difference(self.known)
        one = [w for w in new if _PLAIN.fullmatch(w.decode())]
        self.known.update((w, self.plain(w)) for w in one)
        new = list(new.difference(one))
        for lo in range(0, len(new), 10_000):
            some = new[lo : lo + 10_000]
            ids = [e.ids for e in self.tokenizer.encode_batch_fast([w.decode() for w in some], add_special_tokens=False)]
            words = self.tokenizer.decode_batch(ids, skip_special_tokens=False)
            self.known.update((w, (np.array(i, "<u4").tobytes(), d)) for w, i, d in zip(some, ids, words, strict=True))

    def encode(self, words: list[bytes]) -> tuple[bytes, str]:
        if not words:
            return b"", ""
        ids, decoded = zip(*[self.known[w] for w in words], strict=True)
        return b"".join(ids), " ".join(filter(None, decoded))


def worker_memo(json_text: str) -> Memo:
    """One memo for the life of a Python worker process, whatever tasks it runs."""
    shelf = sys.modules.setdefault("rankmill_bpe_memo", types.ModuleType("rankmill_bpe_memo")).__dict__
    key = hashlib.md5(json_text.encode()).hexdigest()
    if key not in shelf:
        shelf[key] = Memo(load(json_text))
    return shelf[key]


def encode_words(texts: list[str | None], memo: Memo) -> list[tuple[bytes, str]]:
    """(ids as little-endian 32-bit integers, decoded text) of every text."""
    split = [separate_words(t) if t else [] for t in texts]
    memo.learn(split)
    return [memo.encode(words) for words in split]


class Side:
    """Tokens of ``text[lo:hi]``: ids and absolute character places."""

    def __init__(self, ids, starts, ends, lo: int, hi: int):
        self.ids, self.starts, self.ends, self.lo, self.hi = ids, starts, ends, lo, hi

    @classmethod
    def of(cls, tokenizer, text: str, lo: int) -> Side:
        e = tokenizer.encode(text, add_special_tokens=False)
        places = np.array(e.offsets, np.int64).reshape(-1, 2) + lo
        return cls(np.array(e.ids, np.int64), places[:, 0], places[:, 1], lo, lo + len(text))

    def token(self, i: int) -> tuple:
        return int(self.ids[i]), int(self.starts[i]), int(self.ends[i])

    def part(self, a: int, b: int) -> tuple:
        return self.ids[a:b], self.starts[a:b], self.ends[a:b]


def _agreement(side: Side, window: Side, first: int, last: int, low: int, high: int) -> tuple[int, int] | None:
    """(place in side, place in window) of ``AGREE`` equal neighbours in window[first:last] within [low, high)."""
    at: dict[tuple, int] = {}
    for i in range(int(np.searchsorted(side.starts, low)), int(np.searchsorted(side.starts, high))):
        at.setdefault(side.token(i), i)
    for j in range(first, last - AGREE + 1):
        i = at.get(window.token(j))
        if i is None or i + AGREE > len(side.ids):
            continue
        if all(side.token(i + d) == window.token(j + d) for d in range(1, AGREE)) and side.starts[i] >= low and side.ends[i + AGREE - 1] <= high:
            return i, j
    return None


def concatenate(tokenizer, text: str, left: Side, right: Side) -> Side:
    """Tokens of the two neighbouring parts together; ``text`` is the whole text."""
    cut, reach = left.hi, FIRST_WINDOW
    while True:
        lo, hi = max(left.lo, cut - reach), min(right.hi, cut + reach)
        if lo > left.lo:  # begin at a token, so that no character is cut
            i = int(np.searchsorted(left.starts, lo, side="right")) - 1
            lo = int(left.starts[i]) if i >= 0 else left.lo
        whole_left, whole_right = lo <= left.lo, hi >= right.hi
        window = Side.of(tokenizer, text[lo:hi], lo)
        a = (0, 0) if whole_left else _agreement(left, window, 1, len(window.ids), lo, cut)
        b = (len(right.ids), len(window.ids)) if whole_right else _agreement(right, window, 0, len(window.ids) - 1, cut, hi)
        if a and b and a[1] <= b[1]:
            parts = [left.part(0, a[0]), window.part(a[1], b[1]), right.part(b[0], len(right.ids))]
            return Side(*(np.concatenate(x) for x in zip(*parts, strict=True)), left.lo, right.hi)
        if whole_left and whole_right:
            return window
        reach *= 2


def concatenate_tree(tokenizer, text: str, sides: list[Side]) -> Side:
    """Join neighbours pair by pair until one side is left."""
    while len(sides) > 1:
        pairs = [sides[i : i + 2] for i in range(0, len(sides), 2)]
        sides = [concatenate(tokenizer, text, *p) if len(p) == 2 else p[0] for p in pairs]
    return sides[0]


def halves(n: int, most: int) -> list[tuple[int, int]]:
    """Cut [0, n) in halves until no part is longer than ``most``."""
    parts = [(0, n)]
    while parts and max(b - a for a, b in parts) > most:
        parts = [p for a, b in parts for p in ((a, (a + b) // 2), ((a + b) // 2, b))]
    return parts


def open_parts(piece: str) -> tuple[int, int]:
    """(end of the first run, start of the last run) of characters that are no ASCII white space; (n, n): one run."""
    blanks = [m for m in (_BLANK.search(piece), _LAST_BLANK.search(piece)) if m]
    return (blanks[0].start(), blanks[1].end()) if blanks else (len(piece), len(piece))


_BLANK = re.compile(r"[\x09-\x0D\x20]")
_LAST_BLANK = re.compile(r"(?s:.*)[\x09-\x0D\x20]")


def encode_piece(tokenizer, memo: Memo, piece: str, lo: int) -> list[dict]:
    """A piece's parts in order: runs that reach its edges, with token places (open), and the words between."""
    head, tail = open_parts(piece)
    parts = []

    def run(a: int, b: int) -> None:
        if a < b:
            side = Side.of(tokenizer, piece[a:b], lo + a)
            parts.append({"open": True, "lo": lo + a, "text": piece[a:b], "tokens": np.stack([side.ids, side.starts, side.ends]).astype("<i8").tobytes(), "decoded": ""})

    run(0, head)
    if head < len(piece):
        ((ids, decoded),) = encode_words([piece[head:tail]], memo)
        parts.append({"open": False, "lo": lo + head, "text": "", "tokens": ids, "decoded": decoded})
        run(tail, len(piece))
    return parts


def join_parts(tokenizer, parts: list[dict]) -> tuple[bytes, str]:
    """Ids and decoded text of a text's parts; neighbouring open runs are joined as a tree."""
    ids, decoded, runs = [], [], []

    def close() -> None:
        if runs:
            lo = runs[0]["lo"]
            sides = [Side(*np.frombuffer(r["tokens"], "<i8").reshape(3, -1), r["lo"] - lo, r["lo"] - lo + len(r["text"])) for r in runs]
            for s in sides:
                s.starts, s.ends = s.starts - lo, s.ends - lo
            found = concatenate_tree(tokenizer, "".join(r["text"] for r in runs), sides).ids
            ids.append(found.astype("<u4").tobytes())
            decoded.append(tokenizer.decode(found.tolist(), skip_special_tokens=False))
            runs.clear()

    for p in parts:
        if p["open"]:
            runs.append(p)
        else:
            close()
            ids.append(p["tokens"])
            decoded.append(p["decoded"])
    close()
    return b"".join(ids), " ".join(filter(None, decoded))


def encode_decode(docs: DataFrame, tokenizer_path: str | None = None, piece_chars: int = PIECE_CHARS) -> DataFrame:
    """One row per document: ``row`` (all its columns), ``ids`` (little-endian 32-bit integers) and ``decoded``."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer_path))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("__text"))

    def short(batches):
        memo = worker_memo(shared.value)
        for batch in batches:
            for part in wh.slices(batch, "__text", SLICE_BYTES):
                got = encode_words(part.column("__text").to_pylist(), memo)
                yield pa.RecordBatch.from_arrays([part.column("row"), pa.array([g[0] for g in got], pa.binary()), pa.array([g[1] for g in got], pa.string())], ["row", "ids", "decoded"])

    def cut(batches):
        for batch in batches:
            for i, text in enumerate(batch.column("__text").to_pylist()):
                for no, (a, b) in enumerate(halves(len(text), piece_chars)):
                    row = batch.column("row").slice(i, 1) if no == 0 else pa.nulls(1, batch.column("row").type)
                    yield pa.RecordBatch.from_arrays([row, batch.column("__id").slice(i, 1), pa.array([no], pa.int32()), pa.array([a], pa.int64()), pa.array([text[a:b]], pa.string())], ["row", "__id", "no", "lo", "piece"])

    def encode(batches):
        memo = worker_memo(shared.value)
        tokenizer = memo.tokenizer
        for batch in batches:
            for i in range(batch.num_rows):
                parts = encode_piece(tokenizer, memo, batch.column("piece")[i].as_py(), batch.column("lo")[i].as_py())
                cols = [pa.array([[p[k] for p in parts]], pa.list_(t)) for k, t in (("open", pa.bool_()), ("lo", pa.int64()), ("text", pa.string()), ("tokens", pa.binary()), ("decoded", pa.string()))]
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(i, 1) for c in ("row", "__id", "no")), *cols], ["row", "__id", "no", "open", "lo", "text", "tokens", "decoded"])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("no")
        pieces = table.select(["open", "lo", "text", "tokens", "decoded"]).to_pylist()
        parts = [dict(zip(p, values, strict=True)) for p in pieces for values in zip(*p.values(), strict=True)]
        ids, decoded = join_parts(worker_memo(shared.value).tokenizer, parts)
        return pa.table({"row": table.column("row").slice(0, 1), "ids": pa.array([ids], pa.binary()), "decoded": pa.array([decoded], pa.string())})

    # a long text's row travels with its first piece; __id only tells texts apart
    field = rows.schema["row"]
    long = rows.filter(F.length("__text") > piece_chars).withColumn("__id", F.monotonically_increasing_id())
    pieces = long.mapInArrow(cut, wh.schema_with(field, "__id long, no int, lo long, piece string"))
    part_type = "__id long, no int, open array<boolean>, lo array<bigint>, text array<string>, tokens array<binary>, decoded array<string>"
    encoded = pieces.repartition("__id", "no").mapInArrow(encode, wh.schema_with(field, part_type))
    joined = encoded.groupBy("__id").applyInArrow(join, wh.schema_with(field, _OUT))
    short_rows = rows.filter(F.length("__text") <= piece_chars).mapInArrow(short, wh.schema_with(field, _OUT))
    return short_rows.unionByName(joined)


def op2_bpe(spark, sf_dir: str) -> DataFrame:
    """Contract query: doc_id, n_tokens, ids_sha256, decoded_sha256 for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    coded = encode_decode(docs).withColumn("row", F.struct("row.doc_id"))
    return coded.select(
        "row.doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
