"""Operator 3 — language ID by a linear-chain conditional random field over words.

Every word has hashed features: itself (lexicon), its first and last bytes up to
four (affixes) and its byte 2- and 3-grams with word edges. The weights of the
features and of the transitions between neighbouring words' languages are
learned together from code-switched sequences: labelled texts of the sample are
cut into runs of a few words, and runs of different languages are strung
together. Forward-backward gives each word its language probabilities; a
document's language is the one with the greatest expected number of words, its
score that share.

Training takes about ``MAX_TRAIN_ROWS`` labelled texts to the driver, by a hash of
the text: equal texts are one, every language has the same share of them, and one
with fewer gives all it has. Rows are taken whole. Where a language's texts are so long
that its share of rows would exceed its share of ``TRAIN_CHARS`` characters on average, it
has fewer rows, but about ``MIN_LANG_ROWS`` at least.
Prediction is one pass over all whole texts without a shuffle; within a slice of
texts the recursions run over all its documents at once, one word each step.

Defined cases: a null text or one without a letter gets ``und`` and score 0;
rows with a null language do not train; where no row can train, every text gets
``und``. Repeated rows are labelled alike. Other columns stay in ``row``. An
empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.llm import wordhash as wh

MAX_TRAIN_ROWS = 2_000
MIN_LANG_ROWS = 20
TRAIN_CHARS = 32_000_000
N_SEQUENCES = 2_500
SEQUENCE_WORDS = 60
MAX_RUN = 20
FEATURE_BITS = 17
STEPS = 30
SLICE = 6 << 20
UNDETERMINED = "und"

# ASCII bytes that are no letter part words; bytes of other characters belong to words.
_APART = np.array([not (chr(b).isalpha() or b >= 128) for b in range(256)])


def letter_words(texts: pa.Array) -> wh.Words:
    """Lower-case words of letters (A-Z and the Latin-1 capitals are folded)."""
    w = wh.words(texts, lower=True, separators=_APART)
    if len(w.data) > 1:
        data = w.data.copy()
        fold = np.zeros(len(data), bool)
        fold[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        data[fold] += 0x20
        w.data = data
    return w


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, feature) of the words given by byte spans."""
    size = ends - starts
    mask = np.uint64((1 << FEATURE_BITS) - 1)
    owner, feats = [], []

    def add(o, h, kind):
        owner.append(o)
        feats.append((wh.mix(h ^ np.uint64(kind * 0x9E3779B1)) & mask).astype(np.int64))

    n = len(starts)
    every = np.arange(n)
    add(every, wh.span_hashes(data, starts, ends), 1)
    for k in (1, 2, 3, 4):
        some = every[size >= k]
        add(some, wh.span_hashes(data, starts[some], starts[some] + k), 10 + k)
        add(some, wh.span_hashes(data, ends[some] - k, ends[some]), 20 + k)
    # all words end to end, an edge byte before and after each
    room = size + 2
    first = np.cumsum(room) - room
    line = np.full(int(room.sum()), 32, np.uint64)
    who = np.repeat(every, room)
    inner = np.arange(len(line)) - first[who] - 1
    body = (inner >= 0) & (inner < size[who])
    line[body] = data[(starts[who] + inner)[body]]
    for k in (2, 3):
        same = who[: len(who) - k + 1] == who[k - 1 :] if len(who) >= k else np.zeros(0, bool)
        h = np.zeros(len(same), np.uint64)
        for j in range(k):
            h = h * np.uint64(257) + line[j : j + len(same)]
        add(who[: len(same)][same], h[same], 30 + k)
    return np.concatenate(owner), np.concatenate(feats)


class Field:
    """Learned field: languages, feature weights (features x languages), transitions, start."""

    def __init__(self, langs: list[str], weights: np.ndarray, moves: np.ndarray):
        self.langs, self.weights, self.moves = langs, weights, moves

    def emissions(self, w: wh.Words) -> np.ndarray:
        """exp(score) of every word and language, scaled so that the greatest of a word is 1."""
        _, at, which = np.unique(wh.word_hashes(w), return_index=True, return_inverse=True)
        owner, feats = features(w.data, w.starts[at], w.ends[at])
        scores = np.stack([np.bincount(owner, self.weights[feats, k], len(at)) for k in range(len(self.langs))], 1)
        scores -= scores.max(1, keepdims=True)
        return np.exp(np.maximum(scores, -40)).astype(np.float32)[which]

    def shares(self, w: wh.Words) -> np.ndarray:
        """Expected number of words by document and language."""
        counts = w.counts
        out = np.zeros((len(counts), len(self.langs)))
        rank = np.argsort(-counts, kind="stable")
        size = counts[rank]
        if len(size) == 0 or size[0] == 0:
            return out
        active = len(size) - np.searchsorted(size[::-1], np.arange(size[0]), side="right")
        begin = np.concatenate([[0], np.cumsum(active)])
        # words laid out by step, then by rank of their document
        place = np.empty(len(counts), np.int64)
        place[rank] = np.arange(len(counts))
        order = np.empty(len(w.row), np.int64)
        order[begin[w.position()] + place[w.row]] = np.arange(len(w.row))
        e = self.emissions(w)[order]
        move = np.exp(self.moves).astype(np.float32)
        forward = np.empty_like(e)
        a = e[: active[0]] / e[: active[0]].sum(1, keepdims=True)
        forward[: active[0]] = a
        for t in range(1, len(active)):
            a = (a[: active[t]] @ move) * e[begin[t] : begin[t + 1]]
            a /= a.sum(1, keepdims=True)
            forward[begin[t] : begin[t + 1]] = a
        total = np.zeros((len(size), len(self.langs)))
        b = np.ones((active[-1], len(self.langs)), np.float32)
        for t in range(len(active) - 1, -1, -1):
            p = forward[begin[t] : begin[t + 1]] * b
            total[: active[t]] += p / p.sum(1, keepdims=True)
            if t:
                b = (e[begin[t] : begin[t + 1]] * b) @ move.T
                b /= b.sum(1, keepdims=True)
                if active[t - 1] > active[t]:
                    b = np.vstack([b, np.ones((active[t - 1] - active[t], b.shape[1]), np.float32)])
        out[rank] = total
        return out


def switched_sequences(texts: list[str], langs: np.ndarray, n_langs: int, seed: int = 7):
    """Words and languages of ``N_SEQUENCES`` strings of runs cut from the texts, languages drawn evenly."""
    rng = np.random.default_rng(seed)
    w = letter_words(pa.array(texts, pa.string()))
    by = [np.flatnonzero((langs == k) & (w.counts > 0)) for k in range(n_langs)]
    live = [k for k in range(n_langs) if len(by[k])]
    words, tags = np.zeros((N_SEQUENCES, SEQUENCE_WORDS), np.int64), np.zeros((N_SEQUENCES, SEQUENCE_WORDS), np.int64)
    for s in range(N_SEQUENCES):
        at = 0
        while at < SEQUENCE_WORDS:
            k = live[rng.integers(len(live))]
            r = by[k][rng.integers(len(by[k]))]
            n = min(int(rng.integers(1, MAX_RUN + 1)), SEQUENCE_WORDS - at, int(w.counts[r]))
            begin = w.first[r] + rng.integers(w.counts[r] - n + 1)
            words[s, at : at + n] = np.arange(begin, begin + n)
            tags[s, at : at + n] = k
            at += n
    return w, words, tags


def fit(texts: list[str], langs: list[str]) -> Field:
    """Maximum likelihood with a small ridge, by Adam on all sequences."""
    names = sorted(set(langs))
    y = np.array([names.index(x) for x in langs])
    w, words, tags = switched_sequences(texts, y, len(names))
    flat = words.ravel()
    _, at, which = np.unique(wh.word_hashes(w)[flat], return_index=True, return_inverse=True)
    used = flat[at]
    which = which.reshape(words.shape)
    owner, feats = features(w.data, w.starts[used], w.ends[used])
    n_feats, n = 1 << FEATURE_BITS, len(names)
    weights, moves = np.zeros((n_feats, n)), np.zeros((n, n))
    m1, v1, m2, v2 = np.zeros_like(weights), np.zeros_like(weights), np.zeros_like(moves), np.zeros_like(moves)
    seqs, steps = words.shape
    gold = np.eye(n)[tags]
    gold_moves = np.einsum("sti,stj->ij", gold[:, :-1], gold[:, 1:])
    for step in range(1, STEPS + 1):
        scores = np.stack([np.bincount(owner, weights[feats, k], len(used)) for k in range(n)], 1)
        e = np.exp(scores - scores.max(1, keepdims=True))[which]
        move = np.exp(moves)
        f, b = np.empty_like(e), np.ones_like(e)
        f[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
        for t in range(1, steps):
            x = (f[:, t - 1] @ move) * e[:, t]
            f[:, t] = x / x.sum(1, keepdims=True)
        for t in range(steps - 1, 0, -1):
            x = (e[:, t] * b[:, t]) @ move.T
            b[:, t - 1] = x / x.sum(1, keepdims=True)
        p = f * b
        p /= p.sum(2, keepdims=True)
        pair = np.zeros((n, n))
        for t in range(1, steps):
            x = f[:, t - 1, :, None] * move[None] * (e[:, t] * b[:, t])[:, None, :]
            pair += (x / x.sum((1, 2), keepdims=True)).sum(0)
        diff = (p - gold).reshape(-1, n)
        by_word = np.stack([np.bincount(which.ravel(), diff[:, k], len(used)) for k in range(n)], 1)
        g1 = np.stack([np.bincount(feats, by_word[owner, k], n_feats) for k in range(n)], 1) + 0.5 * weights
        g2 = (pair - gold_moves) + 0.5 * moves
        for x, g, m, v in ((weights, g1, m1, v1), (moves, g2, m2, v2)):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(names, weights.astype(np.float32), moves.astype(np.float32))


def train(docs: DataFrame, usable, max_rows: int = MAX_TRAIN_ROWS) -> Field | None:
    """Fit on a bounded sample of the rows that meet ``usable``; None if there is no such row."""
    text = F.col("text").cast("string")
    rows = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & text.rlike(r"\p{L}") & usable)
    rows = rows.select("lang", text.alias("text"), F.xxhash64(text, F.lit("sample")).alias("hash"))
    sizes = rows.groupBy("lang").agg(F.approx_count_distinct("hash").alias("n"), F.count("*").alias("rows"), F.sum(F.length("text")).alias("chars")).collect()
    if not sizes:
        return None
    most = max(MIN_LANG_ROWS, max_rows // len(sizes))
    fits = {r["lang"]: max(MIN_LANG_ROWS, min(most, TRAIN_CHARS / len(sizes) * r["rows"] / r["chars"])) for r in sizes}
    share = {r["lang"]: min(1.0, fits[r["lang"]] / max(1, r["n"])) for r in sizes}
    bound = docs.sparkSession.createDataFrame([(lang, int(x * (1 << 52))) for lang, x in share.items()], "lang string, bound long")
    some = rows.join(F.broadcast(bound), "lang").filter(F.pmod("hash", F.lit(1 << 52)) < F.col("bound")).select("lang", "hash", "text")
    got = some.dropDuplicates(["lang", "hash"]).toPandas().sort_values(["lang", "hash"])
    return fit(got["text"].tolist(), got["lang"].tolist()) if len(got) else None


def identify(docs: DataFrame, field: Field | None) -> DataFrame:
    """One row per document: ``row`` (all its columns) and ``language`` (lang, score, shares by language)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("__text"))
    rows = rows.withColumn("letters", F.coalesce(F.col("__text").rlike(r"\p{L}"), F.lit(False)))
    shape = "struct<lang:string,score:double,shares:array<double>>"
    if field is None:
        return rows.select("row", F.expr(f"CAST(named_struct('lang', '{UNDETERMINED}', 'score', 0D, 'shares', array()) AS {shape})").alias("language"))
    model = rows.sparkSession.sparkContext.broadcast((field.langs, field.weights, field.moves))

    def run(batches):
        known = Field(*model.value)
        for batch in batches:
            for part in wh.slices(batch, "__text", SLICE):
                w = letter_words(part.column("__text"))
                mass = known.shares(w)
                total = mass.sum(1, keepdims=True)
                share = np.divide(mass, total, out=np.zeros_like(mass), where=total > 0)
                has = part.column("letters").to_numpy(zero_copy_only=False).astype(bool) & (total[:, 0] > 0)
                best = share.argmax(1)
                langs = pa.array([known.langs[k] if ok else UNDETERMINED for k, ok in zip(best, has, strict=True)])
                score = np.where(has, np.clip(share.max(1), 0, 1), 0.0)
                out = pa.StructArray.from_arrays([langs, pa.array(score), pa.array(list(share), pa.list_(pa.float64()))], ["lang", "score", "shares"])
                yield pa.RecordBatch.from_arrays([part.column("row"), out], ["row", "language"])

    return rows.mapInArrow(run, wh.schema_with(rows.schema["row"], f"language {shape}"))


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """Contract query: doc_id, held_out, lang_pred, score for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    found = identify(docs.select("doc_id", "text"), train(docs, ~held))
    return found.select("row.doc_id", "language").select("doc_id", held.alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
