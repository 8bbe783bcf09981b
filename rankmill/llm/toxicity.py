"""Operator 7 — toxicity by a weighted finite-state pattern grammar.

Five small transducers read the words of a clause: insult, threat, target,
negation and reported speech. Their composition is one table over product
states; it writes an event for every matched insult or threat and names the
event by its context (plain, targeted, negated, reported, threat).

The insult terms and their weights are learned from labelled rows: whole words
that toxic texts have far more often than others, and word beginnings that
``MIN_WORDS`` or more different words of toxic texts share and clean texts have
as rarely. Bias and context weights come from a logistic fit on rows that the terms
were not learned from, within the grammar's order: a targeted insult or a threat
weighs at least ``STRONGER`` times a plain one and reaches the threshold by itself,
a negated or reported one at most ``WEAKER`` times a plain one, and one plain
insult alone stays below the threshold.

At most about ``MAX_TRAIN_ROWS`` labelled rows (picked by a hash of the id) train,
whatever the input size. Their texts stay in the tasks: the driver receives term
counts of terms that pass, and five sums per row. Scoring is one pass over all texts
without a shuffle. The grammar's word lists are short and know four languages.

Defined cases: null and empty texts get the score of a text without events;
rows without a label, or with a label other than 0 and 1, do not train, and of
several labels of an id the larger counts; with no labelled row, or one class only, a
fixed small lexicon and fixed context weights score. Of two terms that fit a word the
heavier one counts. Repeated rows are scored alike. An empty table gives an empty
result.
"""

from __future__ import annotations

import re
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankmill.llm import wordhash as wh

MAX_TRAIN_ROWS = 16_000
MIN_SUPPORT = 5
MIN_LOG_ODDS = 3.0
MIN_WORDS = 2
PREFIX_LENGTHS = (4, 5, 6, 7, 8)
THRESHOLD = 0.7
STRONGER, WEAKER = 1.5, 0.4
EVENT_WEIGHT = 3.0  # of a threat, which is no learned term

CONTEXTS = ("plain", "targeted", "negated", "reported", "threat")

# Fixed word lists of the grammar: function words of the four languages.
NEGATION = {"not", "no", "never", "isn't", "aren't", "don't", "nicht", "kein", "keine", "nie", "pas", "jamais", "aucun", "nunca", "ningún", "tampoco"}
REPORT = {"said", "says", "claimed", "reported", "wrote", "quoted", "called", "sagte", "schrieb", "behauptete", "dit", "écrit", "affirme", "dijo", "escribió", "afirma"}
TARGET = {"you", "your", "he", "she", "they", "him", "her", "them", "these", "those", "du", "dich", "ihr", "sie", "tu", "vous", "ils", "elles", "usted", "ellos", "ellas", "ustedes"}
THREAT = {"kill", "hurt", "destroy", "shoot", "stab", "murder", "töten", "umbringen", "tuer", "détruire", "matar", "destruir"}
# Terms and weights where no labels teach any.
DEFAULT_TERMS = {"idiot": 3.0, "moron": 3.0, "scum": 3.0, "stupid": 2.0, "worthless": 2.0}
DEFAULT_WEIGHTS = {"bias": -4.0, "plain": 1.6, "targeted": 3.8, "negated": 0.1, "reported": 0.3, "threat": 3.8}

_WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
_CLAUSE = re.compile(r"[.!?;:\n]+")
_REACH = 4  # words that a target, threat or negation governs


def _countdown(symbol: str, reach: int) -> dict:
    """A transducer that remembers ``symbol`` for ``reach`` words."""
    return {(s, x): reach if x == symbol else max(s - 1, 0) for s in range(reach + 1) for x in "ITGNRx"}


def compose() -> tuple[dict, tuple]:
    """Product of the five transducers: (state, symbol) -> (next state, event or None)."""
    negation, target, threat = _countdown("N", _REACH - 1), _countdown("G", _REACH), _countdown("T", _REACH)
    report = {(s, x): 1 if x == "R" else s for s in (0, 1) for x in "ITGNRx"}
    table = {}
    for n, r, g, t in product(range(_REACH), (0, 1), range(_REACH + 1), range(_REACH + 1)):
        for x in "ITGNRx":
            event = None
            if x == "I":
                event = "negated" if n else "reported" if r else "targeted" if g else "plain"
            elif (x == "G" and t) or (x == "T" and g):
                event = "negated" if n else "reported" if r else "threat"
            table[(n, r, g, t), x] = ((negation[n, x], report[r, x], target[g, x], threat[t, x]), event)
    return table, (0, 0, 0, 0)


class Grammar:
    """Terms, context weights and the composed table; scores texts."""

    def __init__(self, terms: dict[str, float], weights: dict[str, float]):
        self.terms, self.weights = terms, weights
        self.table, self.start = compose()
        begins = sorted({t.rstrip("$") for t in terms} | THREAT, key=len)
        self.find = re.compile(r"(?<![^\W\d_])(?:" + "|".join(map(re.escape, begins)) + ")") if begins else None

    def weight(self, word: str) -> float:
        best = self.terms.get(word + "$", 0.0)
        for n in range(1, len(word) + 1):
            best = max(best, self.terms.get(word[:n], 0.0))
        return best

    def events(self, text: str | None) -> tuple[np.ndarray, int]:
        """Summed weight of the matched clauses by context, and their number."""
        sums, matched = np.zeros(len(CONTEXTS)), 0
        low = (text or "").lower()
        if not low or self.find is None or not self.find.search(low):
            return sums, matched
        for clause in _CLAUSE.split(low):
            if not self.find.search(clause):
                continue
            state, hits = self.start, 0
            for word in _WORD.findall(clause):
                w = self.weight(word)
                symbol = "I" if w > 0 else "T" if word in THREAT else "G" if word in TARGET else "N" if word in NEGATION else "R" if word in REPORT else "x"
                state, event = self.table[state, symbol]
                if event:
                    sums[CONTEXTS.index(event)] += w or EVENT_WEIGHT
                    hits += 1
            matched += hits > 0
        return sums, matched

    def score(self, sums: np.ndarray) -> float:
        z = self.weights["bias"] + sum(self.weights[c] * v for c, v in zip(CONTEXTS, np.sqrt(sums), strict=True))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _features(text: str) -> set[str]:
    out = set()
    for w in set(_WORD.findall(text.lower())):
        if len(w) >= PREFIX_LENGTHS[0]:
            out.add(w + "$")
            out.update(w[:n] for n in PREFIX_LENGTHS if n <= len(w))
    return out


def choose_terms(hit: dict[str, int], miss: dict[str, int], n_toxic: int, n_clean: int, several: set[str]) -> dict[str, float]:
    """Terms whose log odds reach ``MIN_LOG_ODDS``, with their odds; ``hit`` and ``miss`` count
    the toxic and the clean texts with a term. A beginning must be one of ``several``, and a
    longer term stays only if it says more."""
    odds = {f: float(np.log((c + 0.5) / (n_toxic + 1)) - np.log((miss.get(f, 0) + 0.5) / (n_clean + 1))) for f, c in hit.items() if c >= MIN_SUPPORT}
    terms: dict[str, float] = {}
    for f in sorted((f for f in odds if odds[f] >= MIN_LOG_ODDS), key=lambda f: (len(f), f)):
        word = f.rstrip("$")
        if f == word and f not in several:
            continue
        if not any(terms.get(word[:k], 0.0) >= odds[f] - 0.7 for k in range(PREFIX_LENGTHS[0], len(word) + 1)):
            terms[f] = odds[f]
    return terms


def learn_terms(rows: DataFrame) -> dict[str, float]:
    """Terms of the rows (text, toxic), counted in Spark: those of toxic texts, then what clean texts have of them."""

    def count(only: frozenset | None):
        def run(batches):
            for b in batches:
                found: dict[str, int] = {}
                for t in b.column(0).to_pylist():
                    for f in _features(t) if only is None else _features(t) & only:
                        found[f] = found.get(f, 0) + 1
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["f", "n"])

        return run

    def counted(part: DataFrame, only: frozenset | None, least: int) -> dict[str, int]:
        sums = part.select("text").mapInArrow(count(only), "f string, n long").groupBy("f").agg(F.sum("n").alias("n"))
        return {r["f"]: r["n"] for r in sums.filter(F.col("n") >= least).collect()}

    size = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = rows.filter("toxic = 1"), rows.filter("toxic = 0")
    hit = counted(toxic, None, MIN_SUPPORT)
    miss = counted(clean, frozenset(hit), 1)
    likely = {f for f, c in hit.items() if np.log((c + 0.5) / (size.get(1, 0) + 1)) - np.log((miss.get(f, 0) + 0.5) / (size.get(0, 0) + 1)) >= MIN_LOG_ODDS}
    begins = frozenset(f for f in likely if not f.endswith("$"))

    # how many different words begin alike; their number is all that is needed
    def words(batches):
        for b in batches:
            found = {w for t in b.column(0).to_pylist() for w in _WORD.findall(t.lower()) if any(w[:n] in begins for n in PREFIX_LENGTHS)}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.string())], ["w"])

    alike = toxic.select("text").mapInArrow(words, "w string").distinct()
    alike = alike.select(F.explode(F.array(*[F.when(F.length("w") >= n, F.substring("w", 1, n)) for n in PREFIX_LENGTHS])).alias("f"))
    several = {r["f"] for r in alike.filter("f IS NOT NULL").groupBy("f").count().filter(F.col("count") >= MIN_WORDS).collect()}
    return choose_terms({f: hit[f] for f in likely}, miss, size.get(1, 0), size.get(0, 0), several)


def _in_order(b: np.ndarray, heaviest: float, lightest: float) -> np.ndarray:
    """Bias and context weights moved into the grammar's order."""
    bias, w = b[0], dict(zip(CONTEXTS, b[1:], strict=True))
    edge = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    bias = min(bias, edge - 1.0)  # a text without events is clean
    plain = min(max(w["plain"], 0.01), (edge - 0.1 - bias) / np.sqrt(heaviest))
    strong = max(STRONGER * plain, (edge + 0.1 - bias) / np.sqrt(lightest))
    w = {"plain": plain, "targeted": max(w["targeted"], strong), "threat": max(w["threat"], (edge + 0.1 - bias) / np.sqrt(min(lightest, EVENT_WEIGHT)), STRONGER * plain)}
    w |= {c: min(max(b[1 + CONTEXTS.index(c)], 0.0), WEAKER * plain) for c in ("negated", "reported")}
    return np.array([bias, *(w[c] for c in CONTEXTS)])


def fit_weights(x: np.ndarray, y: np.ndarray, terms: dict[str, float], steps: int = 60, ridge: float = 0.02) -> dict[str, float]:
    """Logistic fit of bias and context weights on the square roots of the sums, within the grammar's order."""
    x = np.hstack([np.ones((len(x), 1)), np.sqrt(x)])
    b = np.array([DEFAULT_WEIGHTS["bias"], *(DEFAULT_WEIGHTS[c] for c in CONTEXTS)])
    prior = b.copy()
    heaviest, lightest = max(terms.values()), min(terms.values())
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        grad = x.T @ (p - y) + ridge * len(y) / 100 * (b - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + (ridge * len(y) / 100 + 1e-6) * np.eye(len(b))
        before, b = b, _in_order(b - np.linalg.solve(hess, grad), heaviest, lightest)
        if np.abs(b - before).max() < 1e-8:
            break
    return dict(zip(("bias", *CONTEXTS), map(float, _in_order(b, heaviest, lightest)), strict=True))


def train(docs: DataFrame, labels: DataFrame, usable, max_rows: int = MAX_TRAIN_ROWS) -> Grammar:
    """Learn a grammar from at most about ``max_rows`` labelled rows; ``usable`` is a condition on doc_id."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marks = marks.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & usable)
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, max_rows / max(1, marks.count()))
    marks = marks.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = texts.filter("text IS NOT NULL AND text != ''").join(marks, "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(7)) < 4).persist()
    try:
        sides = {(r["toxic"], r["part"]) for r in rows.select("toxic", "part").distinct().collect()}
        if len({y for y, _ in sides}) < 2:
            return Grammar(DEFAULT_TERMS, DEFAULT_WEIGHTS)
        every = learn_terms(rows.select("text", "toxic"))
        terms = learn_terms(rows.filter("part").select("text", "toxic")) or every or DEFAULT_TERMS
        held = rows.filter("NOT part") if {(0, False), (1, False)} <= sides else rows

        def sums(batches):
            g = Grammar(terms, DEFAULT_WEIGHTS)
            for b in batches:
                found = np.array([g.events(t)[0] for t in b.column(0).to_pylist()]).reshape(-1, len(CONTEXTS))
                yield pa.RecordBatch.from_arrays([pa.array(found[:, k]) for k in range(len(CONTEXTS))] + [b.column(1)], [*CONTEXTS, "toxic"])

        fitted = held.select("text", "toxic").mapInArrow(sums, ", ".join(f"{c} double" for c in CONTEXTS) + ", toxic int").toPandas()
    finally:
        rows.unpersist()
    terms = every or terms
    return Grammar(terms, fit_weights(fitted[list(CONTEXTS)].to_numpy(), fitted["toxic"].to_numpy(dtype=float), terms))


def score_documents(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """One row per document: ``row`` (all its columns) and ``toxicity`` (score, n_clauses)."""
    terms, weights = grammar.terms, grammar.weights

    def run(batches):
        g = Grammar(terms, weights)
        for b in batches:
            found = [g.events(t) for t in b.column("__text").to_pylist()]
            out = pa.StructArray.from_arrays([pa.array([g.score(s) for s, _ in found], pa.float64()), pa.array([m for _, m in found], pa.int64())], ["score", "n_clauses"])
            yield pa.RecordBatch.from_arrays([b.column("row"), out], ["row", "toxicity"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text").cast("string").alias("__text"))
    return rows.mapInArrow(run, wh.schema_with(rows.schema["row"], "toxicity struct<score:double,n_clauses:bigint>"))


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Contract query: doc_id, held_out, score, predicted for every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    grammar = train(docs, labels, ~held)
    scored = score_documents(docs.select("doc_id", "text"), grammar)
    score = F.col("toxicity.score")
    return scored.select("row.doc_id", "toxicity").select("doc_id", held.alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"), F.col("toxicity.n_clauses").alias("n_clauses"))
