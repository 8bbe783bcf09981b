"""Operator 7: the composed table, the order of the contexts and the learned terms."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from rankmill.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def _one_by_one(symbols):
    """Events of a clause by running the five transducers beside each other, each with a memory of its own."""
    since = {"N": None, "G": None, "T": None}
    reported, out = False, []
    reach = {"N": T._REACH - 1, "G": T._REACH, "T": T._REACH}
    for at, x in enumerate(symbols):
        near = {k: v is not None and at - v <= reach[k] for k, v in since.items()}
        event = None
        if x == "I":
            event = "negated" if near["N"] else "reported" if reported else "targeted" if near["G"] else "plain"
        elif (x == "G" and near["T"]) or (x == "T" and near["G"]):
            event = "negated" if near["N"] else "reported" if reported else "threat"
        out.append(event)
        if x in since:
            since[x] = at
        reported = reported or x == "R"
    return out


def test_composed_table_equals_the_transducers_one_by_one():
    table, start = T.compose()
    rng = random.Random(7)
    clauses = [c for n in range(1, 6) for c in itertools.product("ITGNRx", repeat=n)]
    clauses += ["".join(rng.choices("ITGNRxxxx", k=rng.randrange(6, 25))) for _ in range(3000)]
    for clause in clauses:
        state, events = start, []
        for x in clause:
            state, event = table[state, x]
            events.append(event)
        assert events == _one_by_one(clause), clause


@pytest.fixture(scope="module")
def learned(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1
    return T.train(docs, labels, ~held)


def test_learned_contexts_are_in_order(learned):
    w = learned.weights
    assert w["targeted"] >= T.STRONGER * w["plain"] and w["threat"] >= T.STRONGER * w["plain"]
    assert 0 <= w["negated"] <= T.WEAKER * w["plain"] and 0 <= w["reported"] <= T.WEAKER * w["plain"]


def test_clauses_are_scored_and_words_alone_are_not(learned):
    for grammar in (learned, T.Grammar(T.DEFAULT_TERMS, T.DEFAULT_WEIGHTS)):
        toxic = lambda text: grammar.score(grammar.events(text)[0]) >= T.THRESHOLD  # noqa: E731, B023
        assert not any(map(toxic, ("the path leads home", "the clown laughed", "a worthless person", "you are not an idiot", "she said you are stupid", "clow lose wort", "", "you and they")))
        assert all(map(toxic, ("you are worthless", "you idiot", "i will kill you", "they are stupid", "Idiot, moron and idiot! Stupid moron. Stupid idiot.")))


def test_beginnings_need_several_words_and_clean_texts(spark):
    rows = [(f"schimpfli{c} das ist klown{i % 7 * 0}", 1) for i, c in enumerate("abcdefgh" * 3)]
    rows += [("das ist ein klar gutes haus und lagerist", 0)] * 3 + [(f"haus nummer {i} ist gut", 0) for i in range(60)]
    rows = [(f"{t} zeile {i}", y) for i, (t, y) in enumerate(rows)]
    terms = T.learn_terms(spark.createDataFrame(rows, "text string, toxic int"))
    assert "schi" in terms and "klown$" in terms and not any(t in terms for t in ("klow", "klown", "zeil", "zeile$", "das$", "haus$"))
