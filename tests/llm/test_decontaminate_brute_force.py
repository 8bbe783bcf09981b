"""Operator 10 against a plain tiling of every document with every item."""

import random

import pytest

from rankmill.llm import decontaminate


def _words(text):
    out, word = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if c >= "\x80" or c.isalnum():
            word += c
        elif word:
            out.append(word)
            word = ""
    return out


def _covered(doc, item, least):
    """Words of the item that are covered: the longest common free run first, the leftmost in the
    document, then in the item, on a tie."""
    least = min(least, len(item))
    free_doc, free_item = [True] * len(doc), [True] * len(item)
    for n in range(min(len(doc), len(item)), least - 1, -1):
        for p in range(len(doc) - n + 1):
            for q in range(len(item) - n + 1):
                if doc[p : p + n] == item[q : q + n] and all(free_doc[p : p + n]) and all(free_item[q : q + n]):
                    free_doc[p : p + n] = [False] * n
                    free_item[q : q + n] = [False] * n
                    break
    return free_item.count(False)


@pytest.mark.parametrize("least", [2, 5])
def test_equal_to_tiling_every_pair(spark, least):
    rng = random.Random(least)
    alphabet = ["a", "B", "c3", "dé", "e", "Ü", "日本"]
    words = lambda n: [rng.choice(alphabet[:4] if rng.random() < 0.7 else alphabet) for _ in range(n)]
    glue = lambda ws: "".join(w + rng.choice((" ", ", ", "-", "\n", " ... ")) for w in ws)
    items = [words(n) for n in (1, 2, 3, 5, 6, 8, 12, 12, 20)]
    bench = [(i, glue(w)) for i, w in enumerate(items)] + [(90, glue(items[6])), (None, glue(items[7])), (91, ""), (92, None), (93, "?!")]
    docs = []
    for d in range(60):
        parts = [words(rng.randrange(6))]
        for _ in range(rng.randrange(3)):
            whole = rng.choice(items)
            cut = rng.randrange(len(whole) + 1)
            parts += [whole[cut:], words(rng.randrange(3)), whole[:cut]]  # passages in another order
        docs.append((d, glue([w for p in parts for w in p])))
    docs += [(100, None), (101, "")]
    want = {}
    for d, text in docs:
        found = []
        for i, t in bench:
            item, doc = _words(t), _words(text)
            if item and doc and (share := _covered(doc, item, least) / len(item)) >= 0.8:
                found.append((i, share))
        want[d] = (sorted({i for i, _ in found if i is not None}), max((s for _, s in found), default=0.0))
    assert sum(bool(w[0]) for w in want.values()) > 10 and (least > 2 or any(0 < w[1] < 1 for w in want.values()))
    left, right = spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(bench, "item_id long, text string")
    for bound in (10**6, 0):
        got = {r.row.doc_id: (list(r.contamination["items"]), r.contamination.coverage) for r in decontaminate.decontaminate(left, right, seed_words=least, max_broadcast_words=bound).collect()}
        assert got == want, bound
