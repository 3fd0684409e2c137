import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items, most=20):
    """All scores, sorted."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    count, words = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        scored = []
        for i, c in counted:
            m, score = 100 - 25 + 25 * c.total() * count // words, 0
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scored)[:most], 1)]
    return Counter(out)


def found(docs, items, **more):
    return Counter(tuple(r) for r in ranked_search.search(docs, items, **more).select("item_id", "rank", "doc_id", "score").collect())


def corpus(seed, rows):
    rng = random.Random(seed)
    words = ["the", "The", "of", "é", "straße", "ẞ", "x1", "日本語"] + [f"w{k}" for k in range(400)]
    shared = " ".join(rng.choices(words, k=30))
    made = []
    for i in range(rows):
        text = " ".join(rng.choices(words, weights=[80 // (k + 1) + 1 for k in range(len(words))], k=rng.choice([3, 20, 60, 300])))
        made.append((i, rng.choice([text, text, shared + "." + text, shared])))
    return made


def test_same_as_all_scores(make, monkeypatch):
    monkeypatch.setattr(ranked_search, "ITEMS", 7)
    monkeypatch.setattr(ranked_search, "SLAB", 16)
    docs = corpus(1, 300)
    # Copies, repeated rows, null ids, texts without terms, a very long one.
    docs += [(i, docs[7][1]) for i in range(1000, 1040)] + [docs[3], docs[3], (None, docs[3][1]), (None, docs[3][1]), (5000, None), (5001, ""), (5002, " .,-\n")]
    docs += [(6000, "the of w1 w2 " * 30_000), (6001, "A_b A-B a\x00b")]
    items = [(k, " ".join(docs[3 * k][1].split()[:35])) for k in range(25)]
    items += [(0, items[0][1]), (1, "the the w3"), (None, "w5 unknownterm"), (70, "unknownterm"), (71, ""), (72, None), (73, "B"), (74, docs[7][1])]
    left = make("doc_id long, text string, item_id string, score int", *[(*r, "x", 1) for r in docs])
    right = make("item_id int, text string, doc_id string, rank int", *[(*r, "x", 1) for r in items])
    assert found(left, right) == by_hand([d for d in docs if d[1] is not None], [i for i in items if i[1]])
    assert found(left, right, most=3) == by_hand([d for d in docs if d[1] is not None], [i for i in items if i[1]], 3)


def test_no_rows(make):
    docs, items = make("doc_id long, text string", (1, "a b")), make("item_id int, text string", (1, "a"))
    assert found(docs.limit(0), items) == found(docs, items.limit(0)) == Counter()
    assert found(make("doc_id long, text string", (1, None), (2, "...")), items) == Counter()
    assert found(docs, items) == Counter({(1, 1, 1, 1000 * 0 + by_hand([(1, "a b")], [(1, "a")]).popitem()[0][3]): 1})


@pytest.mark.parametrize("seed", [1, 2])
def test_bounds_hold(seed):
    """A bound is never below the score, and the score itself where frequencies are small and no bit is set by chance."""
    docs = corpus(seed, 150)
    queries_of = [" ".join(t.split()[:20]) for _, t in docs[:10]]
    counted = [Counter(terms(t)) for _, t in docs]
    names = sorted({t for q in queries_of for t in terms(q)})
    place = {t: k for k, t in enumerate(names)}
    data = np.frombuffer("".join(names).encode(), np.uint8)
    sizes = [len(t.encode()) for t in names]
    keys = ranked_search.hashes(data, np.cumsum(sizes) - sizes, np.cumsum(sizes))
    queries = ranked_search.Queries(
        [t.encode() for t in names], keys, np.arange(1, len(names) + 1), [Counter({place[t]: n for t, n in Counter(terms(q)).items()}) for q in queries_of],
        len(docs), sum(c.total() for c in counted), 20)
    part = pa.RecordBatch.from_pydict({
        "id": pa.array(range(len(docs)), pa.int64()), "row1": pa.array(range(len(docs)), pa.int64()), "row2": pa.array(range(len(docs)), pa.int64()),
        "text": pa.array([t for _, t in docs])})
    seen, equal = set(), 0
    for block in ranked_search.blocks(part):
        ids = block.column("ids")[0].as_py()
        bounds = queries.bounds(queries.weighted(), np.array(block.column("lengths")[0].as_py()), block.column("bits")[0].as_py(),
                                block.column("slices")[0].as_py())
        for d, i in enumerate(ids):
            exact = queries.scores(docs[i][1], list(range(len(queries_of))))
            assert all(exact <= bounds[:, d])
            equal += int((np.array(exact) == bounds[:, d]).sum())
        seen |= set(ids)
    assert seen == set(range(len(docs))) and equal > 0.5 * len(docs) * len(queries_of)
