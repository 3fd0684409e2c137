import random
import re

import numpy as np
import pyarrow as pa
import pytest
from conftest import SMALL, got

from ledgerloom.llm import near_duplicates as near


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def changed(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        i, kind = rng.randrange(len(out) + 1), rng.random()
        if kind < 0.4 or not out:
            out.insert(i, rng.randrange(5000))
        elif kind < 0.7:
            out.pop(min(i, len(out) - 1))
        else:
            out[min(i, len(out) - 1)] = rng.randrange(5000)
    return out


def test_alignment():
    rng = random.Random(5)
    for _ in range(4000):
        a = [rng.randrange(rng.choice([4, 400])) for _ in range(rng.randint(0, 30))]
        b = changed(rng, a, rng.randint(0, 8)) if rng.random() < 0.8 else [rng.randrange(4) for _ in range(rng.randint(0, 30))]
        d = distance(a, b)
        for most in (0, 1, 3, 6, 40):
            assert near.edits_within(np.array(a, np.uint64), np.array(b, np.uint64), most) == (d <= most)


def test_alignment_of_long_texts(monkeypatch):
    rng = random.Random(6)
    monkeypatch.setattr(near, "SHORT", 20)
    monkeypatch.setattr(near, "STRETCH", 16)
    for _ in range(300):
        a = [rng.randrange(rng.choice([6, 400])) for _ in range(rng.randint(30, 120))]
        b = changed(rng, a, rng.randint(0, 30))
        d = distance(a, b)
        for most in (3, 12, 40):
            assert near.edits_within(np.array(a, np.uint64), np.array(b, np.uint64), most) == (d <= most)
    monkeypatch.undo()
    # Many different words: the places take memory in proportion to the length.
    a = np.array([rng.randrange(10**9) for _ in range(200_000)], np.uint64)
    b = a.copy()
    b[rng.sample(range(len(b)), 100)] += np.uint64(1)
    assert near.edits_within(a, b, 40_000) and not near.edits_within(a, np.roll(b, 120_000), 40)


def test_components(make):
    rng = random.Random(8)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000, i) for i in range(1001, 1060)]
    links = [x for x in links if x[0] != x[1]]
    root = {n: n for x in links for n in x}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = dict(got(near.components(make("node long, lead long", *links))))
    assert {n: found.get(n, n) for n in root} == {n: find(n) for n in root}


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(11)
    groups = []
    for g in range(25):
        base = [rng.randrange(5000) for _ in range(rng.choice([60, 300]))]
        groups.append([base] + [changed(rng, base, max(1, len(base) // 50)) for _ in range(rng.randint(0, 5))])
    text = lambda words: " ".join(f"w{w}" for w in words)
    rows = [(g * 100 + k, text(w)) for g, group in enumerate(groups) for k, w in enumerate(group)]
    return rows, text


def test_classes(make, planted):
    rows, _ = planted
    odd = [(9000, None), (9001, ""), (9002, "  "), (9003, "!!!"), (9004, "!!!"), (9005, "one two"), (9006, "One, two!"), (9007, "one"),
           (0, rows[0][1]), (9008, rows[0][1].upper() + "."), (None, rows[1][1])]
    docs = make("doc_id long, text string, node int, words int, lead int", *[(*r, 1, 1, 1) for r in rows + odd])
    found = [tuple(r) for r in near.near_duplicates(docs).select("doc_id", "class_id").collect()]
    assert len(found) == len(rows) + len(odd)
    classes = {d: c for d, c in found if d is not None}
    assert all(classes[d] == d // 100 * 100 for d, _ in rows)
    assert classes[9000] == classes[9001] == 9000 and classes[9002] == 9002 and classes[9003] == classes[9004] == 9003
    assert classes[9005] == classes[9006] == 9005 and classes[9007] == 9007 and classes[9008] == 0
    assert [c for d, c in found if d is None] == [0]
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes.values()))


def test_repeated_rows_and_none(make):
    docs = make("doc_id long, text string", *[(1, "a b c d e f g")] * 5, (None, "x y z"), (None, "x y z"))
    assert got(near.keep_one(docs)) == sorted([(1, "a b c d e f g"), (None, "x y z")], key=repr)
    assert got(near.near_duplicates(docs.limit(0))) == [] and near.keep_one(docs.limit(0)).count() == 0


def test_a_group_makes_no_pairs_of_its_members(make):
    rng = random.Random(2)
    base = [rng.randrange(5000) for _ in range(100)]
    texts = [" ".join(f"w{w}" for w in changed(rng, base, 2)) for _ in range(150)]
    docs = make("doc_id long, text string", *enumerate(texts))
    found = near._sketched(docs, "doc_id", "text")
    nodes = found.selectExpr("id AS node", "words", "sketches")
    assert near._candidates(nodes).count() < 150 * 2 * near.SKETCHES
    assert near.near_duplicates(docs).select("class_id").distinct().count() == 1


def test_against_all_pairs(spark):
    rows = [(r.doc_id, re.findall(r"[^\W_]+", r.text.lower())) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    classes = dict(got(near.near_duplicates(spark.read.parquet(f"{SMALL}/documents.parquet")).select("doc_id", "class_id")))
    short = [(d, w) for d, w in rows if 5 <= len(w) <= 400]
    shingles = {d: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} for d, w in short}
    pairs = [(a, b) for i, (a, _) in enumerate(short) for b, _ in short[:i]
             if len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b])]
    assert pairs and all(classes[a] == classes[b] for a, b in pairs)

def test_recall_at_the_edits_that_are_allowed():
    rng = random.Random(31)
    for length, share in ((60, 0.15), (60, 0.2), (300, 0.15), (300, 0.2)):
        pairs = []
        for _ in range(400):
            a = [rng.randrange(10**6) for _ in range(length)]
            b = list(a)
            for i in rng.sample(range(length), int(share * length)):
                b[i] = rng.randrange(10**6)
            pairs.append((a, b))
        one, other = (near.sketches(pa.array([" ".join(map(str, p[k])) for p in pairs]))[0] for k in (0, 1))
        assert (one == other).any(axis=1).mean() >= 0.98


def test_pairs_among_many_texts_with_one_passage(make):
    rng = random.Random(12)
    passage = [rng.randrange(10**6) for _ in range(70)]
    rows = []
    for g in range(200):
        base = passage + [rng.randrange(10**6) for _ in range(30)]
        copy = list(base)
        for i in rng.sample(range(100), 8 + g % 2 * 4):
            copy[i] = rng.randrange(10**6)
        rows += [(2 * g, " ".join(map(str, base))), (2 * g + 1, " ".join(map(str, copy)))]
    rng.shuffle(rows)
    classes = dict(got(near.near_duplicates(make("doc_id long, text string", *rows)).select("doc_id", "class_id")))
    assert all(classes[d] // 2 == d // 2 for d in classes)
    assert sum(classes[2 * g + 1] == 2 * g for g in range(200)) >= 198


def test_pairs_inside_longer_texts(make):
    # The leader holds the whole of shorter texts, among which are pairs.
    rng = random.Random(13)
    long = [rng.randrange(10**6) for _ in range(400)]
    rows = [(0, " ".join(map(str, long)))]
    for k in range(1, 40, 2):
        base = long[150:260] + [rng.randrange(10**6) for _ in range(40)]
        other = list(base)
        other[5], other[-5] = 1, 2
        rows += [(k, " ".join(map(str, base))), (k + 1, " ".join(map(str, other)))]
    classes = dict(got(near.near_duplicates(make("doc_id long, text string", *rows)).select("doc_id", "class_id")))
    assert classes == {0: 0} | {d: d - (d + 1) % 2 for d in range(1, 41)}
