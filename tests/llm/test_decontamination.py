import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import SMALL, got
from pyspark.sql import functions as F

from ledgerloom.llm import decontamination

K, NEED = decontamination.K, decontamination.SIMILARITY


def words_of(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(words):
    out = Counter()
    for i in range(len(words) - K + 1):
        out[tuple(words[i:i + K])] += 1
    return out


def weight(counted):
    return sum(n * sum(map(len, run)) for run, n in counted.items())


def by_hand(docs, items):
    """All windows of all texts that share a run with an item of their size."""
    found = set()
    index = defaultdict(set)
    own = {i: runs(words_of(t)) for i, t in items}
    size = {i: len(words_of(t)) for i, t in items}
    for i in own:
        for run in own[i]:
            index[run].add(i)
    for d, text in docs:
        words = words_of(text)
        near = {i for run in runs(words) for i in index[run]}
        for i in near:
            for start in range(max(1, len(words) - size[i] + 1)):
                window = runs(words[start:start + size[i]])
                both, either = weight(window & own[i]), weight(window | own[i])
                if either and both / either >= NEED:
                    found.add((d, i))
    return found


def found_by(docs, items):
    return {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgé") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(i, prose(rng.randint(5, 60))) for i in range(40)] + [(98, "too short"), (99, None)]
    docs = []
    for d in range(120):
        text = prose(rng.randint(0, 120))
        item = rng.choice(items[:40])[1].split()
        if d % 3 == 0:
            if d % 2 and len(item) > 20:  # one word changed near an end, or dropped
                item[rng.choice([0, 1, -1])] = word()
            text = f"{text} {' '.join(item).upper() if d % 5 == 0 else ', '.join(item)}. {prose(rng.randint(0, 80))}"
        elif d % 3 == 1:
            text += " " + " ".join(item[:max(5, len(item) // 2)])
        docs.append((d, text))
    return docs, items


def test_all_that_is_similar_is_found(make, corpus):
    docs, items = corpus
    extra = [(200, None), (201, ""), (None, items[0][1]), (5, docs[5][1])]
    rows = make("doc_id long, text string, words int, item_id int, runs int", *[(*d, 0, 0, 0) for d in docs + extra])
    bench = make("item_id long, text string, size int, print int", *[(*i, 0, 0) for i in items])
    wanted = by_hand(docs, [i for i in items if len(words_of(i[1])) >= K]) | {(None, 0)}
    assert len(wanted) > 30
    assert found_by(rows, bench) == wanted
    kept = decontamination.clean(rows, bench)
    dirty = {d for d, _ in wanted}
    assert sorted((r.doc_id or -1) for r in kept.collect()) == sorted((d or -1) for d, _ in docs + extra if d not in dirty)
    assert kept.columns == rows.columns


def test_in_several_passes(make, corpus, monkeypatch):
    docs, items = corpus
    rows, bench = make("doc_id long, text string", *docs), make("item_id long, text string", *items)
    whole = found_by(rows, bench)
    monkeypatch.setattr(decontamination, "MOST_RUNS", 300)
    assert found_by(rows, bench) == whole


def test_nothing_to_find(make, corpus):
    docs, items = corpus
    rows, bench = make("doc_id long, text string", *docs), make("item_id long, text string", *items)
    for left, right in ((rows.limit(0), bench), (rows, bench.limit(0)), (rows, bench.filter("item_id > 97"))):
        assert got(decontamination.contaminated(left, right)) == []
        assert decontamination.clean(left, right).count() == left.count()


def test_blocks_find_every_fingerprint_within_the_radius(spark):
    rng = random.Random(1)
    for _ in range(40):
        print_, other = rng.getrandbits(64), 0
        other = print_
        for bit in rng.sample(range(64), decontamination.RADIUS):
            other ^= 1 << bit
        rows = spark.createDataFrame([tuple(x - 2**64 if x >= 2**63 else x for x in (print_, other))], "a long, b long")
        row = rows.select(decontamination.blocks(F.col("a")).alias("a"), decontamination.blocks(F.col("b")).alias("b")).first()
        assert len(row.a) == decontamination.BLOCKS and set(row.a) & set(row.b)
        high = [64 * (i + 1) // decontamination.BLOCKS for i in range(decontamination.BLOCKS)]
        low = [0, *high[:-1]]
        assert [x.part for x in row.a] == [(print_ >> a) & ((1 << b - a) - 1) for a, b in zip(low, high)]


def test_registered_table(spark):
    docs, items = (spark.read.parquet(f"{SMALL}/{n}.parquet") for n in ("documents", "benchmark"))
    found = decontamination.contaminated(docs, items)
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.doc_id, r.item_id) for r in found.collect()} == by_hand(
        [tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
