import random
import zlib
from collections import defaultdict

import pytest

from ledgerloom.llm import sharding


def least_capacity(sizes, shards):
    """Smallest capacity for contiguous shards, by trying."""
    low = max([-(-sum(sizes) // shards), *sizes])
    while True:
        used, room = 1, low
        for size in sizes:
            if size > room:
                used, room = used + 1, low
            room -= size
        if used <= shards:
            return low
        low += 1


@pytest.mark.parametrize("seed, rows, most, shards", [(1, 300, 50, 8), (2, 40, 1000, 8), (3, 500, 3, 5), (4, 5, 9, 8), (5, 60, 10, 1)])
def test_capacity_is_the_least(spark, seed, rows, most, shards):
    rng = random.Random(seed)
    # Close keys make the ranges split several times.
    keys = [rng.choice([rng.randrange(2**63), rng.randrange(2**20)]) for _ in range(rows)]
    data = [(k, rng.randint(1, most)) for k in keys] + [(keys[0], most * rows // 3)]
    groups = defaultdict(int)
    for key, size in data:
        groups[key] += size
    ordered = [groups[k] for k in sorted(groups)]
    capacity, cuts = sharding.minimax_cuts(spark.createDataFrame(data, "key long, size long"), shards)
    assert capacity == least_capacity(ordered, shards)
    filled = defaultdict(int)
    for key, size in groups.items():
        filled[sum(key > cut for cut in cuts)] += size
    assert len(filled) <= shards and max(filled.values()) <= capacity


def test_rows_are_placed_whole(make):
    rows = [(i, f"text {i % 40} " * (1 + i % 7)) for i in range(200)] + [(7, None), (8, ""), (None, "é"), (None, "é")]
    docs = make("doc_id long, text string, shard string, size int", *[(*r, "x", 0) for r in rows])
    found = sharding.shard(docs, 8).collect()
    assert len(found) == len(rows)
    by_shard, texts = defaultdict(list), defaultdict(set)
    known = defaultdict(list)
    for i, text in rows:
        known[i].append((len((text or "").encode()) + 1, zlib.crc32((text or "").encode())))
    for r in found:
        assert (r["size"], r.text_crc32) in known[r.doc_id] and r.law == "bytes" and r.grown_shard is None
        by_shard[r.shard].append(r.slot)
        texts[r["size"], r.text_crc32].add(r.shard)
    assert all(sorted(slots) == list(range(len(slots))) for slots in by_shard.values())
    assert all(len(shards) == 1 for shards in texts.values()) and set(by_shard) <= set(range(8))


def test_no_rows(make):
    assert sharding.shard(make("doc_id long, text string")).collect() == []
