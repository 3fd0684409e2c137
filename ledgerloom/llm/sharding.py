"""Shards of nearly equal bytes: a minimax partition of ordered groups into contiguous runs.

Rows with equal texts are one atomic group; groups are ordered by a hash of the text. The
smallest capacity with which a greedy run over the groups needs no more shards than asked
for is found by binary search. The run needs sums up to its cuts only: the driver holds sums of
ranges of the hash, and splits a range with one aggregation when a cut falls inside it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import plain, prepare
from ledgerloom.session import shared_dir

# The hash that orders the groups has 63 bits; a range is split by the next BITS of them.
KEY_BITS, BITS = 63, 9


@dataclass(frozen=True)
class Range:
    """Hash values from ``low``, ``1 << bits`` of them, that hold ``size``; first and last value that occurs."""

    low: int
    bits: int
    size: int
    first: int
    last: int

    @property
    def atomic(self) -> bool:
        return self.first == self.last


def sums(sized: DataFrame, inside: list[Range], bits: int) -> list[Range]:
    """Sums of the parts, ``1 << bits`` wide, of some ranges of one width: at most ``len(inside) << BITS`` rows."""
    rows = sized
    if inside:
        wide = inside[0].bits
        rows = rows.filter(F.shiftright("key", wide).isin([r.low >> wide for r in inside]))
    parts = rows.groupBy(F.shiftright("key", bits).alias("part")).agg(
        F.sum("size").alias("size"), F.min("key").alias("first"), F.max("key").alias("last"))
    return [Range(p.part << bits, bits, p.size, p.first, p.last) for p in parts.collect()]


def run(ranges: list[Range], ends: np.ndarray, capacity: int, shards: int, whole: bool):
    """Greedy cuts for a capacity: (does all fit, hash value of each cut, range of each cut, is any cut open).

    A range that does not fit whole and is not one group is either left to the next shard as a
    whole, or (``whole`` false) cut to the byte; the true cut lies between the two.
    """
    at, index, total = 0, 0, int(ends[-1])
    cuts, stops, open_ = [], [], False
    for _ in range(shards):
        reach = at + capacity
        if reach >= total:
            return True, cuts, stops, open_
        stop = int(np.searchsorted(ends, reach, side="right"))  # ranges before it fit whole
        fitting = int(ends[stop - 1]) if stop else 0
        stops.append(stop)
        if ranges[stop].atomic or fitting == reach:
            at = max(at, fitting)
        else:
            open_ = True
            at = max(at, fitting) if whole else reach
        index = max(index, stop)
        cuts.append(ranges[index - 1].last if index else -1)
    return False, cuts, stops, open_


def minimax_cuts(sized: DataFrame, shards: int) -> tuple[int, list[int]]:
    """Smallest capacity and the last hash value of each shard but the last, for rows (key, size)."""
    ranges = sorted(sums(sized, [], KEY_BITS - BITS), key=lambda r: r.low)
    if not ranges:
        return 0, []
    total = sum(r.size for r in ranges)
    ends = np.cumsum([r.size for r in ranges])
    low, high = -(-total // shards), total
    while True:
        middle = (low + high) // 2
        fits, cuts, below, open_ = run(ranges, ends, middle, shards, whole=True)
        if fits and low == high and not open_:
            return middle, cuts
        could, _, above, _ = run(ranges, ends, middle, shards, whole=False)
        if not could:
            low = middle + 1
        elif fits and low < high:
            high = middle
        else:  # undecided: split the ranges in which a cut may fall
            near = {i for a, b in zip(below, above) for i in range(min(a, b), max(a, b) + 1)} | {*below, *above}
            inside = [ranges[i] for i in near if not ranges[i].atomic]
            ranges = [r for i, r in enumerate(ranges) if i not in near or r.atomic]
            for bits in {r.bits for r in inside}:
                ranges += sums(sized, [r for r in inside if r.bits == bits], max(0, bits - BITS))
            ranges.sort(key=lambda r: r.low)
            ends = np.cumsum([r.size for r in ranges])


def shard(docs: DataFrame, shards: int = 8, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Put every row into one of ``shards`` contiguous shards of nearly equal bytes.

    Returns id, size (UTF-8 bytes of the text plus 1), text_crc32, law, shard, slot, grown_shard.
    Rows with equal texts stay together; a null text counts as an empty one. A group larger than
    all others fills a shard of its own, and shards may stay empty with few groups. Slots
    are gapless from 0 in each shard, repeated rows have one each. No row comes out of an empty table.
    """
    spark = prepare(docs.sparkSession)
    shared_dir(spark)
    content = F.coalesce(F.col("text"), F.lit(""))
    rows = plain(docs, id, text).toDF("id", "text").select(
        "id", (F.octet_length(content) + F.lit(1).cast("long")).alias("size"), F.crc32(content).alias("crc"),
        F.shiftrightunsigned(F.xxhash64(content), 1).alias("key")).checkpoint()
    _, cuts = minimax_cuts(rows.select("key", "size"), shards)
    number = F.lit(0)
    for cut in cuts:
        number = number + (F.col("key") > F.lit(cut)).cast("int")
    placed = rows.withColumn("shard", number).withColumn("part", F.spark_partition_id())
    # The checkpoint has fixed partitions, so that a second pass can number on from their counts.
    counts = sorted(tuple(r) for r in placed.groupBy("part", "shard").count().collect())
    begin, used = {}, [0] * shards
    for part, k, n in counts:
        begin[part, k] = used[k]
        used[k] += n
    kind = docs.schema[id].dataType.simpleString()

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        following: dict[int, int] = {}
        for batch in batches:
            parts, ks = (batch.column(c).to_numpy() for c in ("part", "shard"))
            slot = np.zeros(batch.num_rows, np.int64)
            for k in np.unique(ks).tolist():
                mine = np.flatnonzero(ks == k)
                start = following.get(k, None)
                start = begin[int(parts[0]), k] if start is None else start
                slot[mine] = start + np.arange(len(mine))
                following[k] = start + len(mine)
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("id", "size", "crc")] + [
                    pa.array(["bytes"] * batch.num_rows), batch.column("shard"), pa.array(slot),
                    pa.nulls(batch.num_rows, pa.int32())],
                names=[id, "size", "text_crc32", "law", "shard", "slot", "grown_shard"])

    return placed.mapInArrow(
        slots, f"`{id}` {kind}, size long, text_crc32 long, law string, shard int, slot long, grown_shard int")
