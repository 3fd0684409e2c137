"""Texts of Arrow batches as numpy arrays, and small helpers the operators share.

A batch of texts is one byte array with the offsets of its rows; words, lines and n-grams
are index arrays over it, so that Python runs per batch and not per word.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROOT = str(Path(__file__).resolve().parents[2])

# Bytes of text handled at a time; a longer single text is still handled whole.
CHUNK = 4 << 20

# Words of 64 bits of a filter of ids at most (32 MB), ids meant for a word, and marks of an id in its word.
MOST_WORDS, IDS_A_WORD, MARKS = 1 << 22, 4, 4

WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MIX = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.ones(1, np.uint64)


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the bytes of a batch that goes to Python, as texts may be very long, and let workers find this package."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    # The driver keeps the text of every plan that ran; some hold filters and long expressions.
    spark.conf.set("spark.sql.maxPlanStringLength", "10000")
    paths = spark.sparkContext.environment
    if ROOT not in paths.get("PYTHONPATH", "").split(os.pathsep):
        paths["PYTHONPATH"] = os.pathsep.join(filter(None, [paths.get("PYTHONPATH"), ROOT]))
    return spark


def plain(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns: others, whatever their names, stay out of the way."""
    return docs.select(*[docs[f"`{name}`"] for name in names])


def likely(rows: DataFrame, ids: DataFrame, id: str = "id") -> DataFrame:
    """The rows whose id is among ``ids``, and a few others: what is dropped need not be shuffled for an exact join.

    A Bloom filter goes to all tasks. It grows with the ids to MOST_WORDS and lets more rows pass from there on, all
    in the end. Ids whose equality is not that of their hashes (of two types, floating or collated) pass, and so may null.
    """
    kind = rows.schema[id].dataType
    exact = isinstance(kind, (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType))
    if kind != ids.schema[id].dataType or not (exact or kind == T.StringType()):
        return rows
    size = max(1, min(MOST_WORDS, -(-ids.count() // IDS_A_WORD)))
    key = F.xxhash64(F.col(f"`{id}`"))
    word = F.pmod(F.shiftright(key, 6 * MARKS), F.lit(size))
    places = [F.shiftright(key, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(MARKS)]
    # shiftleft() of the Python API takes no column of places.
    mark = reduce(Column.bitwiseOR, [F.call_function("shiftleft", F.lit(1).cast("long"), place) for place in places])
    none = rows.sparkSession.range(size).select(F.col("id").alias("word"), F.lit(0).cast("long").alias("mark"))
    words = ids.select(word.alias("word"), mark.alias("mark")).unionByName(none).groupBy("word").agg(F.bit_or("mark").alias("bits"))
    # Put in order in parts, then the parts.
    parts = words.groupBy(F.shiftright("word", 10).alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("word", "bits")))["bits"].alias("bits"))
    table = parts.agg(F.flatten(F.array_sort(F.collect_list(F.struct("part", "bits")))["bits"]).alias("bits"))
    return rows.filter(F.element_at(table.scalar(), (word + 1).cast("int")).bitwiseAND(mark) == mark)


def once(column: Column) -> Column:
    """A costly expression that the optimizer neither copies into several places nor moves.

    It takes an expression that is not deterministic for one that must be evaluated where it stands.
    """
    return F.when(F.monotonically_increasing_id() >= 0, column)


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``limit`` bytes of text, one row at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all rows, and the offsets of the rows; a null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    if len(column) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of marked bytes; runs end at the end of a row."""
    if not len(inside):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    borders = offsets[(offsets > 0) & (offsets < len(inside))]
    before = np.concatenate(([False], inside[:-1]))
    before[borders] = False
    after = np.concatenate((inside[1:], [False]))
    after[borders - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def mixed(keys: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: close keys come out far apart."""
    keys = (keys ^ (keys >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    keys = (keys ^ (keys >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return keys ^ (keys >> np.uint64(31))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, which may be empty."""
    global _POWERS
    sizes = ends - starts
    out = np.zeros(len(starts), np.uint64)
    if not len(starts):
        return out
    longest = int(sizes.max())
    if longest > len(_POWERS):
        _POWERS = np.multiply.accumulate(np.concatenate((_POWERS[:1], np.full(2 * longest, _STEP, np.uint64))))
    done, total = 0, np.cumsum(sizes)
    while done < len(starts):
        base = total[done - 1] if done else 0
        stop = max(done + 1, int(np.searchsorted(total, base + CHUNK, side="right")))
        size, first = sizes[done:stop], starts[done:stop]
        full = np.flatnonzero(size)
        if len(full):
            size, first = size[full], first[full]
            heads = np.cumsum(size) - size
            place = np.arange(int(size.sum())) - np.repeat(heads, size)
            terms = _MIX[data[place + np.repeat(first, size)]] * _POWERS[place]
            out[done + full] = np.add.reduceat(terms, heads)
        done = stop
    return mixed(out + sizes.astype(np.uint64) * _STEP)


def per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked bytes each row has."""
    counts = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
    return counts[offsets[1:]] - counts[offsets[:-1]]


def repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: does it occur more than once, and did it occur at an earlier place."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    same = np.concatenate(([False], ranked[1:] == ranked[:-1]))
    again, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    later[order] = same
    again[order] = same | np.concatenate((same[1:], [False]))
    return again, later
