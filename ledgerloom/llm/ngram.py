"""Interpolated modified Kneser-Ney models over the bytes of words, or of whole texts.

The events are bytes of a word and the blank after it, each predicted from the ORDER - 1 bytes
before it within the word; the word has blanks in front. In a model of whole texts (``runs_of``) the bytes
before an event run on over blanks into the words before, to the beginning of the text. An n-gram is packed
into a long, so it has eight bytes at most and counts are exact. Tasks count in numpy and send each n-gram once; Spark sums, derives
the continuation counts and joins each n-gram with the totals of its context.

For scoring, probabilities and backoff weights go into sorted tables that hold every entry. n-grams of
bytes within words saturate: their number follows the alphabets more than the corpus. A model of more than
MOST_ENTRIES is refused, never thinned, so that a broadcast of the tables is bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import CHUNK, WHITE, chunks, hashes, spans, text_bytes

ORDER = 5
BLANK, AGAIN = 0x20, 0x01

# Entries of all tables of a model together, of twelve bytes each.
MOST_ENTRIES = 24_000_000

# N-grams a task holds before it adds up equal ones; it sends them on if three quarters are left.
HELD = 2_000_000

# Bytes of whole texts whose events a task holds at a time, at some 60 bytes each; a longer single text is still held whole.
PIECE = 1 << 19

REPEATED = np.uint64(1)  # stands for a word equal to the one before it


@dataclass
class Words:
    """The words of a slice of a batch: rows, distinct words, and which of them stands at each place."""

    rows: int
    row: np.ndarray
    which: np.ndarray
    letters: list[np.ndarray]  # the ORDER bytes up to each event, the event's byte first
    heads: np.ndarray  # first event of each distinct word
    sizes: np.ndarray  # events of each distinct word

    @property
    def grams(self) -> np.ndarray:
        packed = np.zeros(len(self.letters[0]), np.uint64)
        for k, byte in enumerate(self.letters):
            packed |= byte.astype(np.uint64) << np.uint64(8 * k)
        return packed


def words_of(column: pa.Array, lower: bool, mark_repeats: bool) -> Words:
    """Split texts into words; with ``mark_repeats`` a word equal to the one before it becomes a mark."""
    if lower:
        column = pc.utf8_lower(column)
    data, offsets = text_bytes(column)
    starts, ends, row = spans(~WHITE[data], offsets)
    keys = hashes(data, starts, ends)
    if mark_repeats and len(keys):
        same = np.concatenate(([False], (keys[1:] == keys[:-1]) & (row[1:] == row[:-1])))
        keys[same] = REPEATED
    distinct, first, which = np.unique(keys, return_index=True, return_inverse=True)
    sizes = ends[first] - starts[first] + 1
    begin = starts[first]
    if mark_repeats and len(distinct) and (found := np.searchsorted(distinct, REPEATED)) < len(distinct) \
            and distinct[found] == REPEATED:
        data = np.append(data, np.uint8(AGAIN))
        begin[found], sizes[found] = len(data) - 1, 2
    # ORDER - 1 blanks, the word, and the blank after it.
    heads = np.cumsum(sizes) - sizes
    events = int(sizes.sum())
    owner = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(events) - heads[owner]
    letters = []
    for k in range(ORDER):
        at = place - k
        inside = (at >= 0) & (at < sizes[owner] - 1)
        byte = np.full(events, BLANK, np.uint8)
        byte[inside] = data[(begin[owner] + at)[inside]]
        letters.append(byte)
    return Words(len(offsets) - 1, row, which.reshape(-1), letters, heads, sizes)


@dataclass
class Runs:
    """The events of a slice of a batch: rows, row and n-gram of each event, in no order."""

    rows: int
    row: np.ndarray
    grams: np.ndarray


def runs_of(column: pa.Array, lower: bool, mark_repeats: bool, order: int) -> Runs:
    """The events of texts as whole runs: words and one blank after each, ``order`` - 1 blanks in front of a text.

    With ``mark_repeats`` a word equal to the one before it is two events, a mark and a blank. What comes after
    does not see the mark but goes on from the word, so that a mark is as unlikely after many marks as after none.
    """
    if lower:
        column = pc.utf8_lower(column)
    data, offsets = text_bytes(column)
    starts, ends, row = spans(~WHITE[data], offsets)
    if not len(starts):
        return Runs(len(offsets) - 1, np.zeros(0, np.int64), np.zeros(0, np.uint64))
    new = np.concatenate(([True], row[1:] != row[:-1]))
    same = np.zeros(len(row), bool)
    if mark_repeats:
        keys = hashes(data, starts, ends)
        same[1:] = (keys[1:] == keys[:-1]) & ~new[1:]
    after, marked = (np.cumsum(~same) - 1)[same], row[same]  # the word a mark goes on from
    starts, ends, row, new = (x[~same] for x in (starts, ends, row, new))
    sizes = ends - starts
    whole = sizes + 1 + np.where(new, order - 1, 0)
    heads = np.cumsum(whole) - sizes - 1
    stream = np.full(int(whole.sum()), BLANK, np.uint8)
    place = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    stream[place + np.repeat(heads, sizes)] = data[place + np.repeat(starts, sizes)]
    grams = stream.astype(np.uint64)
    for k in range(1, order):
        grams[k:] |= stream[:-k].astype(np.uint64) << np.uint64(8 * k)
    events = np.ones(len(stream), bool)
    events[(heads[new][:, None] - np.arange(1, order)[None, :]).ravel()] = False
    within = np.uint64((1 << 8 * order) - 1)
    marks = (grams[heads[after] + sizes[after]] << np.uint64(8) | np.uint64(AGAIN)) & within
    blanks = (marks << np.uint64(8) | np.uint64(BLANK)) & within
    return Runs(len(offsets) - 1, np.concatenate((np.repeat(row, sizes + 1), marked, marked)),
                np.concatenate((grams[events], marks, blanks)))


def _summed(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(grams)
    grams = grams[order]
    heads = np.flatnonzero(np.concatenate(([True], grams[1:] != grams[:-1]))[:len(grams)])
    return grams[heads], np.add.reduceat(counts[order], heads, dtype=np.int64) if len(heads) else np.zeros(0, np.int64)


def count_grams(rows: DataFrame, lower: bool, mark_repeats: bool, runs: int | None = None) -> DataFrame:
    """Counts (class, gram, n) of all n-grams of rows (class int, text string); n-grams are exact.

    They are of ORDER bytes within words or, with ``runs``, of so many bytes of whole texts.
    """

    def found_in(texts: pa.Array, kinds: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, np.ndarray]]]:
        if runs:
            events = runs_of(texts, lower, mark_repeats, runs)
            for kind in np.unique(kinds).tolist():
                yield kind, np.unique(events.grams[kinds[events.row] == kind], return_counts=True)
            return
        words = words_of(texts, lower, mark_repeats)
        grams = words.grams
        for kind in np.unique(kinds).tolist():
            times = np.bincount(words.which[kinds[words.row] == kind], minlength=len(words.sizes))
            times = np.repeat(times, words.sizes)
            used = times > 0
            yield kind, _summed(grams[used], times[used])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for kind, parts in held.items():
                grams, counts = _summed(*(np.concatenate(x) for x in zip(*parts)))
                for at in range(0, len(grams), 100_000):
                    some = slice(at, at + 100_000)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(grams[some]), kind, np.int32)), pa.array(grams[some].astype(np.int64)),
                        pa.array(counts[some])], names=["class", "gram", "n"])
            held.clear()

        for batch in batches:
            for part in chunks(batch, "text", PIECE if runs else CHUNK):
                for kind, found in found_in(part.column("text"), part.column("class").to_numpy()):
                    held.setdefault(kind, []).append(found)
                    size += len(found[0])
                if size > HELD:
                    for kind, parts in held.items():
                        held[kind] = [_summed(*(np.concatenate(x) for x in zip(*parts)))]
                    size = sum(len(parts[0][0]) for parts in held.values())
                    # With less room left, almost every piece would be a merge.
                    if size > HELD * 3 // 4:
                        yield from flush()
                        size = 0
        yield from flush()

    counted = rows.select(F.col("class").cast("int"), "text").mapInArrow(run, "class int, gram long, n long")
    return counted.groupBy("class", "gram").agg(F.sum("n").alias("n"))


def _suffix(gram, size):
    return gram.bitwiseAND(F.shiftrightunsigned(F.lit(-1).cast("long"), 64 - 8 * size))


def kneser_ney(counts: DataFrame, order: int = ORDER) -> DataFrame:
    """Table entries (class, back boolean, size int, key, value) of the model of each class.

    ``counts`` (class, gram, n) of n-grams of ``order`` bytes is read twice and should be stored. Entries with ``back`` false give the
    discounted probability of an n-gram of ``size`` bytes, the others the weight that the lower
    orders have after a context, for n-grams of ``size`` bytes.
    """
    top = counts.select("class", F.lit(order).alias("size"), "gram", "n")
    sizes = F.array(*[F.struct(F.lit(s).alias("size"), _suffix(F.col("gram"), s).alias("gram"))
                      for s in range(2, order)])
    shorter = counts.select("class", F.explode(sizes).alias("x")).select("class", "x.*").distinct()
    # Below the highest order a gram counts the different bytes before it.
    seen = shorter.unionByName(top.select("class", "size", "gram"))
    kept = F.element_at(F.array(*[_suffix(F.col("gram"), s) for s in range(1, order)]), F.col("size") - 1)
    lower = seen.select("class", (F.col("size") - 1).alias("size"), kept.alias("gram")).groupBy(
        "class", "size", "gram").agg(F.count("*").alias("n"))
    grams = top.unionByName(lower).withColumn("context", F.shiftrightunsigned("gram", 8)).checkpoint()
    # Discounts of modified Kneser-Ney smoothing, from the counts of counts.
    spread = grams.groupBy("class", "size").agg(*[
        F.sum((F.col("n") == k).cast("long")).alias(f"n{k}") for k in (1, 2, 3, 4)])
    part = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    discounts = [F.coalesce(k - (k + 1) * part * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")), F.lit(k / 2))
                 for k in (1, 2, 3)]
    spread = spread.select("class", "size", *[
        F.least(F.greatest(d, F.lit(0.05)), F.lit(float(k))).alias(f"d{k}") for k, d in zip((1, 2, 3), discounts)])
    contexts = grams.groupBy("class", "size", "context").agg(
        F.sum("n").alias("total"), *[F.sum((F.col("n") == k).cast("long")).alias(f"m{k}") for k in (1, 2)],
        F.sum((F.col("n") > 2).cast("long")).alias("m3")).join(spread, ["class", "size"])
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    seen = grams.join(contexts, ["class", "size", "context"]).select(
        "class", F.lit(False).alias("back"), "size", F.col("gram").alias("key"),
        (F.greatest(F.col("n") - discount, F.lit(0.0)) / F.col("total")).cast("float").alias("value"))
    # Discounts are above nothing, so an unseen byte is never impossible.
    back = contexts.select(
        "class", F.lit(True).alias("back"), "size", F.col("context").alias("key"),
        ((F.col("d1") * F.col("m1") + F.col("d2") * F.col("m2") + F.col("d3") * F.col("m3")) / F.col("total")).cast("float").alias("value"))
    return seen.unionByName(back)


Table = tuple[np.ndarray, np.ndarray]


def tables(entries: DataFrame) -> dict[tuple[int, bool, int], Table]:
    """Keys in order and values of all tables (class, back, size). More than MOST_ENTRIES are refused."""
    entries = entries.checkpoint()
    if (count := entries.count()) > MOST_ENTRIES:
        raise ValueError(f"the model has {count} entries, more than {MOST_ENTRIES}: train it with a smaller ORDER, or raise the bound")
    found = entries.toArrow()  # of bounded size
    kind, back, size, key, value = (found.column(name).to_numpy() for name in ("class", "back", "size", "key", "value"))
    key = key.view(np.uint64)
    order = np.lexsort((key, size, back, kind))
    kind, back, size, key, value = (x[order] for x in (kind, back, size, key, value))
    borders = np.flatnonzero((np.diff(kind) != 0) | (np.diff(back.astype(np.int8)) != 0) | (np.diff(size) != 0)) + 1
    out: dict[tuple[int, bool, int], Table] = {}
    for start, stop in zip([0, *borders], [*borders, len(key)]):
        if start < stop:
            out[int(kind[start]), bool(back[start]), int(size[start])] = key[start:stop].copy(), value[start:stop].astype(np.float32)
    return out


def _looked_up(table: Table | None, keys: np.ndarray, missing: float) -> np.ndarray:
    if table is None:
        return np.full(len(keys), missing, np.float32)
    own, values = table
    at = np.minimum(np.searchsorted(own, keys), len(own) - 1)
    return np.where(own[at] == keys, values[at], np.float32(missing))


def probabilities(model: dict, kind: int, grams: np.ndarray, sizes: range, lower: np.ndarray | None = None) -> np.ndarray:
    """Interpolated probability of each event with the orders ``sizes`` of a class above ``lower``.

    ``grams`` are best distinct and in order.
    """
    p = np.full(len(grams), 1 / 256, np.float32) if lower is None else lower
    for size in sizes:
        gram = grams & np.uint64((1 << 8 * size) - 1)
        p = _looked_up(model.get((kind, False, size)), gram, 0.0) + _looked_up(
            model.get((kind, True, size)), gram >> np.uint64(8), 1.0) * p
    return p


def per_event(words: Words, value: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """A value of each event, which ``value`` gives for distinct n-grams."""
    distinct, which = np.unique(words.grams, return_inverse=True)
    return value(distinct)[which.reshape(-1)]


def per_word(words: Words, values: np.ndarray) -> np.ndarray:
    """Sum over the events of each distinct word."""
    return np.add.reduceat(values.astype(np.float64), words.heads) if len(words.heads) else np.zeros(0)


def per_row(words: Words, values: np.ndarray, how: np.ufunc, empty: float) -> np.ndarray:
    """Combine a value of each distinct word over the words of each row."""
    out = np.full(words.rows, empty)
    if len(words.row):
        heads = np.flatnonzero(np.concatenate(([True], words.row[1:] != words.row[:-1])))
        out[words.row[heads]] = how.reduceat(values[words.which], heads)
    return out


def score(rows: DataFrame, model, scorer: Callable[[dict, pa.Array], dict[str, np.ndarray]], out: list[str],
          piece: int = CHUNK) -> DataFrame:
    """The columns but text, and the double columns ``out`` that ``scorer`` gives for it, some ``piece`` bytes at a time.

    ``model`` is a broadcast.
    """
    without_text = [f.name for f in rows.schema if f.name != "text"]
    spec = ", ".join([f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in without_text] + [
        f"`{name}` double" for name in out])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = model.value
        for batch in batches:
            for part in chunks(batch, "text", piece):
                found = scorer(tables, part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(name) for name in without_text], *[pa.array(found[name], pa.float64()) for name in out]],
                    names=[*without_text, *out])

    return rows.mapInArrow(run, spec)
