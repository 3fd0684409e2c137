"""Ranked lexical search over bit-sliced Bloom signatures.

Each document has a Bloom signature of its terms, once for every step of their frequencies (LEVELS), of a size
that follows from how much it holds. The signatures of a block of documents lie side by side, a row of
bits for each place of the signature, so that the places of a query term, put together by AND, say for all
documents of the block at once whether it may be there, and how often at most. A Bloom filter errs to one side only:
the weighted sum of what the frequencies are at most is a bound from above. All documents but those that the
bound provably excludes are scored again from their texts.

Items are searched in blocks against all documents. A block takes two passes over the signatures: one for
the documents of the highest bounds, whose exact scores give each item a threshold, and one for all
documents whose bound reaches it.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import chunks, hashes, mixed, prepare, spans, text_bytes
from ledgerloom.session import shared_dir, work_dir

# Bytes of terms: ASCII letters and digits, and all of letters beyond ASCII.
_TERM = np.zeros(256, bool)
_TERM[[b for b in range(256) if b >= 128 or chr(b).isalnum()]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
TERMS = re.compile(rb"[0-9a-z\x80-\xff]+")

# Bits of a signature for each of its keys, at least, and places of a key.
BITS, PLACES = 12, 4
# Items and bytes of items in a block of queries, as a mean.
ITEMS, ITEM_BYTES = 256, 512 << 10
# Query terms handled at a time.
SLAB = 4096
LAST = np.iinfo(np.int64).max  # stands for a null id, which comes after all others


def _levels() -> np.ndarray:
    steps = [1]
    while steps[-1] < 1 << 40:
        steps.append(max(steps[-1] + 1, math.ceil(steps[-1] * 1.2)))
    return np.array(steps, np.int64)


# A term has a key for each of these frequencies that it reaches.
LEVELS = _levels()


def _places(terms: np.ndarray, level: np.ndarray | int, bits: int) -> np.ndarray:
    """The bits (PLACES by keys) of terms at levels in signatures of so many bits, a power of two."""
    key = mixed(terms ^ mixed(np.asarray(level, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(12)))
    step = (key >> np.uint64(32)) | np.uint64(1)
    return (key[None, :] + np.arange(PLACES, dtype=np.uint64)[:, None] * step[None, :]) & np.uint64(bits - 1)


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms of each text as 64-bit hashes: rows, terms, frequencies; and how many terms each row has."""
    data, offsets = text_bytes(column)
    data = _LOWER[data]
    starts, ends, row = spans(_TERM[data], offsets)
    keys = hashes(data, starts, ends)
    order = np.lexsort((keys, row))
    row, keys = row[order], keys[order]
    first = np.ones(len(keys), bool)
    first[1:] = (row[1:] != row[:-1]) | (keys[1:] != keys[:-1])
    heads = np.flatnonzero(first)
    counts = np.diff(np.append(heads, len(keys)))
    return row[heads], keys[heads], counts, np.bincount(row, minlength=len(offsets) - 1)


INDEX = ("ids array<long>, row1 array<long>, row2 array<long>, lengths array<long>, bits long, slices binary, "
         "terms array<long>, counts array<long>")


def _lists(values: np.ndarray, parts: int = 1) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, pa.int64()))


def blocks(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Index rows of some documents: one for each size of signature; the first has their document frequencies too."""
    row, term, count, length = terms_of(part.column("text"))
    id = part.column("id").fill_null(int(LAST)).to_numpy(zero_copy_only=False)
    keys = [part.column(name).to_numpy(zero_copy_only=False) for name in ("row1", "row2")]
    reached = np.searchsorted(LEVELS, count, side="right")
    held = np.bincount(row, reached, len(length)).astype(np.int64)
    bits = np.left_shift(1, np.ceil(np.log2(np.maximum(64, BITS * held))).astype(np.int64))
    own, often = np.unique(term, return_counts=True)
    for size in np.unique(bits[length > 0]).tolist():
        docs = np.flatnonzero((bits == size) & (length > 0))
        docs = docs[np.argsort(id[docs], kind="stable")]
        place = np.full(len(length), -1)
        place[docs] = np.arange(len(docs))
        width = -(-len(docs) // 8) * 8
        marks = np.zeros(size * width, bool)
        mine = place[row] >= 0
        level, column, keyed = reached[mine], place[row[mine]], term[mine]
        for step in range(int(level.max())):
            if step:
                more = level > step
                level, column, keyed = level[more], column[more], keyed[more]
            for at in _places(keyed, step, size):
                marks[at.astype(np.int64) * width + column] = True
        yield pa.RecordBatch.from_arrays(
            [_lists(id[docs]), _lists(keys[0][docs]), _lists(keys[1][docs]), _lists(length[docs]), pa.array([size], pa.int64()),
             pa.array([np.packbits(marks).tobytes()], pa.binary()), _lists(own.view(np.int64)), _lists(often)],
            names=["ids", "row1", "row2", "lengths", "bits", "slices", "terms", "counts"])
        own, often = own[:0], often[:0]


def _keyed(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Id, text and two hashes of both, which equal rows share."""
    number, content = F.col(f"`{id}`").cast("long"), F.col(f"`{text}`")
    return docs.select(number.alias("id"), content.alias("text"), F.xxhash64(content, number).alias("row1"),
                       F.xxhash64(number, F.lit(1), content).alias("row2")).filter("text IS NOT NULL")


def index(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """The signatures of all documents that have a term, in blocks, written in the shared folder.

    Ids are whole numbers. Every document is indexed by its whole text; the size of its signature follows from
    the number of its distinct terms, so that a long text is as well told apart as a short one.
    """
    spark = prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", 8 << 20):
                yield from blocks(part)

    path = work_dir(spark, "signatures")
    _keyed(docs, id, text).mapInArrow(run, INDEX).write.parquet(path)
    return spark.read.parquet(path)


@dataclass
class Queries:
    """A block of items: their terms with weights, and the figures of the corpus."""

    terms: list[bytes]
    keys: np.ndarray
    weights: np.ndarray
    items: list[Counter]  # places in ``terms``, with repeats
    documents: int
    words: int
    most: int

    def norms(self, lengths: np.ndarray | list[int]) -> np.ndarray:
        """m of documents of these lengths."""
        return np.array([75 + 25 * int(n) * self.documents // self.words for n in lengths], np.int64)

    def weighted(self) -> np.ndarray:
        """Weight of each term in each item."""
        out = np.zeros((len(self.items), len(self.terms)))
        for i, item in enumerate(self.items):
            for t, times in item.items():
                out[i, t] = self.weights[t] * times
        return out

    def bounds(self, weighted: np.ndarray, lengths: np.ndarray, bits: int, slices: bytes) -> np.ndarray:
        """What each item (rows) can score at most in each document of a block.

        All numbers are whole and far below 2 to the power of 53, so that sums of doubles are exact.
        """
        count = len(lengths)
        rows = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        norm = 12 * self.norms(lengths)
        out = np.zeros((len(self.items), count))
        for start in range(0, len(self.keys), SLAB):
            keys = self.keys[start:start + SLAB]
            at = np.arange(len(keys))
            level = np.zeros((len(keys), rows.shape[1] * 8), np.int64)
            before = np.full((len(keys), rows.shape[1]), 255, np.uint8)
            for step in range(len(LEVELS) - 1):
                here = before & np.bitwise_and.reduce(rows[_places(keys[at], step, bits).astype(np.int64)], axis=0)
                some = here.any(axis=1)
                at, before = at[some], here[some]
                if not len(at):
                    break
                level[at] += np.unpackbits(before, axis=1)
            level = level[:, :count]
            t, d = np.nonzero(level)
            most = LEVELS[level[t, d]] - 1
            impact = np.zeros(level.shape)
            impact[t, d] = (1_000_000_000 * most) // (1000 * most + norm[d])
            out += weighted[:, start:start + SLAB] @ impact
        return out

    def scores(self, text: str, wanted: list[int]) -> list[int]:
        """Exact scores of some items in one text."""
        found = Counter(TERMS.findall(text.encode("utf-8").lower()))
        norm = 12 * (75 + 25 * found.total() * self.documents // self.words)
        out, impact = [], {}
        for i in wanted:
            total = 0
            for t, times in self.items[i].items():
                if t not in impact:
                    often = found.get(self.terms[t], 0)
                    impact[t] = 1_000_000_000 * often // (1000 * often + norm)
                total += times * int(self.weights[t]) * impact[t]
            out.append(total)
        return out


def _arrays(batch: pa.RecordBatch, i: int) -> dict[str, np.ndarray]:
    return {name: batch.column(name)[i].values.to_numpy(zero_copy_only=False) for name in ("ids", "row1", "row2", "lengths")}


def _bounded(batches: Iterator[pa.RecordBatch], queries: Queries) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    weighted = queries.weighted()
    for batch in batches:
        for i in range(batch.num_rows):
            block = _arrays(batch, i)
            yield block, queries.bounds(weighted, block["lengths"], batch.column("bits")[i].as_py(), batch.column("slices")[i].as_buffer())


def _first_guess(found: DataFrame, queries: Queries) -> DataFrame:
    """For each item the documents of the highest bounds, equal ones by id: item, bound, id, row1, row2."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, most = len(queries.items), queries.most
        best = {"bound": np.zeros((count, 0)), **{k: np.zeros((count, 0), np.int64) for k in ("ids", "row1", "row2")}}
        for block, bounds in _bounded(batches, queries):
            # Documents of a block stand in the order of their ids.
            top = np.argsort(-bounds, axis=1, kind="stable")[:, :most]
            new = {"bound": np.take_along_axis(bounds, top, 1), **{k: block[k][top] for k in ("ids", "row1", "row2")}}
            both = {k: np.concatenate((best[k], new[k]), axis=1) for k in best}
            order = np.lexsort((both["ids"], -both["bound"]), axis=-1)[:, :most]
            best = {k: np.take_along_axis(v, order, 1) for k, v in both.items()}
        item, rank = np.nonzero(best["bound"])
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), *[pa.array(best[k][item, rank].astype(np.int64)) for k in ("bound", "ids", "row1", "row2")]],
            names=["item", "bound", "id", "row1", "row2"])

    order = Window.partitionBy("item").orderBy(F.desc("bound"), "id", "row1", "row2")
    return found.select("ids", "row1", "row2", "lengths", "bits", "slices").mapInArrow(
        run, "item long, bound long, id long, row1 long, row2 long").withColumn("rank", F.row_number().over(order)).filter(
        F.col("rank") <= queries.most).groupBy("row1", "row2").agg(F.collect_set("item").alias("items"))


def _reaching(found: DataFrame, queries: Queries, least: list[tuple[int, int]]) -> DataFrame:
    """Documents that the bounds do not exclude, with the items concerned: row1, row2, items.

    ``least`` has a score and an id for each item; documents of lower bounds, and of equal ones with a larger id, are out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score, id = (np.array(x, np.int64)[:, None] for x in zip(*least))
        for block, bounds in _bounded(batches, queries):
            reach = (bounds > score) | ((bounds == score) & (block["ids"][None, :] <= id))
            some = np.flatnonzero(reach.any(axis=0))
            doc, item = np.nonzero(reach[:, some].T)
            ends = np.searchsorted(doc, np.arange(len(some) + 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block["row1"][some]), pa.array(block["row2"][some]),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(item, pa.int64()))], names=["row1", "row2", "items"])

    return found.select("ids", "row1", "row2", "lengths", "bits", "slices").mapInArrow(
        run, "row1 long, row2 long, items array<long>").dropDuplicates(["row1", "row2"])


def _rescored(rows: DataFrame, wanted: DataFrame, queries: Queries) -> DataFrame:
    """The best exact scores of each task among the wanted pairs: item, id, score. Repeated rows count one by one."""
    spark = rows.sparkSession
    path = work_dir(spark, "candidates")
    wanted.write.parquet(path)  # its size is then known, and the join is planned by it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for batch in batches:
            for text, id, items in zip(*(batch.column(k) for k in ("text", "id", "items"))):
                items, number = items.as_py(), id.as_py()
                for item, score in zip(items, queries.scores(text.as_py(), items)):
                    if score > 0:
                        entry, heap = (score, -(int(LAST) if number is None else number)), best[item]
                        if len(heap) < queries.most:
                            heapq.heappush(heap, entry)
                        elif entry > heap[0]:
                            heapq.heapreplace(heap, entry)
        rows = [(item, -id, score) for item, heap in best.items() for score, id in heap]
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else ([], [], []))], names=["item", "id", "score"])

    return rows.join(spark.read.parquet(path), ["row1", "row2"]).select("id", "text", "items").mapInArrow(
        run, "item long, id long, score long")


def _ranked(scored: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), "id")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def _prepared(texts: list[str], found: DataFrame, documents: int, words: int, most: int) -> Queries:
    """The terms of a block of items with their weights."""
    counted = [Counter(TERMS.findall(text.encode("utf-8").lower())) for text in texts]
    terms = sorted(set().union(*counted))
    data = np.frombuffer(b"".join(terms), np.uint8)
    ends = np.cumsum([len(t) for t in terms])
    keys = hashes(data, ends - [len(t) for t in terms], ends)
    if len(np.unique(keys)) < len(keys):
        raise ValueError("two terms have one hash")
    asked = np.sort(keys.view(np.int64))

    def counted_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents that hold each of the terms, in one task."""
        held = np.zeros(len(asked), np.int64)
        for batch in batches:
            own, often = (batch.column(k).flatten().to_numpy(zero_copy_only=False) for k in ("terms", "counts"))
            at = np.minimum(np.searchsorted(asked, own), len(asked) - 1)
            some = asked[at] == own
            held += np.bincount(at[some], often[some], len(asked)).astype(np.int64)
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(asked[some]), pa.array(held[some])], names=["term", "n"])

    often = dict(found.filter(F.size("terms") > 0).select("terms", "counts").mapInArrow(counted_here, "term long, n long").groupBy(
        "term").agg(F.sum("n")).collect())
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * often.get(k, 0) + 1)))
                        for k in keys.view(np.int64).tolist()], np.int64)
    place = {t: i for i, t in enumerate(terms)}
    return Queries(terms, keys, weights, [Counter({place[t]: n for t, n in c.items()}) for c in counted], documents, words, most)


def _searched(rows: DataFrame, found: DataFrame, queries: Queries) -> DataFrame:
    """The best documents for each item of a block: item, rank, id, score."""
    guess = _rescored(rows, _first_guess(found, queries), queries)
    least = [(1, int(LAST))] * len(queries.items)
    for r in _ranked(guess, queries.most).filter(F.col("rank") == queries.most).collect():
        least[r.item] = (r.score, r.id)
    return _ranked(_rescored(rows, _reaching(found, queries, least), queries), queries.most)


def search(docs: DataFrame, items: DataFrame, most: int = 20, id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``most`` documents of the highest scores above 0 for each item: item_id, rank, doc id, score.

    A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))); a document adds for each term of the item, repeats
    included, the weight times 10^9 tf div (1000 tf + 12 m), m being 75 + 25 n N div L. Equal scores are in the
    order of ids, null ids last. Ids are whole numbers. Null and empty texts have no terms, are in no figure and no
    result; an item without a term, or whose terms no document has, gives no rows; so do empty tables.
    Repeated documents are documents of their own; an item repeated with the same id and text is
    answered once, and each text of an id by itself. Texts and items may be of any length. Other columns do not come out.

    Terms are looked up by 64-bit hashes in counting documents; scores compare the terms themselves.
    """
    spark = prepare(docs.sparkSession)
    shared_dir(spark)
    kind = items.schema[item_id].dataType.simpleString()
    empty = spark.createDataFrame([], f"`{item_id}` {kind}, rank int, `{id}` long, score long")
    asked = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").alias("text")).filter(
        F.col("text").rlike("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]")).distinct()
    size = asked.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    found = index(docs, id, text)
    total = found.agg(F.sum(F.size("ids")).alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("words")).first()
    if not size.n or not total.n:
        return empty
    parts = max(-(-size.n // ITEMS), -(-size.bytes // ITEM_BYTES))
    rows, path = _keyed(docs, id, text), work_dir(spark, "ranked")
    for part in range(parts):
        some = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        if not some:
            continue
        queries = _prepared([r.text for r in some], found, total.n, total.words, most)
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(some)], f"item long, item_id {kind}")
        _searched(rows, found, queries).join(names, "item").select(
            F.col("item_id").alias(item_id), "rank", F.when(F.col("id") != int(LAST), F.col("id")).alias(id), "score").write.mode("append").parquet(path)
    return spark.read.schema(empty.schema).parquet(path)
