"""Near duplicates by Order MinHash and banded alignment.

A text is the sequence of its words in lower case. Of the runs of K words, labelled by their
occurrence in the text, each sketch takes the PICKED with the smallest hashes and keeps them in the
order of the text. Texts with an equal sketch are candidates: texts that share many runs in the
same order, as those do that differ by few edits. Sketches are sorted once; where texts of about
one length follow each other with an equal one, all are aligned with the first of them, their leader, so that pairs
grow with the texts and not with the square of a group. Those unlike their leader are sketched again by the runs
that the leader has not, and so on until none is left: a passage that many texts share does not hide what else they
share. A text loses runs in every round, so there is an end. Texts whose alignment has few enough edits are linked,
and linked texts form a class.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.skew import join_hot
from ledgerloom.llm.text import WHITE, chunks, hashes, mixed, prepare, spans, text_bytes
from ledgerloom.session import shared_dir, work_dir

K, PICKED, SKETCHES = 3, 2, 48
# Of the longer text's words at most this share may be inserted, deleted or replaced.
MOST_EDITS = 0.2
# What a text has beside its unlike leader is also sketched by so many single runs if it is less than this share.
LEFT, SINGLES = 0.25, 16

_SEEDS = np.random.default_rng(6).integers(1, 2**63, SKETCHES, dtype=np.uint64)
_ROLL = np.uint64(0xD6E8FEB86659FD93)
# Bytes other than white space that end or begin no word: ASCII punctuation.
_OTHER = WHITE.copy()
_OTHER[[b for b in range(128) if not chr(b).isalnum()]] = True


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of the words of each text and their rows. Case and ASCII punctuation do not count."""
    data, offsets = text_bytes(pc.utf8_lower(column))
    starts, ends, row = spans(~_OTHER[data], offsets)
    return hashes(data, starts, ends), row, len(offsets) - 1


def _occurrences(keys: np.ndarray) -> np.ndarray:
    """How many equal keys stand before each."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    place = np.arange(len(keys))
    out = np.empty(len(keys), np.int64)
    out[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return out


def _runs(words: np.ndarray, row: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labelled runs of K words in the order of the texts, their rows, and the number of words of each text.

    A text of fewer than K words is one run; one without words has none.
    """
    count = np.bincount(row, minlength=texts)
    size = np.minimum(count, K)
    first = np.arange(len(words)) - (np.cumsum(count) - count)[row]
    begins = np.flatnonzero(first <= (count - size)[row])
    key, length = np.zeros(len(begins), np.uint64), size[row[begins]]
    for k in range(K):
        more = length > k
        key[more] = key[more] * _ROLL + words[begins[more] + k]
    owner = row[begins]
    label = _occurrences(mixed(key) ^ mixed(owner.astype(np.uint64) + np.uint64(1)))
    return mixed(key + label.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), owner, count


def _sketch(key: np.ndarray, owner: np.ndarray, texts: int, salt: int = 0, count: int = PICKED) -> np.ndarray:
    """Sketches (rows by SKETCHES) of ``count`` runs of each text, zero for a text without runs."""
    out = np.zeros((texts, SKETCHES), np.uint64)
    if not len(key):
        return out
    heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    have = owner[heads]
    each = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(owner))))
    place = np.arange(len(key))
    seeds = mixed(_SEEDS + np.uint64(salt)) if salt else _SEEDS
    for s in range(SKETCHES):
        ranks = mixed(key ^ seeds[s])
        picked = []
        for _ in range(count):
            least = np.minimum.reduceat(ranks, heads)
            found = np.flatnonzero(ranks == least[each])  # a run more than once only if all are picked
            at = found[np.concatenate(([True], each[found][1:] != each[found][:-1]))]
            picked.append(at)
            ranks[at] = np.uint64(2**64 - 1)
        value = np.full(len(heads), s + 1, np.uint64)
        for at in np.sort(np.stack(picked), axis=0):
            value = mixed(value * _ROLL + key[at])
        out[have, s] = value
    return out


def sketches(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sketches of each text (rows by SKETCHES), two hashes of its word sequence, and its number of words."""
    words, row, texts = word_hashes(column)
    key, owner, count = _runs(words, row, texts)
    first = np.arange(len(words)) - (np.cumsum(count) - count)[row]
    sums = np.zeros((texts, 2), np.uint64)
    if len(words):
        heads = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        for i in (0, 1):
            placed = mixed(words ^ mixed(first.astype(np.uint64) * np.uint64(2) + np.uint64(i + 1)))
            sums[row[heads], i] = np.add.reduceat(placed, heads)
    return _sketch(key, owner, texts), sums[:, 0], sums[:, 1], count


def edits_within(a: np.ndarray, b: np.ndarray, most: int) -> bool:
    """Do at most ``most`` insertions, deletions and replacements turn one sequence into the other.

    The alignment matrix is filled row by row within the band that ``most`` edits can reach, each row
    in a few operations on whole numbers whose bits are the differences along the band. The band
    starts narrow and widens while it proves too narrow. Memory follows the lengths, as the places of a word are kept in
    stretches of STRETCH, only where it stands.
    """
    if abs(len(a) - len(b)) > most:
        return False
    if len(a) < len(b):
        a, b = b, a
    # Equal ends cost nothing.
    same = a[:len(b)] == b
    front = len(b) if same.all() else int(np.argmin(same))
    a, b = a[front:], b[front:]
    if len(b):
        same = a[::-1][:len(b)] == b[::-1]
        back = len(b) if same.all() else int(np.argmin(same))
        a, b = a[:len(a) - back], b[:len(b) - back]
    if not len(b):
        return len(a) <= most
    values, coded = np.unique(np.concatenate((a, b)), return_inverse=True)
    left, right = coded[:len(a)], coded[len(a):]
    # Words without a partner need an edit each.
    common = np.minimum(np.bincount(left, minlength=len(values)), np.bincount(right, minlength=len(values))).sum()
    if len(a) - common > most:
        return False
    left, right = left.tolist(), right.tolist()
    width = max(8, len(a) - len(b))
    while True:
        width = min(width, most)
        if _banded(left, right, width) <= width:
            return True
        if width == most:
            return False
        width *= 4


# Words up to which the places of a word are one number; places in a stretch beyond.
SHORT, STRETCH = 16_384, 1024


def _places(b: list[int]) -> Callable[[int, int], tuple[int, int]]:
    """Looks up at which places a word stands: the place of the lowest bit, and the bits."""
    places: dict[int, int] = {}
    for j, word in enumerate(b):
        places[word] = places.get(word, 0) | 1 << j
    get = places.get
    return lambda word, first: (0, get(word, 0))


def _places_in_stretches(b: list[int], width: int) -> Callable[[int, int], tuple[int, int]]:
    """As `_places`, for places from ``first`` over the band alone."""
    stretches: list[dict[int, bytes]] = []
    for start in range(0, len(b), STRETCH):
        own: dict[int, int] = {}
        for j, word in enumerate(b[start:start + STRETCH]):
            own[word] = own.get(word, 0) | 1 << j
        stretches.append({word: bits.to_bytes(STRETCH // 8, "little") for word, bits in own.items()})
    nothing = bytes(STRETCH // 8)

    def find(word: int, first: int) -> tuple[int, int]:
        low = max(0, first) // STRETCH
        high = min(len(stretches), (first + 2 * width) // STRETCH + 1)
        return low * STRETCH, int.from_bytes(b"".join([some.get(word, nothing) for some in stretches[low:high]]), "little")

    return find


def _banded(a: list[int], b: list[int], width: int) -> int:
    """Edit distance of two sequences if it is at most ``width``, else something larger.

    ``a`` is not shorter than ``b``. Step i holds the rows (places of ``b``) i - width to i + width of
    column i (places of ``a``), bit k being row i - width + k. ``plus`` and ``minus`` mark where the
    distance grows or falls by one from row to row, already moved to the next step's rows.
    """
    found_at = _places(b) if len(b) <= SHORT else _places_in_stretches(b, width)
    full, top = (1 << 2 * width + 1) - 1, 1 << 2 * width
    plus, minus = full ^ ((1 << width) - 1), 0
    # First the lower border of the band is followed down the diagonal, then the last row to its end.
    score, turn = min(width, len(b)), len(b) - width
    most = width + len(a) - turn  # the last row can take back one edit a column
    for i, word in enumerate(a):
        base, found = found_at(word, i - width)
        move = i - width - base
        equal = (found >> move if move > 0 else found << -move) & full
        diagonal = ((((equal & plus) + plus) ^ plus) | equal | minus) & full
        right = minus | (full ^ (diagonal | plus))
        left = diagonal & plus
        if i < turn:
            if not diagonal & top:
                score += 1
                if score > most:
                    return width + 1
        else:
            bit = len(b) - 1 - i + width
            score += (right >> bit & 1) - (left >> bit & 1)
        down = diagonal >> 1
        plus, minus = left | (full ^ (down | right)), down & right
    return score


FOUND = "row1 long, row2 long, text1 long, text2 long, words long, sketches array<long>"


def _sketched(docs: DataFrame, id: str, text: str) -> DataFrame:
    """A narrow row for each row: id, keys of the row and of its word sequence, words and sketches."""
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", 2 << 20):
                column = part.column("text")
                found, one, two, count = sketches(column)
                bare = np.flatnonzero(count == 0)
                if len(bare):  # without words the bytes themselves count
                    data, offsets = text_bytes(column.take(pa.array(bare)))
                    one[bare] = hashes(data, offsets[:-1], offsets[1:])
                    two[bare] = mixed(one[bare])
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("row1"), part.column("row2"),
                    pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(count, pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], np.cumsum(np.where(count > 0, SKETCHES, 0)))), pa.int32()),
                        pa.array(found[count > 0].reshape(-1).view(np.int64))),
                ], names=["id", "row1", "row2", "text1", "text2", "words", "sketches"])

    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").alias("text"), *row_keys(id, text))
    return rows.mapInArrow(run, f"id {kind}, {FOUND}")


def row_keys(id: str, text: str) -> list:
    """Two hashes of id and text, which equal rows share."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return [F.xxhash64(content, F.col(f"`{id}`")).alias("row1"),
            F.xxhash64(F.col(f"`{id}`"), F.lit(1), content).alias("row2")]


PAIRS = "node long, lead long, part long, key long, band long, words long"


def _led(rows: DataFrame) -> DataFrame:
    """Texts of an equal key with their leaders: node, lead, part; and the leaders that other partitions may have too (lead null).

    Rows (key, words, node, part) are dealt by ranges of key and node, so that a key that many texts have is
    dealt to several tasks, and pass by in order of key and length. Of the texts of a key the first of each of two
    staggered bands of lengths leads: two texts that few enough edits bridge are in one band of the two. ``part``
    tells what to compare further if the alignment fails; it is null where no third text has the key.
    """
    step = 2 * float(-np.log(1 - MOST_EDITS)) * (1 + 1e-9)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The first row's key, and for each system of bands the key, band and leader of the last row.
        first, last = None, [(None, None, None)] * 2
        for batch in batches:
            if not batch.num_rows:
                continue
            key, words, node, part = (batch.column(k).to_numpy() for k in ("key", "words", "node", "part"))
            begins = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            sizes = np.diff(np.append(begins, len(key)))
            each = np.repeat(np.arange(len(begins)), sizes)
            first = key[0] if first is None else first
            closed = np.ones(len(begins), bool)
            closed[[0, -1]] = False
            lone = (closed & (sizes == 2))[each]
            out = []
            for system in (0, 1):
                band = np.floor(np.log(words) / step + system / 2).astype(np.int64)
                new = np.concatenate(([True], (key[1:] != key[:-1]) | (band[1:] != band[:-1])))
                heads = np.flatnonzero(new)
                lead = node[heads]
                if (key[0], band[0]) == last[system][:2]:
                    lead[0] = last[system][2]
                    new[0] = False
                group = np.cumsum(np.concatenate(([True], new[1:]))) - 1
                last[system] = key[-1], band[-1], lead[-1]
                pair = node != lead[group]
                out.append(([node[pair], lead[group][pair], part[pair], key[pair], band[pair], words[pair]], lone[pair]))
                # Leaders of the first key and of the last key so far.
                edge = new & ((key == first) | (key == key[-1]))
                yield _pairs([node[edge], None, part[edge], key[edge], band[edge] * 2 + system, words[edge]], None)
            for columns, alone in out:
                yield _pairs(columns, alone)

    return rows.repartitionByRange("key", "node").sortWithinPartitions("key", "words", "node").mapInArrow(run, PAIRS)


def _pairs(columns: list[np.ndarray | None], alone: np.ndarray | None) -> pa.RecordBatch:
    size = len(columns[0])
    arrays = [pa.nulls(size, pa.int64()) if x is None else pa.array(x, pa.int64()) for x in columns]
    if alone is not None:
        arrays[2] = pa.array(columns[2], pa.int64(), mask=alone)
    return pa.RecordBatch.from_arrays(arrays, names=["node", "lead", "part", "key", "band", "words"])


def _candidates(texts: DataFrame) -> DataFrame:
    """Distinct pairs (node, lead, part) to align, of texts that share a sketch."""
    part = F.col("part") if "part" in texts.columns else F.lit(0).cast("long").alias("part")
    rows = texts.filter("words > 0").select("node", "words", part, F.explode(F.array_distinct("sketches")).alias("key"))
    found = _stored(_led(rows), "led")
    # A key that goes on in the next partition has a leader in each: they meet here.
    order = Window.partitionBy("key", "band").orderBy("words", "node")
    heads = found.filter("lead IS NULL").withColumn("lead", F.first("node").over(order)).filter("node != lead")
    return found.filter("lead IS NOT NULL").select("node", "lead", "part").unionByName(
        heads.select("node", "lead", "part")).groupBy("node", "lead").agg(F.min("part").alias("part"))


def _stored(rows: DataFrame, name: str) -> DataFrame:
    path = work_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


JUDGED = "node long, lead long, linked boolean, rest binary"


def _judged(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (node, lead) whose texts align with few enough edits; and of the others ``rest``, a bit for each run of the text that the leader has not.

    ``texts`` has (node, text). A pair that fails and has no ``part`` is not told, as no third text is concerned.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in chunks(batch, "text", 1 << 20):
                sides = []
                for name in ("text", "other"):
                    words, row, count = word_hashes(some.column(name))
                    borders = np.searchsorted(row, np.arange(count + 1))
                    sides.append([words[x:y] for x, y in zip(borders, borders[1:])])
                linked = np.array([edits_within(a, b, int(MOST_EDITS * max(len(a), len(b)) + 1e-9)) for a, b in zip(*sides)], bool)
                further = ~linked & pc.is_valid(some.column("part")).to_numpy(zero_copy_only=False)
                marks = [None] * len(linked)
                for i in np.flatnonzero(further).tolist():
                    whole, other = (_runs(x[i], np.zeros(len(x[i]), np.int64), 1)[0] for x in sides)
                    marks[i] = np.packbits(~np.isin(whole, other)).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [some.column("node"), some.column("lead"), pa.array(linked), pa.array(marks, pa.binary())],
                    names=["node", "lead", "linked", "rest"]).filter(pa.array(linked | further))

    others = texts.select(F.col("node").alias("lead"), F.col("text").alias("other"))
    return pairs.join(texts, "node").join(others, "lead").select("node", "lead", "part", "text", "other").mapInArrow(run, JUDGED)


def _further(left: DataFrame, texts: DataFrame, salt: int) -> DataFrame:
    """What is left to compare of each text: node, words, sketches, rest, part.

    ``left`` has (node, rests): the runs that count are those that none of the unlike leaders so far has. Texts without
    such a run are done. However many leaders a text was unlike, it goes on as one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in chunks(batch, "text", 1 << 20):
                words, row, count = word_hashes(some.column("text"))
                key, owner, length = _runs(words, row, count)
                borders, own = np.searchsorted(owner, np.arange(count + 1)), np.ones(len(key), bool)
                for i, rests in enumerate(some.column("rests")):
                    for rest in rests.as_py():
                        own[borders[i]:borders[i + 1]] &= np.unpackbits(
                            np.frombuffer(rest, np.uint8), count=borders[i + 1] - borders[i]).view(bool)
                mine = np.bincount(owner[own], minlength=count)
                found = _sketch(key[own], owner[own], count, salt)
                little = mine < LEFT * np.diff(borders)
                more = np.where(little[:, None], _sketch(key[own], owner[own], count, salt + 1, 1)[:, :SINGLES], found[:, :SINGLES])
                found = np.concatenate((found, more), axis=1)
                going = np.flatnonzero(mine)
                marks = [np.packbits(own[borders[i]:borders[i + 1]]).tobytes() for i in going.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column("node").take(pa.array(going)), pa.array(length[going], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.arange(len(going) + 1) * found.shape[1], pa.int32()), pa.array(found[going].reshape(-1).view(np.int64))),
                     pa.array(marks, pa.binary())], names=["node", "words", "sketches", "rest"])

    return left.join(texts, "node").select("node", "text", "rests").mapInArrow(
        run, "node long, words long, sketches array<long>, rest binary").withColumn("part", F.col("node"))


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Verified pairs (node, lead): of ``pairs``, and of the texts that proved unlike their leaders.

    These are sketched again by what their leaders have not, and led by that, until no text has an unlike leader.
    """
    judged, salt = _stored(_judged(pairs, texts), "judged"), 1
    links = judged.filter("linked").select("node", "lead")
    unlike, kept, before = judged.filter("NOT linked").select("node", "rest"), None, None
    while not unlike.isEmpty():
        if kept is None:
            kept = _stored(texts.join(unlike.select("node").distinct(), "node"), "unlike")
        if before is not None:  # what earlier leaders have does not come back
            unlike = unlike.unionByName(before.join(unlike.select("node").distinct(), "node", "left_semi"))
        rests = unlike.groupBy("node").agg(F.collect_set("rest").alias("rests"))
        salt += 2
        left = _stored(_further(rests, kept, salt), "left")
        # Stored, the pairs have a size by which the join with texts is planned: the last rounds have few.
        pairs = _stored(_candidates(left), "pairs")
        judged = _stored(_judged(pairs, kept), "judged")
        links = links.unionByName(judged.filter("linked").select("node", "lead"))
        unlike, before = judged.filter("NOT linked").select("node", "rest"), left.select("node", "rest")
    return links.distinct()


def components(links: DataFrame) -> DataFrame:
    """The least node of the component (root) of every node of ``links`` (node, lead).

    Alternates two steps until nothing changes: every node hands its least neighbour to its larger
    ones, then to its smaller ones. Each step takes a minimum per node, summed up before the shuffle.
    """
    links = links.select(F.greatest("node", "lead").alias("node"), F.least("node", "lead").alias("lead")).checkpoint()
    before = None
    while True:
        both = links.unionByName(links.select(F.col("lead").alias("node"), F.col("node").alias("lead")))
        least = both.groupBy("node").agg(F.min("lead").alias("least")).select(
            "node", F.least("node", "least").alias("least"))
        hooked = join_hot(both.filter("lead > node"), least, ["node"], "inner").select(
            F.col("lead").alias("node"), F.col("least").alias("lead")).filter("node != lead").distinct()
        least = hooked.groupBy("node").agg(F.min("lead").alias("least"))
        step = join_hot(hooked, least, ["node"], "inner")
        links = step.select(F.col("lead").alias("node"), F.col("least").alias("lead")).unionByName(
            step.select("node", F.col("least").alias("lead"))).filter("node != lead").distinct().checkpoint()
        state = links.agg(F.count("*"), F.sum(F.xxhash64("node", "lead").cast("decimal(38,0)"))).first()
        if state == before:
            return links.select("node", F.col("lead").alias("root"))
        before = state


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, row1, row2, first, links) of every row of ``docs``: ``first`` is the least (id, row1, row2) of its class."""
    shared_dir(prepare(docs.sparkSession))
    found = _stored(_sketched(docs, id, text).withColumn("place", F.monotonically_increasing_id()), "sketches")
    # Repeated rows are counted first, so that only where there are any one has to be picked.
    rows = found.groupBy("text1", "text2", "id", "row1", "row2").agg(F.count("*").alias("copies"), F.min("place").alias("node"))
    first = F.struct(F.col("id").isNull().alias("bare"), "id", "row1", "row2", "copies", "node")
    nodes = _stored(rows.groupBy("text1", "text2").agg(F.min(first).alias("first")).withColumn("node", F.col("first.node")), "nodes")
    sketched = found.select(F.col("place").alias("node"), "words", "sketches").join(nodes.select("node"), "node")
    pairs = _stored(_candidates(sketched), "pairs")
    wanted = _stored(pairs.select("node").union(pairs.select("lead")).distinct().join(
        nodes.select("node", "first.row1", "first.row2", "first.copies"), "node"), "wanted")
    # One row has the text of a node. Rows wanted grow with the corpus: they are never broadcast, small as they may be in a test.
    rows = docs.select(*row_keys(id, text), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).join(
        wanted.hint("merge"), ["row1", "row2"])
    texts = _stored(rows.filter("copies = 1").select("node", "text").unionByName(
        rows.filter("copies > 1").dropDuplicates(["node"]).select("node", "text")), "texts")
    links = _stored(_verified(pairs, texts), "links")
    roots = components(links)
    degrees = links.select(F.explode(F.array("node", "lead")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    placed = nodes.select("node", "text1", "text2", "first").join(roots, "node", "left").join(degrees, "node", "left").select(
        F.coalesce("root", "node").alias("root"), "text1", "text2", "first", F.coalesce("links", F.lit(0)).alias("links"))
    leaders = placed.groupBy("root").agg(F.min("first").alias("first"))
    placed = join_hot(placed.drop("first"), leaders, ["root"], "inner").select("text1", "text2", "first", "links")
    return join_hot(found.select("id", "row1", "row2", "text1", "text2"), placed, ["text1", "text2"], "inner").select(
        "id", "row1", "row2", "first", "links")


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Class and number of links of every row: id, class_id, n_links.

    ``class_id`` is the least id of the rows of a class (null if all are null), ``n_links`` the verified
    links of the row's word sequence with others. Rows with equal word sequences are in one class
    without a link; texts without words only if their bytes are equal, a null text being empty.
    One row per row of ``docs``, repeated rows and null ids included; no rows give none. Other columns do not come out.
    Texts may be of any length: an alignment holds two, and bits for the places of their words.
    """
    return classes(docs, id, text).select(
        F.col("id").alias(id), F.col("first.id").alias("class_id"), F.col("links").alias("n_links"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that of the least id, with all columns of ``docs``; of repeated rows one stays."""
    firsts = classes(docs, id, text).filter("row1 = first.row1 AND row2 = first.row2").groupBy("row1", "row2").agg(
        F.count("*").alias("near/copies")).checkpoint()
    one, two = row_keys(id, text)
    rows = docs.withColumns({"near/row1": one, "near/row2": two}).join(
        firsts.withColumnsRenamed({"row1": "near/row1", "row2": "near/row2"}), ["near/row1", "near/row2"])
    single = rows.filter("`near/copies` = 1")
    several = rows.filter("`near/copies` > 1").dropDuplicates(["near/row1", "near/row2"])
    return single.unionByName(several).select(*[F.col(f"`{c}`") for c in docs.columns])
