"""Encoding and decoding with a SentencePiece vocabulary of the merge type.

A text is encoded with an agenda of adjacent symbol pairs ordered by score. The pieces of
such a vocabulary have spaces only in front, so a text falls into segments (spaces and what
follows them) that no merge can cross; each distinct segment that a worker meets is encoded once, and
the library encodes and decodes the same segments as a check. Vocabulary and segments stay in a worker from task to task.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from sentencepiece import SentencePieceProcessor

from ledgerloom.llm.text import chunks, plain, prepare

SPACE = "▁"
START = "\ud800"  # in no UTF-8 text
# Letters of the segments whose ids a worker remembers; then it starts anew. Longer segments are not remembered.
REMEMBERED, LONGEST = 6_000_000, 64
# Segments of up to so many letters are encoded together with others of their length.
FEW = 48
NO_RANK = np.int64(1 << 40)


def agenda(symbols: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """Merge the adjacent pair of the best score, of equal ones the leftmost, until none is left.

    ``pairs`` has the rank by score and the merged symbol at ``left << 20 | right``. The agenda
    holds ``rank << 52 | place << 20 | merged``; an entry whose pair has changed is passed over.
    """
    symbols = list(symbols)
    end = len(symbols)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    get = pairs.get
    heap = []
    left = symbols[0]
    for i in range(1, end):
        right = symbols[i]
        if found := get(left << 20 | right):
            heap.append(found[0] << 52 | i - 1 << 20 | found[1])
        left = right
    heapify(heap)
    while heap:
        top = heappop(heap)
        i, joined = top >> 20 & 0xFFFFFFFF, top & 0xFFFFF
        j = after[i]
        if j >= end or not (found := get(symbols[i] << 20 | symbols[j])) or found[1] != joined:
            continue
        symbols[i], symbols[j] = joined, GONE
        after[i] = k = after[j]
        if k < end:
            before[k] = i
            if found := get(joined << 20 | symbols[k]):
                heappush(heap, found[0] << 52 | i << 20 | found[1])
        h = before[i]
        if h >= 0 and (found := get(symbols[h] << 20 | joined)):
            heappush(heap, found[0] << 52 | h << 20 | found[1])
    return [s for s in symbols if s != GONE]


GONE = 0xFFFFF


class PairTable:
    """The pairs of a vocabulary for lookups of whole arrays: open addressing in a table that is mostly empty."""

    def __init__(self, pairs: dict[int, tuple[int, int]]):
        self.bits = max(8, (8 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.keys, self.ranks, self.joined = np.full(size, -1, np.int64), np.full(size, NO_RANK), np.zeros(size, np.int64)
        keys = np.fromiter(pairs, np.int64, len(pairs))
        values = np.array(list(pairs.values()), np.int64).reshape(-1, 2)
        place = self._place(keys)
        while len(keys):
            # Of the pairs that meet in a free slot one stays there, the others go on.
            free = self.keys[place] == -1
            self.keys[place[free]] = keys[free]
            stays = self.keys[place] == keys
            self.ranks[place[stays]], self.joined[place[stays]] = values[stays, 0], values[stays, 1]
            keys, values, place = keys[~stays], values[~stays], (place[~stays] + 1) & (size - 1)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NO_RANK where there is none) and merged symbol of each pair."""
        keys = left << 20 | right
        place = self._place(keys)
        there = self.keys[place]
        while (on := np.flatnonzero((there != keys) & (there != -1))).size:
            place[on] = (place[on] + 1) & (len(self.keys) - 1)
            there[on] = self.keys[place[on]]
        return self.ranks[place], self.joined[place]


def agendas(symbols: np.ndarray, table: PairTable) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """As `agenda`, for segments of one length (rows), step by step together: rows that are done, and their symbols.

    The agenda of a segment is its row of ranks; in each step every segment takes its least, the leftmost of equal ones.
    """
    rows = np.arange(len(symbols))
    ranks, joined = (x.reshape(len(rows), symbols.shape[1] - 1) for x in table.find(symbols[:, :-1].ravel(), symbols[:, 1:].ravel()))
    while len(rows):
        size = ranks.shape[1]
        going = ranks.min(axis=1) != NO_RANK if size else np.zeros(len(rows), bool)
        if not going.all():
            yield rows[~going], symbols[~going]
            rows, symbols, ranks, joined = rows[going], symbols[going], ranks[going], joined[going]
            if not len(rows):
                return
        at, each = ranks.argmin(axis=1), np.arange(len(rows))
        merged = joined[each, at]
        left = np.arange(size)
        symbols = np.take_along_axis(symbols, left + (left > at[:, None]), axis=1)
        symbols[each, at] = merged
        left = np.arange(size - 1)
        kept = left + (left >= at[:, None])
        ranks, joined = np.take_along_axis(ranks, kept, axis=1), np.take_along_axis(joined, kept, axis=1)
        for some, where in ((at > 0, at - 1), (at < size - 1, at)):
            row, where = each[some], where[some]
            ranks[row, where], joined[row, where] = table.find(symbols[row, where], symbols[row, where + 1])


class Pieces:
    """A vocabulary, its encoder and the library's one beside it."""

    def __init__(self, path: str):
        self.library = library = SentencePieceProcessor(model_file=path)
        self.size = size = library.vocab_size()
        ids = {library.id_to_piece(i): i for i in range(size) if not (
            library.is_byte(i) or library.is_control(i) or library.is_unknown(i))}
        first = [i for i in range(size) if library.is_byte(i)]
        if len(first) != 256 or SPACE not in ids or any(
                regex.search(f"[^{SPACE}]{SPACE}|.\n|\n.", piece, regex.DOTALL) for piece in ids):
            raise ValueError("needs a vocabulary with byte pieces and spaces in front of pieces only")
        self.bytes = {int(library.id_to_piece(i)[3:5], 16): i for i in first}
        self.space = ids[SPACE]
        # Letters that are no piece but part of one get symbols of their own above the ids.
        self.symbols = dict(ids)
        for letter in sorted(set("".join(ids)) - set(ids)):
            self.symbols[letter] = size + len(self.symbols) - len(ids)
        self.strange = size + len(self.symbols)
        self.symbols["\n"] = ids.get("\n", self.bytes[10])
        scores = {i: library.get_score(i) for i in ids.values()}
        rank = {score: k for k, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self.pairs = {}
        for piece, i in ids.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    self.pairs[left << 20 | right] = rank[scores[i]], i
        self.table = PairTable(self.pairs)
        self.letter = np.full(0x110000, -1, np.int64)
        for symbol, i in self.symbols.items():
            if len(symbol) == 1 and i < size:
                self.letter[ord(symbol)] = i
        self.segment = regex.compile(f"{SPACE}+[^{SPACE}\n]*|\n?[^{SPACE}\n]+|\n")
        # Ids of segments as decimals with commas.
        self.known: dict[str, str] = {}
        self.names = [str(i) for i in range(size)]
        self.letters = 0

    def segments(self, text: str) -> tuple[list[str], str]:
        """Segments of a text as the library normalises it, and what they decode to.

        A segment is a run of spaces or a line feed and what follows up to the next; no piece
        goes across. One space in front is left out of the segment.
        """
        text = self.library.normalize(text)
        decoded = text.replace(SPACE, " ").removeprefix(" ")
        if "\n" in text:
            text = text.replace("\n", SPACE + "\n")
        found = text.split(SPACE)
        if found[0] == "" and "" not in found[1:]:
            return found[1:], decoded
        text = text.replace(SPACE + "\n", "\n")
        return [s[1:] if s[0] == SPACE else s if s[0] == "\n" else START + s for s in self.segment.findall(text)], decoded

    def encode_segments(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments: of those of usual letters for each length together, of others one by one."""
        out: list = [None] * len(segments)
        by_length: dict[int, list[int]] = defaultdict(list)
        for i, segment in enumerate(segments):
            by_length[len(segment) if segment[:1] != START else 0].append(i)
        for length, places in by_length.items():
            if 0 < length <= FEW:
                text = "".join([segments[i] for i in places])
                symbols = self.letter[np.frombuffer(text.encode("utf-32-le"), np.uint32)].reshape(-1, length)
                usual = (symbols >= 0).all(axis=1)
                places = np.array(places)
                # After a line feed no space stands in front.
                for spaced in (True, False):
                    some = usual & ((symbols[:, 0] != self.symbols["\n"]) == spaced)
                    own, mine = symbols[some], places[some]
                    if spaced:
                        own = np.concatenate((np.full((len(own), 1), self.space), own), axis=1)
                    for rows, ids in agendas(own, self.table):
                        for i, row in zip(mine[rows].tolist(), ids.tolist()):
                            out[i] = row
                places = places[~usual].tolist()
            for i in places:
                out[i] = self.encode_segment(segments[i])
        return out

    def encode_segment(self, segment: str) -> list[int]:
        """Ids of a segment: after a line feed, at the start without a space (marked by START), or after one space."""
        if segment[:1] == START:
            segment = segment[1:]
        elif segment[:1] != "\n":
            segment = SPACE + segment
        get, size = self.symbols.get, self.size
        symbols = [get(c, -1) for c in segment]
        if -1 in symbols or max(symbols) >= size:
            return self._with_bytes(segment)
        return agenda(symbols, self.pairs)

    def _with_bytes(self, segment: str) -> list[int]:
        """Letters that are in no piece, or left over without being one, become the pieces of their bytes."""
        symbols, letters = [], {}
        for c in segment:
            symbol = self.symbols.get(c)
            if symbol is None:
                symbol = self.strange + len(letters)
            if symbol >= self.size:
                letters[symbol] = c
            symbols.append(symbol)
        out: list[int] = []
        for symbol in agenda(symbols, self.pairs):
            if symbol in letters:
                out.extend(self.bytes[b] for b in letters[symbol].encode("utf-8"))
            else:
                out.append(symbol)
        return out

    def learn(self, segments: set[str]) -> list[str]:
        """Know the ids of segments, those not met before held against the library. Returns the new ones."""
        if self.letters > REMEMBERED:
            self.known, self.letters = {}, 0
        known, names = self.known, self.names
        new = [s for s in segments if s not in known]
        if not new:
            return new
        plain = [s.lstrip(START) for s in new]
        own = self.encode_segments(new)
        theirs, decoded = self.library.encode(plain, num_threads=1), self.library.decode(own, num_threads=1)
        for segment, text, mine, ids, back in zip(new, plain, own, theirs, decoded):
            if mine != ids and not self._agrees(segment, mine, ids) or back != text and back != text.replace(SPACE, " "):
                raise ValueError(f"encoding differs from the library: {segment!r} {mine} {ids} {back!r}")
            known[segment] = ",".join([names[i] for i in mine])
        self.letters += sum(map(len, new))
        return new

    def _agrees(self, segment: str, mine: list[int], ids: list[int]) -> bool:
        """The library puts a space in front, which a segment after a line feed does not have; by itself it has none."""
        return segment[:1] in ("", START) or segment[:1] == "\n" and [self.space, *mine] == ids

    def encode(self, texts: list[str]) -> list[tuple[str, str]]:
        """Ids of each text as decimals with commas, and the text they decode to."""
        split = [self.segments(text) for text in texts]
        new, known = self.learn(set(chain.from_iterable([segments for segments, _ in split]))), self.known
        out = [(",".join([known[s] for s in segments]), decoded) for segments, decoded in split]
        for segment in [s for s in new if len(s) > LONGEST]:
            del known[segment]
            self.letters -= len(segment)
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Pieces:
    """One vocabulary of each path in a worker."""
    return Pieces(path)


def hexdigest(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def encode(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids of every whole text and the text they decode to: id, ids array<int>, decoded string.

    One row per row of ``docs``, repeated rows and null ids included. A null text is empty and has
    no ids; no rows give no rows. Other columns of ``docs``, whatever their names, do not come out. ``model`` is a path that
    every executor has. A segment that the library encodes otherwise ends the job. A text may be of any length;
    a worker holds one and its symbols at a time, and remembers short segments only, up to a number of letters.
    """
    return _encoded(docs, model, id, text, digests=False)


def encode_digests(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode``, with n_tokens and SHA-256 digests instead of ids and text."""
    return _encoded(docs, model, id, text, digests=True)


def _encoded(docs: DataFrame, model: str, id: str, text: str, digests: bool) -> DataFrame:
    prepare(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = vocabulary(model)
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                found = pieces.encode([t or "" for t in part.column("text").to_pylist()])
                if digests:
                    columns = [pa.array([ids.count(",") + 1 if ids else 0 for ids, _ in found], pa.int64()),
                               *[pa.array([hexdigest(x) for x in some], pa.string()) for some in zip(*found)]]
                else:
                    ids, decoded = zip(*found)
                    columns = [pa.array([list(map(int, x.split(","))) if x else [] for x in ids], pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                labels = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], names=[id, *labels])

    rows = plain(docs, id, text).toDF("id", "text")
    return rows.mapInArrow(run, f"`{id}` {kind}, " + (
        "n_tokens long, ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string"))
