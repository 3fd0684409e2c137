"""Token counts of a byte-pair vocabulary with word ends.

Each word is merged with a heap of adjacent pairs over a linked list of symbols; the
count is the number of symbols minus the number of merges, and no identifier is made.
"""

from __future__ import annotations

import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ledgerloom.llm.text import chunks, plain, prepare

# Words whose counts a worker remembers; then it starts anew.
REMEMBERED = 1_000_000


def merges(symbols: list[int], pairs: dict[int, tuple[int, int]]) -> int:
    """How many pairs merge: always the pair of lowest rank, of equal ones the leftmost.

    ``pairs`` has the rank and the merged symbol at ``left << 20 | right``. The heap holds
    ``rank << 32 | place``; an entry whose pair has merged meanwhile is passed over.
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
            heap.append(found[0] << 32 | i - 1)
        left = right
    heapify(heap)
    done = 0
    while heap:
        top = heappop(heap)
        i = top & 0xFFFFFFFF
        j = after[i]
        if j >= end or not (found := get(symbols[i] << 20 | symbols[j])) or found[0] != top >> 32:
            continue
        done += 1
        symbols[i] = joined = found[1]
        symbols[j] = 0xFFFFF  # no symbol: pairs with it are never found
        after[i] = k = after[j]
        if k < end:
            before[k] = i
            if found := get(joined << 20 | symbols[k]):
                heappush(heap, found[0] << 32 | i)
        h = before[i]
        if h >= 0 and (found := get(symbols[h] << 20 | joined)):
            heappush(heap, found[0] << 32 | h)
    return done


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters, more = {b: chr(b) for b in shown}, 0x100
    for b in range(256):
        if b not in letters:
            letters[b], more = chr(more), more + 1
    return [letters[b] for b in range(256)]


class Vocabulary:
    """The rules of a tokenizer file of this kind: special strings, word pattern and merge ranks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        kinds = [x["type"] for x in rules["normalizer"]["normalizers"]], [
            x["type"] for x in rules["pre_tokenizer"]["pretokenizers"]]
        if kinds != (["NFC", "Replace", "Lowercase"], ["Split", "ByteLevel"]):
            raise ValueError(f"not a vocabulary of lower-case words: {kinds}")
        names = {name: i for i, name in enumerate(rules["model"]["vocab"])}
        merged = [m.split(" ") if isinstance(m, str) else m for m in rules["model"]["merges"]]
        self.pairs = {names[a] << 20 | names[b]: (rank, names[a + b]) for rank, (a, b) in enumerate(merged)}
        letters, suffix = byte_letters(), rules["model"]["end_of_word_suffix"]
        self.inner, self.final = [names[c] for c in letters], [names[c + suffix] for c in letters]
        self.special = regex.compile("|".join(regex.escape(x["content"]) for x in rules["added_tokens"]))
        # White space as the pattern library of these files has it, without the separators 1C to 1F.
        self.word = regex.compile(rules["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(
            r"\s", r"\p{White_Space}"))
        self.space = regex.compile(r"\p{White_Space}+")
        self.known: dict[str, int] = {}

    def word_tokens(self, word: str) -> int:
        data = word.encode("utf-8")
        symbols = [self.inner[b] for b in data]
        symbols[-1] = self.final[data[-1]]
        return len(symbols) - merges(symbols, self.pairs)

    def count(self, text: str) -> int:
        """Tokens of one text; a special string counts as one."""
        pieces = self.special.split(text)
        total = len(pieces) - 1
        known = self.known
        for piece in pieces:
            if not piece.isascii():
                # Lower case letter by letter: a sigma does not depend on what follows.
                piece = self.space.sub(" ", unicodedata.normalize("NFC", piece)).replace("Σ", "σ")
            # What stands between two spaces is counted once for all its occurrences.
            for part, times in Counter(piece.lower().split(" ")).items():
                n = known.get(part)
                if n is None:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    n = known[part] = sum(map(self.word_tokens, self.word.findall(part)))
                total += n * times
        return total


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 2048, id: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """Bytes and tokens of every whole text, and whether it has more than ``limit`` tokens.

    One row per row of ``docs``, repeated rows and null ids included. A null text is empty: no
    bytes, no tokens. Other columns of ``docs`` do not come out, so their names cannot clash.
    ``vocabulary`` is a path that every executor has.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id].dataType

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rules = Vocabulary(vocabulary)
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                tokens = [rules.count(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_()),
                ], names=[id, "n_bytes", "n_tokens", "over_limit"])

    rows = plain(docs, id, text).toDF("id", "text")
    return rows.mapInArrow(
        count, f"`{id}` {kind.simpleString()}, n_bytes long, n_tokens long, over_limit boolean")
