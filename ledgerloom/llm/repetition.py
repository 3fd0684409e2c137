"""Repetition in texts: characters inside n-grams and lines that occur again.

Words, lines and n-grams are rolling 64-bit hashes in numpy over a whole Arrow batch; an
n-gram of n + 1 words continues the hash of the one of n words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm.text import WHITE, chunks, hashes, mixed, per_row, plain, prepare, repeated, spans, text_bytes

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

# Largest share of a text's characters in words that may lie inside n-grams of so many words
# that occur again, and largest share inside lines that are copies of earlier ones. One line that comes
# twice in a text of some hundred words is within the limits.
MOST_IN_NGRAMS = {5: 0.25, 6: 0.24, 7: 0.23, 8: 0.22, 9: 0.21, 10: 0.20}
MOST_IN_LINES = 0.30

_ROLL = np.uint64(0xD6E8FEB86659FD93)


def rolled(words: np.ndarray, row: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each n-gram size in order: first words of the n-grams inside one row, and their hashes."""
    key, n = mixed(row.astype(np.uint64) + np.uint64(1)), 0
    for size in sizes:
        while n < size:
            key = key[:max(0, len(words) - n)] * _ROLL + words[n:]
            n += 1
        first = np.flatnonzero(row[:len(key)] == row[n - 1:]) if len(key) else np.zeros(0, np.int64)
        yield size, first, mixed(key[first])


def covered(first: np.ndarray, size: int, words: int) -> np.ndarray:
    """Marks of the words inside n-grams that begin at ``first``."""
    steps = np.bincount(first, minlength=words + 1) - np.bincount(first + size, minlength=words + 1)
    return np.cumsum(steps[:words]) > 0


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    """Counts for each text of one Arrow array."""
    data, offsets = text_bytes(column)
    texts = len(offsets) - 1
    white = WHITE[data]
    letters = ~white & ((data & 0xC0) != 0x80)
    starts, ends, row = spans(~white, offsets)
    letters_before = np.concatenate(([0], np.cumsum(letters, dtype=np.int64)))
    chars = letters_before[ends] - letters_before[starts]
    out = {
        "n_words": np.bincount(row, minlength=texts), "word_chars": per_row(letters, offsets),
        "n_symbols": per_row(SYMBOLS[data], offsets),
    }
    # Lines end before a line feed or at the end of the row; an empty last line has no word.
    line_starts, line_ends, line_row = spans(data != 0x0A, offsets)
    words_before = np.searchsorted(starts, line_starts)
    has_word = np.searchsorted(starts, line_ends) > words_before
    line_starts, line_ends, line_row = line_starts[has_word], line_ends[has_word], line_row[has_word]
    keys = hashes(data, line_starts, line_ends) ^ mixed(line_row.astype(np.uint64) + np.uint64(1))
    _, copies = repeated(keys)
    out["n_dup_lines"] = np.bincount(line_row[copies], minlength=texts)
    out["dup_line_chars"] = np.bincount(
        line_row[copies], (letters_before[line_ends] - letters_before[line_starts])[copies], texts).astype(np.int64)
    words = hashes(data, starts, ends)
    for size, first, key in rolled(words, row, sorted(MOST_IN_NGRAMS)):
        again, _ = repeated(key)
        mark = covered(first[again], size, len(words))
        if size == 5:
            out["n_repeat_words"] = np.bincount(row[mark], minlength=texts)
        out[f"chars_in_{size}"] = np.bincount(row[mark], chars[mark], texts).astype(np.int64)
    return out


def verdicts(found: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Which texts fail the base rules, and which are kept by the coverage limits beyond them."""
    base = (found["n_words"] < 10) | (100 * found["n_repeat_words"] > 20 * found["n_words"])
    kept = ~base & (found["dup_line_chars"] <= MOST_IN_LINES * found["word_chars"])
    for size, most in MOST_IN_NGRAMS.items():
        kept &= found[f"chars_in_{size}"] <= most * found["word_chars"]
    return base, kept


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars",
          *[f"chars_in_{n}" for n in sorted(MOST_IN_NGRAMS)]]


def repetition(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Repetition counts and verdict of every whole text.

    Words are runs without blank, tab, line feed, vertical tab, form feed and return. ``chars_in_n``
    counts the characters of words inside n-grams of n words that occur twice or more in the
    text; ``dup_line_chars`` those in lines equal to an earlier one. One row per row of ``docs``,
    repeated rows and null ids included. A null or empty text has no words and fails the base
    rules. Other columns of ``docs`` do not come out.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found = measures(part.column("text"))
                base, kept = verdicts(found)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *[pa.array(found[c], pa.int64()) for c in COUNTS], pa.array(base), pa.array(kept)],
                    names=[id, *COUNTS, "base_failed", "kept"])

    rows = plain(docs, id, text).toDF("id", "text")
    return rows.mapInArrow(run, f"`{id}` {kind}, " + ", ".join(f"{c} long" for c in COUNTS)
                           + ", base_failed boolean, kept boolean")
