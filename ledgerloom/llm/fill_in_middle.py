"""Fill-in-the-middle transformation of whole texts.

A text is cut into units (lines by default). One full match of ``(unit)*`` keeps every repetition
of the group, so that the ends of its captures are the places of all cuts: their number is n, and the
two cuts are looked up in them. Where a text is cut, and into which form it is put, follows from a
digest of its id alone, so a task that runs again gives the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.text import chunks, plain, prepare

LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = regex.compile("<[PSM]>")


@dataclass(frozen=True)
class Plan:
    """How texts are cut: the seed of the digests, shares (in hundredths) put into a form, and of these into ``spm``."""

    seed: str = "7"
    rate: int = 100
    spm_rate: int = 50
    unit: str = LINES


def draws(seed: str, id: object) -> list[int]:
    """Four 32-bit numbers from the seed and the decimal id; a null id counts as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if id is None else id}".encode()).hexdigest()
    return [int(digest[k:k + 8], 16) for k in (0, 8, 16, 24)]


def transform(text: str, id: object, plan: Plan, units: regex.Pattern) -> tuple[int, str, int | None, int | None, str]:
    """Number of units, form, letters of prefix and middle, and output of one text."""
    found = units.fullmatch(text)
    if found is None:
        raise ValueError("the units do not cover the text")
    ends = found.ends(1)
    n = len(ends)
    one, two, form, order = draws(plan.seed, id)
    if not text or MARK.search(text) or form % 100 >= plan.rate:
        return n, "plain", None, None, text
    first, second = sorted((one % (n + 1), two % (n + 1)))
    front, back = (ends[k - 1] if k else 0 for k in (first, second))
    prefix, middle, suffix = text[:front], text[front:back], text[back:]
    if order % 100 < plan.spm_rate:
        form, out = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, out = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return n, form, front, back - front, out


def fill_in_middle(docs: DataFrame, plan: Plan = Plan(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every whole text in its form: id, n, form (plain, psm or spm), prefix_chars, middle_chars, output.

    ``n`` counts the units of the text, the lengths are in code points and null where the form is
    plain: for empty texts, for those that contain a mark, and for the share that the plan leaves
    alone. One row per row of ``docs``; repeated rows come out alike, as the cuts hang on the id. A null
    text is empty. A null id draws as one without digits. Texts may be as long as Spark's strings; a batch
    holds a bounded number of bytes, or one text. No rows give no rows. Other columns of ``docs``,
    whatever their names, do not come out.
    """
    prepare(docs.sparkSession)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({plan.unit})*")
        for batch in batches:
            for part in chunks(batch, "text"):
                rows = [transform(t or "", i, plan, units) for t, i in zip(part.column("text").to_pylist(), part.column("id").to_pylist())]
                n, form, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
                     pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    names=[id, "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = plain(docs, id, text).toDF("id", "text")
    return rows.mapInArrow(run, f"`{id}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of.

    A text in a form other than plain contains no mark, and no mark can begin inside another, so the
    marks of an output are the three that were put there.
    """
    part = F.split(output, MARK.pattern, -1)
    return (F.when(form == "psm", F.concat(part[1], part[3], part[2]))
            .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output))


def digests(docs: DataFrame, plan: Plan = Plan(), id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``fill_in_middle``, with SHA-256 digests of the output and of the text rebuilt from it in place of the output."""
    def digest(column: Column) -> Column:
        return F.sha2(column.cast("binary"), 256)

    return fill_in_middle(docs, plan, id, text).select(
        f"`{id}`", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))
