"""Quality filter: perplexity under a Kneser-Ney model of trusted text, held against quantiles per language."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import ngram
from ledgerloom.llm.text import chunks, likely, plain, prepare
from ledgerloom.session import shared_dir

# Bytes of an n-gram, which runs on over blanks. Those of six saturate: 0.77 million in 60 MB of trusted text.
ORDER = 6
# A text of few bytes is drawn to the ordinary bits per byte as if it had so many more.
STEADY_BYTES = 100
# One in so many ids is kept out of training and sets the thresholds.
HELD_OUT = 10
# Texts pass up to this quantile of trusted texts of their language, and this much beyond it.
QUANTILE, MARGIN = 0.95, 1.25
# A language with fewer held-out trusted texts takes the threshold of all languages.
LEAST_TEXTS = 20


@dataclass(frozen=True)
class Model:
    """Tables of the language model; ordinary and highest bits per byte by language, None for all."""

    tables: Broadcast
    ordinary: dict[str | None, float]
    highest: dict[str | None, float]

    def limits(self, langs: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        return tuple(np.array([x.get(lang, x[None]) for lang in langs], np.float64) for x in (self.ordinary, self.highest))


def surprisal(tables: dict, column: pa.Array) -> dict[str, np.ndarray]:
    """Bits and bytes (words and the blanks after them) of each text, read as a whole."""
    runs = ngram.runs_of(column, lower=False, mark_repeats=True, order=ORDER)
    distinct, which = np.unique(runs.grams, return_inverse=True)
    bits = -np.log2(ngram.probabilities(tables, 0, distinct, range(1, ORDER + 1)))
    return {"bits": np.bincount(runs.row, bits[which.reshape(-1)], runs.rows),
            "bytes": np.bincount(runs.row, minlength=runs.rows).astype(np.float64)}


def judged(model: Model, column: pa.Array, langs: list[str | None]) -> dict[str, np.ndarray]:
    """Steadied bits per byte, perplexity of a byte (NaN without words), and whether a text is kept."""
    found = surprisal(model.tables.value, column)
    ordinary, highest = model.limits(langs)
    steady = (found["bits"] + STEADY_BYTES * ordinary) / (found["bytes"] + STEADY_BYTES)
    some = found["bytes"] > 0
    perplexity = np.exp2(found["bits"] / np.where(some, found["bytes"], np.nan))
    return found | {"perplexity": perplexity, "kept": some & (steady <= highest)}


def held_out(id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit(""))), F.lit(HELD_OUT)) == 0


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on all trusted texts: ``docs`` (id, lang, text), ``labels`` (id, quality).

    An id is trusted if it has a label and none but 1. Ids outside the held-out tenth train the
    model; the held-out ones set ordinary bits and thresholds. Without trusted text nothing
    can be judged, and every text with words is kept.
    """
    spark = prepare(docs.sparkSession)
    shared_dir(spark)
    trusted = labels.groupBy("id").agg(F.min("quality").alias("quality")).filter("quality = 1").select("id")
    # Labels grow with the corpus: they are never broadcast, small as they may be in a test.
    train = likely(docs.filter(~held_out(F.col("id"))).select("id", "text"), trusted).join(trusted.hint("merge"), "id")
    counts = ngram.count_grams(train.select(F.lit(0).alias("class"), "text"), lower=False, mark_repeats=True, runs=ORDER).checkpoint()
    tables = spark.sparkContext.broadcast(ngram.tables(ngram.kneser_ney(counts, ORDER)))
    scored = ngram.score(docs.filter(held_out(F.col("id"))).select("id", "lang", "text"), tables, surprisal,
                         ["bits", "bytes"], ngram.PIECE).join(trusted, "id").filter("bytes > 0").checkpoint()
    by_lang = scored.groupBy("lang").agg(F.sum("bits").alias("bits"), F.sum("bytes").alias("bytes"), F.count("*").alias("n"))
    ordinary = {r.lang: r.bits / r.bytes for r in by_lang.filter(f"n >= {LEAST_TEXTS} AND lang IS NOT NULL").collect()}
    whole = scored.agg(F.sum("bits") / F.sum("bytes")).first()[0]
    ordinary[None] = whole if whole is not None else 0.0
    usual = F.lit(ordinary[None])
    for lang, value in ordinary.items():
        usual = F.when(F.col("lang") == lang, F.lit(value)).otherwise(usual) if lang is not None else usual
    steady = scored.select("lang", ((F.col("bits") + STEADY_BYTES * usual) / (F.col("bytes") + STEADY_BYTES)).alias("steady"))
    quantile = F.percentile_approx("steady", QUANTILE, 10_000).alias("q")
    highest = {r.lang: r.q * MARGIN for r in steady.groupBy("lang").agg(quantile).filter(
        F.col("lang").isin([x for x in ordinary if x is not None])).collect()}
    over_all = steady.agg(quantile).first().q
    highest[None] = over_all * MARGIN if over_all is not None else float("inf")
    return Model(tables, ordinary, highest)


def _named(docs: DataFrame, labels: DataFrame, id: str, lang: str, text: str, quality: str) -> tuple[DataFrame, DataFrame]:
    return plain(docs, id, lang, text).toDF("id", "lang", "text"), plain(labels, id, quality).toDF("id", "quality")


def classify(docs: DataFrame, labels: DataFrame, id: str = "doc_id", lang: str = "lang", text: str = "text",
             quality: str = "quality") -> DataFrame:
    """Perplexity and verdict of every whole text: id, lang, n_bytes, perplexity, kept.

    ``perplexity`` is that of a byte, given those before it in the text, over blanks and words. A text is kept if its bits per byte, steadied for
    short texts, do not exceed the threshold of its language; an unknown or null language has
    the threshold of all. A null text or one without words has no perplexity and is not kept.
    Bits equal to the threshold pass. One row per row of ``docs``, repeated rows and null ids included (a null id is never
    trusted); no rows give none. Other columns do not come out. Texts may be of any length; a batch holds a bounded number
    of bytes, or one text.
    """
    rows, marks = _named(docs, labels, id, lang, text, quality)
    model = fit(rows, marks)
    kind = docs.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", ngram.PIECE):
                found = judged(model, part.column("text"), part.column("lang").to_pylist())
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("lang"), pa.array(found["bytes"].astype(np.int64)),
                    pa.array(found["perplexity"], from_pandas=True), pa.array(found["kept"])],
                    names=[id, lang, "n_bytes", "perplexity", "kept"])

    return rows.mapInArrow(run, f"`{id}` {kind}, `{lang}` string, n_bytes long, perplexity double, kept boolean")


def keep_good(docs: DataFrame, labels: DataFrame, id: str = "doc_id", lang: str = "lang", text: str = "text",
              quality: str = "quality") -> DataFrame:
    """The rows of ``docs`` that ``classify`` keeps, with all their columns."""
    model = fit(*_named(docs, labels, id, lang, text, quality))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text, ngram.PIECE):
                kept = judged(model, part.column(text), part.column(lang).to_pylist())["kept"]
                yield part.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
