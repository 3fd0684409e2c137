"""Toxicity scores from two Kneser-Ney models, of toxic and of ordinary text, with shared lower orders.

The two models have n-grams of their own for the two highest orders only. Below, both back off to
the counts of all training text, so that expressions that are rare in one class are smoothed
alike in both. Each word has the difference of its two log-likelihoods. A text has two measures
of it: the largest difference divided by the word's length, and the sum of what exceeds the
noise divided by the root of the number of words. A logistic curve through both is
fitted to training rows that the models have not seen.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import ngram
from ledgerloom.llm.text import plain, prepare
from ledgerloom.session import shared_dir

ORDINARY, TOXIC, SHARED = 0, 1, 2
SHARED_ORDERS = 3
# Of five parts by id, part 0 is held out, part 1 sets the score, the others train the models.
PARTS = 5
# What the difference of a word may be by chance, in nats.
NOISE = 1.5
MEASURES = ["peak", "excess"]
ROUNDS = 12  # of Newton's method


def part_of(id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id.cast("string"), F.lit(""))), F.lit(PARTS)).cast("int")


def evidence(tables: dict, column: pa.Array) -> dict[str, np.ndarray]:
    """The two measures of each text; without words the least there is."""
    words = ngram.words_of(column, lower=True, mark_repeats=False)

    def difference(grams: np.ndarray) -> np.ndarray:
        shared = ngram.probabilities(tables, SHARED, grams, range(1, SHARED_ORDERS + 1))
        own = range(SHARED_ORDERS + 1, ngram.ORDER + 1)
        toxic = ngram.probabilities(tables, TOXIC, grams, own, shared)
        ordinary = ngram.probabilities(tables, ORDINARY, grams, own, shared)
        return np.log(toxic) - np.log(ordinary)

    each = ngram.per_word(words, ngram.per_event(words, difference))
    count = ngram.per_row(words, np.ones(len(each)), np.add, 0.0)
    excess = ngram.per_row(words, np.maximum(each - NOISE, 0.0), np.add, 0.0)
    return {"peak": ngram.per_row(words, each / np.maximum(words.sizes, 1), np.maximum, 0.0),
            "excess": excess / np.sqrt(np.maximum(count, 1.0))}


def fit(docs: DataFrame, labels: DataFrame):
    """Tables of the three models, as a broadcast: ``docs`` (id, text), ``labels`` (id, toxic)."""
    spark = prepare(docs.sparkSession)
    shared_dir(spark)
    # Labels grow with the corpus: they are never broadcast, small as they may be in a test.
    train = docs.filter(part_of(F.col("id")) > 1).select("id", "text").join(
        labels.filter(part_of(F.col("id")) > 1).hint("merge"), "id").select(F.col("toxic").alias("class"), "text")
    counts = ngram.count_grams(train, lower=True, mark_repeats=False)
    each = counts.checkpoint()
    pooled = each.groupBy("gram").agg(F.sum("n").alias("n")).select(F.lit(SHARED).alias("class"), "gram", "n")
    entries = ngram.kneser_ney(each.unionByName(pooled)).filter(
        ((F.col("class") == SHARED) & (F.col("size") <= SHARED_ORDERS))
        | ((F.col("class") != SHARED) & (F.col("size") > SHARED_ORDERS)))
    return spark.sparkContext.broadcast(ngram.tables(entries))


def _logit(weights: np.ndarray) -> Column:
    terms = [F.lit(float(w)) * F.col(m) for w, m in zip(weights, MEASURES)]
    return sum(terms, F.lit(float(weights[-1])))


def _chance(logit: Column) -> Column:
    return 1 / (1 + F.exp(F.greatest(F.least(-logit, F.lit(700.0)), F.lit(-700.0))))


def weights(seen: DataFrame) -> np.ndarray:
    """Logistic regression of toxic on the measures by Newton's method; each round sums over all rows.

    A small penalty keeps the weights finite where the classes are wholly apart. Without rows of
    both classes only the constant counts, and it follows the class there is; without rows it is ordinary.
    """
    found = seen.agg(F.count("*"), F.sum("toxic"), *[F.stddev_pop(m) for m in MEASURES]).first()
    rows, toxic, *spread = found
    if not rows or not toxic or toxic == rows:
        return np.array([0.0, 0.0, 20.0 if rows and toxic == rows else -20.0])
    terms = [*[F.col(m) for m in MEASURES], F.lit(1.0)]
    size, now = len(terms), np.array([0.0, 0.0, np.log(toxic / (rows - toxic))])
    penalty = np.diag([*[0.1 * (s or 1.0) ** 2 for s in spread], 0.0])
    for _ in range(ROUNDS):
        p = _chance(_logit(now))
        gap, weight = F.col("toxic") - p, F.greatest(p * (1 - p), F.lit(1e-6))
        sums = seen.agg(*[F.sum(gap * t) for t in terms], *[
            F.sum(weight * terms[i] * terms[j]) for i in range(size) for j in range(size)]).first()
        slope, bend = np.array(sums[:size]), np.array(sums[size:]).reshape(size, size)
        step = np.linalg.solve(bend + penalty + 1e-9 * np.eye(size), slope - penalty @ now)
        now = now + step
        if np.abs(step).max() < 1e-6 * (1 + np.abs(now).max()):
            break
    return now


def scores(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> DataFrame:
    """Score of every whole text: id, held_out, score, predicted, peak, excess.

    Labels of part 0 of the ids are never used. An id is toxic if any of its labels is 1; null
    labels count for nothing. A null text or one without words has a score near 0. Without
    labels of both classes no text is called toxic unless all labels are. One row per row of ``docs``,
    repeated rows and null ids included; no rows give none. Other columns do not come out. Texts may be of any length;
    a batch holds a bounded number of bytes, or one text.
    """
    rows = plain(docs, id, text).toDF("id", "text")
    marks = plain(labels, id, toxic).toDF("id", "toxic").filter((part_of(F.col("id")) != 0)).groupBy("id").agg(
        F.max("toxic").cast("int").alias("toxic")).filter("toxic IN (0, 1)")
    tables = fit(rows, marks)
    seen = ngram.score(rows.filter(part_of(F.col("id")) == 1), tables, evidence, MEASURES).join(marks, "id").checkpoint()
    found = ngram.score(rows, tables, evidence, MEASURES).withColumn("score", _chance(_logit(weights(seen))))
    return found.select(
        F.col("id").alias(id), (part_of(F.col("id")) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), *MEASURES)
