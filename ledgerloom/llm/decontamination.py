"""Decontamination: windows of texts that equal a benchmark item, or nearly.

Windows have the size of an item. A window that shares no run of K words with an item cannot
resemble it, so only windows around shared runs are cut out of the texts: a Bloom filter of the
items' runs finds them within each row. A window and an item of its size have SimHash fingerprints;
an index of BLOCKS blocks of bits finds every pair that differs in at most RADIUS bits, as
at least one block is then equal. What it finds is decided by the exact similarity of the
weighted runs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.skew import join_hot
from ledgerloom.llm.text import once, prepare
from ledgerloom.llm.url_filter import bloom
from ledgerloom.session import shared_dir

K, SIMILARITY = 5, 0.8
BITS, RADIUS = 64, 17
BLOCKS = RADIUS + 1
# Runs whose filter is put into one plan; a larger benchmark is searched in several passes.
MOST_RUNS = 200_000
WRONG = 4e-3


def words_of(text: Column) -> Column:
    """Words in lower case; letters and digits make a word."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def _let(value: Column, use) -> Column:
    """Evaluate ``value`` once and hand it on."""
    return F.transform(F.array(value), use)[0]


def _starts(words: Column) -> Column:
    """Places of the runs of K words, from 1."""
    return F.when(F.size(words) >= K, F.sequence(F.lit(1), F.size(words) - (K - 1))).otherwise(
        F.array().cast("array<int>"))


def _run_key(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + (k - 1)) for k in range(K)])


def weighted_runs(words: Column) -> Column:
    """Runs of K words as (key, weight): the weight is the letters of a run, equal runs are numbered."""
    runs = F.transform(_starts(words), lambda i: F.struct(
        _run_key(words, i).alias("key"),
        reduce(lambda a, b: a + b, [F.length(F.get(words, i + (k - 1))) for k in range(K)]).alias("weight")))
    return _let(runs, lambda all: F.transform(all, lambda run, i: F.struct(
        F.xxhash64(run["key"], F.size(F.filter(F.slice(all, F.lit(1), i), lambda r: r["key"] == run["key"]))).alias("key"),
        run["weight"].alias("weight"))))


def fingerprint(runs: Column) -> Column:
    """SimHash: bit b is set when the runs with it weigh more than those without."""
    def heavier(b: Column) -> Column:
        return F.aggregate(runs, F.lit(0), lambda total, run: total + F.when(
            F.getbit(run["key"], b) == 1, run["weight"]).otherwise(-run["weight"])) > 0

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), lambda bits, b: F.when(
        heavier(b), bits.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), b))).otherwise(bits))


def blocks(print: Column) -> Column:
    """The BLOCKS parts of a fingerprint, each with its number."""
    borders = [BITS * i // BLOCKS for i in range(BLOCKS + 1)]
    return F.array(*[F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(F.shiftleft(print, BITS - high), BITS - high + low)
                              .alias("part")) for i, (low, high) in enumerate(zip(borders, borders[1:]))])


def similarity(a: Column, b: Column) -> Column:
    """Weight of the runs two texts share over the weight of those either has."""
    def weight(runs: Column) -> Column:
        return F.aggregate(runs, F.lit(0), lambda total, run: total + run["weight"])

    shared = _let(F.transform(b, lambda run: run["key"]), lambda keys: weight(
        F.filter(a, lambda run: F.array_contains(keys, run["key"]))))
    return F.try_divide(shared.cast("double"), weight(a) + weight(b) - shared)


def _printed(rows: DataFrame) -> DataFrame:
    """Rows with words, and their weighted runs and fingerprint."""
    return rows.withColumn("runs", once(weighted_runs(F.col("words")))).withColumn("print", fingerprint(F.col("runs")))


def row_keys(id: str, text: str) -> dict[str, Column]:
    """Two hashes of id and text, which equal rows share."""
    content = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return {"leaks/row1": F.xxhash64(content, F.col(f"`{id}`")),
            "leaks/row2": F.xxhash64(F.col(f"`{id}`"), F.lit(1), content)}


def _windows(docs: DataFrame, runs: DataFrame, longest: int, count: int) -> DataFrame:
    """Windows (id, row1, row2, start, size, words) of rows (id, row1, row2, text) around runs shared with an item."""
    listed = bloom(runs.select("key").distinct(), count, WRONG, places=2)

    def hits(words: Column) -> Column:
        keyed = F.transform(_starts(words), lambda i: F.struct(i.alias("place"), _run_key(words, i).alias("key")))
        # A hit keeps as many words before and after it as the longest item can reach.
        first = lambda hit: F.greatest(hit["place"] - F.lit(longest), F.lit(1))
        return F.transform(F.filter(keyed, lambda hit: listed.holds(hit["key"])), lambda hit: F.struct(
            hit["place"].alias("place"), hit["key"].alias("key"), F.size(words).alias("length"), first(hit).alias("first"),
            F.slice(words, first(hit), F.lit(2 * longest)).alias("near")))

    found = docs.select("id", "row1", "row2", once(_let(words_of(F.col("text")), hits)).alias("hits")).select(
        "id", "row1", "row2", F.inline("hits"))
    begin = F.greatest(F.lit(1), F.least(F.col("place") - F.col("offset"), F.col("length") - F.col("size") + 1))
    return join_hot(found, runs.select("key", "offset", "size").distinct(), ["key"], "inner").select(
        "id", "row1", "row2", begin.alias("start"), "size", "first", "near").groupBy("id", "row1", "row2", "start", "size").agg(
        F.min_by(F.slice("near", F.col("start") - F.col("first") + 1, F.col("size")), "first").alias("words"))


def leaks(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """Items that a text contains: rows (id, row1, row2, item, start, size, bits, similarity), the best window of each."""
    shared_dir(prepare(docs.sparkSession))
    keys = row_keys(id, text)
    rows = docs.select(F.col(f"`{id}`").alias("id"), *[c.alias(n.split("/")[1]) for n, c in keys.items()],
                       F.col(f"`{text}`").alias("text"))
    wanted = items.select(F.col(f"`{item}`").alias("item"), once(words_of(F.col(f"`{item_text}`"))).alias("words")).filter(
        F.size("words") >= K).withColumn("size", F.size("words"))
    wanted = _printed(wanted).checkpoint()
    total, longest = wanted.agg(F.sum(F.size("runs")), F.max("size")).first()
    passes = -(-(total or 0) // MOST_RUNS)
    windows = []
    for p in range(passes):
        some = wanted.filter(F.pmod(F.xxhash64("item", "words"), F.lit(passes)) == p)
        runs = some.select("size", F.posexplode(F.transform(_starts(F.col("words")), lambda i: _run_key(F.col("words"), i)))
                           .alias("offset", "key"))
        windows.append(_windows(rows, runs, longest, -(-total // passes)))
    if not windows:
        windows = [rows.select("id", "row1", "row2", F.lit(1).alias("start"), F.lit(0).alias("size"),
                               words_of(F.col("text")).alias("words")).limit(0)]
    printed = _printed(reduce(DataFrame.unionByName, windows).dropDuplicates(["row1", "row2", "start", "size"])).checkpoint()
    # Pairs of a window and an item of its size that agree in a block, and then in all but RADIUS bits.
    left = printed.select("row1", "row2", "start", "size", "print", F.inline(blocks(F.col("print"))))
    right = wanted.select("item", "words", "size", F.col("print").alias("other"), F.inline(blocks(F.col("print")))).withColumn(
        "item_key", F.xxhash64("item", "words")).drop("words", "item")
    bits = F.bit_count(F.col("print").bitwiseXOR(F.col("other"))).alias("bits")
    pairs = join_hot(left, right, ["size", "block", "part"], "inner").select(
        "row1", "row2", "start", "size", "item_key", bits).filter(F.col("bits") <= RADIUS).distinct()
    sides = wanted.select("item", F.xxhash64("item", "words").alias("item_key"), F.col("runs").alias("item_runs")).dropDuplicates(["item_key"])
    checked = pairs.join(printed.select("id", "row1", "row2", "start", "size", "runs"), ["row1", "row2", "start", "size"])
    checked = join_hot(checked, sides, ["item_key"], "inner").withColumn(
        "similarity", similarity(F.col("runs"), F.col("item_runs"))).filter(F.col("similarity") >= SIMILARITY)
    best = F.max(F.struct("similarity", -F.col("bits"), -F.col("start"), "size")).alias("best")
    return checked.groupBy("id", "row1", "row2", "item").agg(best).select(
        "id", "row1", "row2", "item", (-F.col("best.col3")).alias("start"), F.col("best.size").alias("size"),
        (-F.col("best.col2")).alias("bits"), F.col("best.similarity").alias("similarity"))


def contaminated(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
                 item_text: str = "text") -> DataFrame:
    """Documents and the items they contain: id, item, start, size, bits, similarity.

    ``start`` is the first word (from 1) of the most similar window, ``bits`` the bits in which the
    fingerprints differ. Case and punctuation do not count. Rows with the same id that contain an item
    give one row. An item of fewer than K words is not searched for; a null text contains nothing.
    Other columns do not come out.
    """
    best = F.max(F.struct("similarity", -F.col("bits"), -F.col("start"), "size")).alias("best")
    return leaks(docs, items, id, text, item, item_text).groupBy("id", "item").agg(best).select(
        F.col("id").alias(id), F.col("item").alias(item), (-F.col("best.col3")).alias("start"),
        F.col("best.size").alias("size"), (-F.col("best.col2")).alias("bits"), F.col("best.similarity").alias("similarity"))


def clean(docs: DataFrame, items: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    found = leaks(docs, items, id, text, item, item_text).select(
        F.col("row1").alias("leaks/row1"), F.col("row2").alias("leaks/row2")).distinct()
    return docs.withColumns(row_keys(id, text)).join(found, ["leaks/row1", "leaks/row2"], "left_anti").select(
        *[F.col(f"`{c}`") for c in docs.columns])
