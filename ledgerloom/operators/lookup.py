"""Finding rows by name or words, and suggesting close names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import all_of
from ledgerloom.functions.skew import join_hot

# Fixed value: rows of a search.
SEARCH_LIMIT = 25
# Folders of a word index.
WORD_BUCKETS = 256


def ranked_search(
    df: DataFrame, col: str, q: str, key: list[str], limit: int = SEARCH_LIMIT, scope: dict | None = None
) -> DataFrame:
    """Rows whose name equals, starts with or contains ``q``, in that order.

    Case does not count and ``q`` has no wildcards. Inside a class rows are sorted by
    name and ``key``. ``scope`` keeps only rows with the given column values.
    """
    for name, value in (scope or {}).items():
        df = df.filter(F.col(name) == value)
    name, wanted = F.lower(F.col(col)), F.lit(q.lower())
    rank = F.when(name == wanted, 0).when(F.startswith(name, wanted), 1).otherwise(2)
    return (
        df.filter(F.contains(name, wanted)).withColumn("rank_class", rank)
        .orderBy("rank_class", col, *key).limit(limit)
    )


def _prefix_length(left: Column, right: Column) -> Column:
    """Number of leading characters two texts share."""
    steps = F.sequence(F.lit(1), F.least(F.length(left), F.length(right)))
    differs = F.filter(steps, lambda i: F.substring(left, F.lit(1), i) != F.substring(right, F.lit(1), i))
    shorter = F.least(F.length(left), F.length(right))
    return F.when(shorter == 0, 0).otherwise(F.coalesce(F.get(differs, F.lit(0)) - 1, shorter)).cast("int")


def _lengths(texts: DataFrame, name: str) -> list[int]:
    """The different lengths of some texts, at most as many as the longest has characters."""
    return sorted(row[0] for row in texts.select(F.length(name)).distinct().collect())


def _cut(text: Column, n: int):
    return lambda i: F.substring(text, i, F.lit(n))


def _pieces(text: Column, lengths: list[int]) -> Column:
    """All different substrings of a text that have one of these lengths."""
    size = F.length(text)
    cut = [
        F.when(size >= n, F.transform(F.sequence(F.lit(1), size - (n - 1)), _cut(text, n)))
        .otherwise(F.array().cast("array<string>")) if n else F.array(F.lit(""))
        for n in lengths
    ]
    return F.array_distinct(F.concat(F.array().cast("array<string>"), *cut))


def suggest_matches(unmatched: DataFrame, reference: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best reference names for every unmatched code.

    ``unmatched`` has a column code, ``reference`` a column name. The score is the
    length of the shared prefix, plus 2 if one contains the other; case does not count,
    scores of 0 are left out, ties go by name.

    No pair of unrelated names is formed. A candidate either contains the code, is
    contained in it, or shares a prefix, and each of these is an equality join on a
    piece of text. The reference side of each join keeps the best ``k`` names per piece
    first. That loses nothing: a name left out of its piece is beaten there by ``k``
    names that also beat it in the final order. Pieces are cut only in lengths that the other side has.
    """
    codes = unmatched.select("code").distinct().withColumn("q", F.lower("code"))
    names = reference.select(F.col("name").alias("candidate")).distinct().withColumn("n", F.lower("candidate"))
    code_pieces = codes.select("q").distinct()

    def best(pieces: DataFrame, *order: Column) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("piece").orderBy(*order, "candidate"))
        return pieces.withColumn("r", rank).filter(F.col("r") <= k).select("piece", "candidate", "n")

    # Shared prefix: among the names with a prefix, the first k by name.
    heads = lambda text: F.transform(
        F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array()),
        lambda i: F.substring(text, F.lit(1), i),
    )
    code_heads = codes.select("code", "q", F.explode(heads(F.col("q"))).alias("piece"))
    wanted_heads = code_heads.select("piece").distinct()
    by_prefix = best(
        names.select("candidate", "n", F.explode(heads(F.col("n"))).alias("piece")).join(wanted_heads, "piece", "left_semi")
    )
    # Names that contain the code: the best k by shared prefix, then name.
    holding = names.select("candidate", "n", F.explode(_pieces(F.col("n"), _lengths(codes, "q"))).alias("piece")).join(
        code_pieces, F.col("piece") == F.col("q"), "left_semi"
    )
    by_holding = best(holding, F.desc(_prefix_length(F.col("piece"), F.col("n"))))
    # Names contained in the code; several spellings of one piece are ranked by name.
    inside = best(names.select("candidate", "n", F.col("n").alias("piece")))
    code_cuts = codes.select("code", "q", F.explode(_pieces(F.col("q"), _lengths(names, "n"))).alias("piece"))

    # Almost all codes may share a piece: these joins can be split.
    pairs = (
        join_hot(code_heads, by_prefix, ["piece"], "inner")
        .unionByName(join_hot(codes.withColumn("piece", F.col("q")), by_holding, ["piece"], "inner"))
        .unionByName(join_hot(code_cuts, inside, ["piece"], "inner"))
        .select("code", "q", "candidate", "n").distinct()
    )
    bonus = F.when(F.contains("n", F.col("q")) | F.contains("q", F.col("n")), 2).otherwise(0)
    scored = pairs.withColumn("score", _prefix_length(F.col("q"), F.col("n")) + bonus).filter("score > 0")
    rank = F.row_number().over(Window.partitionBy("code").orderBy(F.desc("score"), "candidate"))
    return scored.withColumn("r", rank).filter(F.col("r") <= k).select("code", "candidate", "score")


def token_search(df: DataFrame, key: str, cols: list[str], query: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """Rows that hold every word of the query, most hits first.

    Words are runs of letters and digits; case does not count. Whole texts are searched
    inside the scan, for the words asked for only, and only matching rows leave it.
    """
    words = sorted(set(_words(query)))
    if not words:
        raise ValueError("the query has no words")
    text = F.lower(F.concat_ws(" ", *[F.col(c) for c in cols]))
    # The word itself comes first in the pattern: what stands around it is only looked at there.
    part = "[\\p{L}\\p{N}]"
    hits = [F.regexp_count(text, F.lit(f"{word}(?<!{part}{word})(?!{part})")) for word in words]
    found = (
        df.filter(all_of([F.contains(text, F.lit(word)) for word in words]))
        .select(key, *[h.alias(f"hits/{i}") for i, h in enumerate(hits)])
        .filter(all_of([F.col(f"`hits/{i}`") > 0 for i in range(len(words))]))
        .select(key, sum((F.col(f"`hits/{i}`") for i in range(len(words))), F.lit(0)).alias("hits"))
        .orderBy(F.desc("hits"), key).limit(limit)
    )
    place = F.row_number().over(Window.orderBy(F.desc("hits"), key))  # over the rows kept
    return found.withColumn("rank", place)


def _words(query: str) -> list[str]:
    return "".join(c if c.isalnum() else " " for c in query.lower()).split()


def _word_bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(WORD_BUCKETS)).cast("int")


def index_words(df: DataFrame, key: str, cols: list[str], path: str) -> None:
    """Add rows to a word index: which rows hold a word, and how often.

    ``key`` names a row, and each row is added once, by one load or another. Postings are dealt into folders by a hash of the
    word and sorted by word there, so that a search reads the folders, and of these the parts, of its own words. The
    folder of a frequent word is written by several tasks.
    """
    text = F.lower(F.concat_ws(" ", *[F.col(c) for c in cols]))
    words = F.filter(F.split(text, r"[^\p{L}\p{N}]+"), lambda word: word != "")
    postings = (
        df.select(F.col(key).alias("key"), F.explode(words).alias("word"))
        .groupBy("key", "word").agg(F.count(F.lit(1)).cast("int").alias("hits"))
        .withColumn("bucket", _word_bucket(F.col("word")))
    )
    postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "word").write.mode("append").partitionBy("bucket").parquet(path)


def postings(spark: SparkSession, path: str, words: list[str]) -> DataFrame:
    """Rows (key, word, hits) of some words of an index."""
    buckets = [_word_bucket(F.lit(word)) for word in words]
    return spark.read.parquet(path).filter(F.col("bucket").isin(*buckets) & F.col("word").isin(*words)).select("key", "word", "hits")


def indexed_search(spark: SparkSession, path: str, key: str, query: str, limit: int = SEARCH_LIMIT) -> DataFrame:
    """As `token_search`, from an index that `index_words` has made: the texts are not read.

    The rarest word's rows come first and the others' are joined to them, so that a frequent word costs no
    more than the scan of its postings.
    """
    words = sorted(set(_words(query)))
    if not words:
        raise ValueError("the query has no words")
    rows = postings(spark, path, words)
    counts = dict(rows.groupBy("word").count().collect())  # a row for each word of the query
    ordered = sorted(words, key=lambda word: (counts.get(word, 0), word))
    found = rows.filter(F.col("word") == ordered[0]).select("key", "hits")
    for word in ordered[1:]:
        more = rows.filter(F.col("word") == word).select("key", F.col("hits").alias("more"))
        found = found.join(more, "key").select("key", (F.col("hits") + F.col("more")).alias("hits"))
    best = found.orderBy(F.desc("hits"), "key").limit(limit)
    place = F.row_number().over(Window.orderBy(F.desc("hits"), "key"))  # over the rows kept
    return best.select(F.col("key").alias(key), "hits", place.alias("rank"))
