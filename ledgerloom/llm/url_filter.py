"""URL rules looked up in a cascade of Bloom filters.

A rule is listed under its key, host and path. Every page gives the keys a fitting rule could
have: each suffix of its host by labels with each prefix of its path as long as some rule's
path. The first filter holds the listed keys, the second the keys of the corpus that pass the
first by mistake, the third the listed keys that pass the second, and so on until nobody
passes. Over the keys of the corpus membership is then exact, without a join.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# More listed keys than this are not put into a plan.
MAX_LISTED = 100_000


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Level:
    """Bits of one Bloom filter in words of 64, the number of places of a key, and what tells its hashes from others'."""

    words: tuple[int, ...]
    places: int
    seed: int

    def holds(self, key: Column) -> Column:
        table = F.expr("array(" + ", ".join(f"{w}L" if w > -(2**63) else "bigint('-9223372036854775808')" for w in self.words) + ")")
        hits = []
        for place in _places(key, len(self.words) * 64, self.places, self.seed):
            word = F.element_at(table, (F.shiftright(place, 6) + 1).cast("int"))
            hits.append(F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return reduce(lambda a, b: a & b, hits)


def _places(key: Column, bits: int, places: int, seed: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(seed * 64 + i)), F.lit(bits)) for i in range(places)]


def bloom(keys: DataFrame, count: int, wrong: float, seed: int = 0, places: int | None = None) -> Level:
    """A filter of ``count`` keys (column key) that others pass with probability ``wrong``.

    The driver gets its words only: their number follows from ``count`` and ``wrong``. Few ``places``
    make a larger filter that is asked faster.
    """
    places = places or max(1, round(-math.log2(wrong)))
    size = max(1, math.ceil(-places * count / math.log(1 - wrong ** (1 / places)) / 64))
    bits = keys.select(F.explode(F.array(*_places(F.col("key"), size * 64, places, seed))).alias("bit"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(
        F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits"))
    table = [0] * size
    for row in words.collect():
        table[row.word] = row.bits
    return Level(tuple(table), places, seed)


def cascade(universe: DataFrame, listed: DataFrame, listed_count: int) -> list[Level]:
    """Filters that tell the keys of ``universe`` (column key) that are listed from the others.

    The first filter lets so few others pass that the later ones stay in proportion to the list:
    their size does not follow the corpus, but for the logarithm of its number of keys.
    """
    if listed_count > MAX_LISTED:
        raise ValueError(f"more than {MAX_LISTED} listed keys")
    if not listed_count:
        return []
    others = universe.agg(F.approx_count_distinct("key")).first()[0]
    first = min(0.5, math.sqrt(0.5) * listed_count / max(others, listed_count))
    levels = [bloom(listed, listed_count, first)]
    # Keys of the corpus that the first filter lets pass by mistake.
    own = listed
    wrong = universe.filter(levels[0].holds(F.col("key"))).distinct().join(own, "key", "left_anti").checkpoint()
    count = wrong.count()
    while count:
        levels.append(bloom(wrong, count, 0.5, seed=len(levels)))
        own, wrong = wrong, own.filter(levels[-1].holds(F.col("key"))).checkpoint()
        count = wrong.count()
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Is the key listed: it is, when the first filter that refuses it has an even number."""
    found = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        found = F.when(levels[i].holds(key), found).otherwise(F.lit(i % 2 == 1))
    return found


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for a null url and one without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow", id: str = "page_id",
          url: str = "url") -> DataFrame:
    """Verdict of every url: id, host, path, rule, verdict.

    A rule fits its host and all subdomains if the url's path starts with the rule's; the
    longest host, then path, wins. Without a fitting rule the verdict is ``default`` and the rule null.
    One row per row of ``pages``, repeated rows and null ids included; a null url fits no rule.
    Other columns of ``pages`` do not come out.
    """
    spark = pages.sparkSession
    if len({r.key for r in rules}) < len(rules):
        raise ValueError("a key is listed twice")
    host, path = host_and_path(F.col("url"))
    sites = pages.select(F.col(f"`{id}`").alias("id"), F.col(f"`{url}`").alias("url")).select(
        "id", host.alias("host"), path.alias("path"))
    if not rules:
        return sites.select(F.col("id").alias(id), "host", "path", F.lit(None).cast("string").alias("rule"),
                            F.lit(default).alias("verdict"))
    lengths = sorted({len(r.path) for r in rules}, reverse=True)
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[
        F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in lengths]), lambda p: p.isNotNull())
    # Longest host first, then longest path.
    keys = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))
    keyed = sites.withColumn("keys", keys)
    listed = spark.createDataFrame([(r.key,) for r in rules], "key string")
    universe = sites.select("host", "path").distinct().select(F.explode(keys).alias("key"))
    levels = cascade(universe, listed, len(rules))
    fitting = F.try_element_at(F.filter("keys", lambda k: member(levels, k)), F.lit(1))
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.key, r.verdict)])
    return keyed.withColumn("rule", fitting).select(
        F.col("id").alias(id), "host", "path", "rule",
        F.coalesce(F.element_at(verdicts, F.col("rule")), F.lit(default)).alias("verdict"))
