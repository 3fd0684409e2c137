"""Joins whose large side may have hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import NUMERIC, all_of

TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _hashable(column: Column, kind: T.DataType, other: T.DataType) -> Column:
    """A form in which values that compare equal hash alike, whatever the types of the two sides."""
    if kind == other:
        return column
    if isinstance(kind, NUMERIC) or isinstance(other, NUMERIC):
        return column.try_cast("double")
    if isinstance(kind, TIMES) or isinstance(other, TIMES):
        return column.try_cast("timestamp")
    return column.cast("string")


def join_hot(fact: DataFrame, keyed: DataFrame, on: dict[str, str] | list[str], how: str) -> DataFrame:
    """Join rows with a table of keys so that a hot key can be split.

    Adaptive execution splits an oversized join partition only when both sides come
    straight from a shuffle. A side that was grouped or joined by the same key does not,
    as its partitioning is reused. A hash of the key as a further join column gives that
    side, one narrow row per key, a shuffle of its own. Below the broadcast threshold the
    join is broadcast as usual. Key columns of ``keyed`` do not come out.
    """
    on = on if isinstance(on, dict) else {name: name for name in on}
    inner = {right: f"key/{right}" for right in on.values()}
    side = keyed.withColumnsRenamed(inner)
    left, right = list(on), [inner[name] for name in on.values()]
    kinds = [(fact.schema[a].dataType, side.schema[b].dataType) for a, b in zip(left, right)]
    own = [_hashable(F.col(f"`{a}`"), k, o) for a, (k, o) in zip(left, kinds)]
    keys = [_hashable(F.col(f"`{b}`"), o, k) for b, (k, o) in zip(right, kinds)]
    side = side.withColumn("key/hash", F.xxhash64(*keys))
    condition = all_of([F.col(f"`{a}`") == F.col(f"`{b}`") for a, b in zip(left, right)])
    joined = fact.join(
        side, condition & (F.xxhash64(*own) == F.col("`key/hash`")), how
    )
    return joined if how in ("left_semi", "left_anti") else joined.drop(*right, "key/hash")
