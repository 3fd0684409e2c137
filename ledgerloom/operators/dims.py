"""Dimension references: checks and names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.skew import join_hot


def _lookup(refs: dict[str, tuple], df: DataFrame, add_names: bool) -> DataFrame:
    # No broadcast hint: the planner broadcasts a reference table only below its size
    # threshold and shuffles a larger one.
    for column, (table, key, *name) in refs.items():
        label = f"{column}/name" if add_names else f"{column}/known"
        extra = F.col(name[0]) if add_names else F.lit(True)
        # A repeated id has the least of its names.
        side = table.groupBy(F.col(key).alias("id")).agg(F.min(extra).alias(label))
        df = join_hot(df, side, {column: "id"}, "left")
    return df


def validate_refs(df: DataFrame, key: list[str], refs: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Bad dimension values, one row per row and dimension.

    ``refs`` maps a column to (reference table, id column). An absent value is
    ``missing``, one that is not in the reference table is ``unknown``.
    """
    marked = _lookup(refs, df, add_names=False)
    flaws = F.array_compact(
        F.array(*[
            F.when(
                F.col(f"`{c}/known`").isNull(),
                F.struct(
                    F.lit(c).alias("dimension"), F.col(c).cast("string").alias("bad_value"),
                    F.when(F.col(c).isNull(), "missing").otherwise("unknown").alias("reason"),
                ),
            )
            for c in refs
        ])
    )
    return marked.select(*key, F.inline(flaws))


def with_dimensions(df: DataFrame, refs: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Add the name of each dimension; ``refs`` maps a column to (table, id column, name column).

    The name of ``site_id`` comes out as ``site_name``. Rows without a match are kept.
    """
    named = _lookup(refs, df, add_names=True)
    return named.select(
        *[F.col(c) for c in df.columns],
        *[F.col(f"`{c}/name`").alias(f"{c.removesuffix('_id')}_name") for c in refs],
    )
