"""Reading tables, ad-hoc queries and keyed samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.profile import profilable

# Rows of ad-hoc queries and samples unless more are asked for.
DEFAULT_ROWS = 500
SAMPLE_ROWS = 10


def load_table(spark: SparkSession, src, name: str, partition: tuple | None = None) -> DataFrame:
    """One table as a DataFrame.

    ``src`` is a folder holding ``name`` or ``name.parquet``, or a dict of JDBC options
    (``url``, ``driver``, ``user`` ...). For JDBC, ``partition`` is
    ``(column, lower, upper, count)`` and makes the read parallel; the bounds only
    place the cuts, rows outside them are read as well.
    """
    if isinstance(src, dict):
        reader = spark.read.format("jdbc").options(**src).option("dbtable", name)
        if partition:
            column, lower, upper, count = partition
            reader = (
                reader.option("partitionColumn", column).option("lowerBound", lower)
                .option("upperBound", upper).option("numPartitions", count)
            )
        return reader.load()
    path = f"{str(src).rstrip('/')}/{name}"
    return spark.read.parquet(path if name.endswith(".parquet") else f"{path}.parquet")


def query(spark: SparkSession, sql: str, max_rows: int = DEFAULT_ROWS) -> DataFrame:
    """Rows of a SELECT or WITH statement, at most ``max_rows`` of them.

    The cap is a limit around the whole statement, so unions, common table
    expressions, DISTINCT and inner limits all keep their meaning.
    """
    if max_rows < 1:
        raise ValueError("max_rows must be positive")
    return spark.sql(sql).limit(max_rows)


def sample_rows(df: DataFrame, keys: list[str], limit: int = SAMPLE_ROWS, where: str | None = None) -> DataFrame:
    """The first rows by key without binary columns, optionally filtered."""
    if limit < 0:
        raise ValueError("limit must not be negative")
    rows = profilable(df.filter(F.expr(where)) if where else df)
    return (rows.orderBy(*keys) if keys else rows).limit(limit)
