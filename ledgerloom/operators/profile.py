"""Counting and profiling tables and columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import NESTED, NUMERIC, groupable_text, pct

# Fixed value: rows of a sampled profile.
SAMPLE_ROWS = 50_000
# Values that a sketch of frequent values tracks, and how many of them are counted exactly.
TRACKED, CANDIDATES = 20_000, 1_000


def profilable(df: DataFrame) -> DataFrame:
    """Drop binary columns; the reader then does not fetch them."""
    return df.select(
        [F.col(f"`{field.name}`") for field in df.schema if not isinstance(field.dataType, T.BinaryType)]
    )


def _shown(column: Column, width: int | None) -> Column:
    text = column.cast("string")
    if width is None:
        return text
    return F.when(F.length(text) > width, F.concat(F.left(text, F.lit(width - 3)), F.lit("..."))).otherwise(text)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Exact row count of each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def _long(wide: DataFrame, fields: list[T.StructField], measures: dict[str, str]) -> DataFrame:
    """Turn one row with ``<column number>_<measure>`` columns into one row per column."""
    entries = [
        F.struct(
            F.lit(field.name).alias("column"),
            F.lit(field.dataType.simpleString()).alias("type"),
            *[F.col(f"{i}_{name}").cast(kind).alias(name) for name, kind in measures.items()],
        )
        for i, field in enumerate(fields)
    ]
    return wide.select("rows_profiled", F.inline(F.array(*entries)))


def profile_table(df: DataFrame, exact: bool = True, text_width: int | None = None) -> DataFrame:
    """Null share, distinct count and one value for each non-binary column.

    All columns are measured in one scan with one small shuffle. Distinct counts are
    exact, or HyperLogLog estimates with ``exact`` false. Nested columns get a null share only.
    ``text_width`` shortens the values shown.
    """
    df = profilable(df)
    fields = df.schema.fields
    measures = [F.count(F.lit(1)).alias("rows_profiled")]
    for i, field in enumerate(fields):
        column = F.col(f"`{field.name}`")
        nested = isinstance(field.dataType, NESTED)
        measures += [
            F.count(column).alias(f"{i}_filled"),
            F.lit(None).cast("long").alias(f"{i}_distinct") if nested or exact
            else F.approx_count_distinct(column).alias(f"{i}_distinct"),
            F.lit(None).cast("string").alias(f"{i}_sample_value") if nested
            else _shown(F.min(column), text_width).alias(f"{i}_sample_value"),
        ]
    profile = _long(df.agg(*measures), fields, {"filled": "long", "distinct": "long", "sample_value": "string"})
    if exact:
        counted = distinct_counts(df).withColumnsRenamed({"column": "counted", "distinct": "found"})
        plain = [field.name for field in fields if not isinstance(field.dataType, NESTED)]
        profile = profile.join(counted, F.col("column") == F.col("counted"), "left").withColumn(
            "distinct", F.when(F.col("column").isin(plain), F.coalesce("found", F.lit(0)))
        )
    return profile.select(
        "column", "type", "rows_profiled",
        (F.col("rows_profiled") - F.col("filled")).alias("nulls"),
        pct(F.col("rows_profiled") - F.col("filled"), F.col("rows_profiled")).alias("null_pct"),
        "distinct", F.lit(not exact).alias("is_estimate"), "sample_value",
    )


def distinct_counts(df: DataFrame) -> DataFrame:
    """Exact number of distinct non-NULL values of every plain column.

    Columns are turned into (column, value) rows that are deduplicated before the
    shuffle; counting each column with its own DISTINCT would shuffle whole rows once
    per column.
    """
    plain = [field for field in df.schema if not isinstance(field.dataType, (*NESTED, T.BinaryType))]
    cells = [F.struct(F.lit(i).alias("number"), groupable_text(field).alias("value")) for i, field in enumerate(plain)]
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, distinct long")
    names = F.array(*[F.lit(field.name) for field in plain])
    return (
        df.select(F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .distinct()
        .groupBy("number").agg(F.count(F.lit(1)).alias("distinct"))
        .select(F.get(names, F.col("number")).alias("column"), "distinct")
    )


def profile_sampled(df: DataFrame, n: int = SAMPLE_ROWS, seed: int = 0) -> DataFrame:
    """Profile of about ``n`` rows drawn evenly from the whole table.

    Null shares are relative to the rows drawn, and every figure is marked an estimate; a table of
    up to ``n`` rows is drawn whole.
    """
    drawn = df.sample(fraction=min(1.0, n / max(1, df.count())), seed=seed)
    return profile_table(drawn).withColumn("is_estimate", F.lit(True))


def profile_column(df: DataFrame, col: str) -> DataFrame:
    """One-row summary of a column; numbers also get mean and sample deviation."""
    kind = df.schema[col].dataType
    column = F.col(f"`{col}`")
    bare = isinstance(kind, (*NESTED, T.BinaryType))
    nothing = F.lit(None)
    number = column.cast("double")
    summary = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(column.isNull()).alias("nulls"),
        (nothing.cast("long") if isinstance(kind, NESTED) else F.count_distinct(column)).alias("distinct"),
        (nothing.cast("string") if bare else F.min(column)).alias("min"),
        (nothing.cast("string") if bare else F.max(column)).alias("max"),
        (F.avg(number) if isinstance(kind, NUMERIC) else nothing.cast("double")).alias("avg"),
        (F.stddev_samp(number) if isinstance(kind, NUMERIC) else nothing.cast("double")).alias("stddev"),
    )
    return summary.select(
        "total", "nulls", pct(F.col("nulls"), F.col("total")).alias("null_pct"),
        "distinct", "min", "max", "avg", "stddev",
    )


def top_values(df: DataFrame, col: str, k: int = 15) -> DataFrame:
    """The ``k`` most frequent values, NULL included, ties by value.

    ``pct_of_top`` is relative to the rows shown, ``pct_of_rows`` to the whole table.
    """
    top = (
        df.groupBy(F.col(f"`{col}`").alias("value")).agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc_nulls_first("value")).limit(k)
    )
    shown = F.sum("cnt").over(Window.partitionBy())  # over the k rows kept
    rows = df.select(F.count(F.lit(1)).alias("rows")).scalar()
    return top.select(
        "value", "cnt", pct(F.col("cnt"), shown).alias("pct_of_top"), pct(F.col("cnt"), rows).alias("pct_of_rows")
    )


def grouped_concat(df: DataFrame, keys: list[str], col: str, order: list[str], sep: str = ", ") -> DataFrame:
    """Values of a column joined into one text per group, in the given order.

    The text of a group is a single cell, so a group has to fit one; group by a key
    that is as fine as the text is meant to be read.
    """
    by = ", ".join(f"`{name}`" for name in order)
    return df.groupBy(*keys).agg(
        F.expr(f"listagg(cast(`{col}` as string), '{sep}') within group (order by {by})").alias(col)
    )


def segment_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per value of a column, sorted by it."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.asc_nulls_first(key))


def keep_profile(df: DataFrame, path: str, part: str) -> None:
    """Sketches of the columns of one part of a table, beside those of its other parts.

    For each column that is not nested: rows, filled rows, a HyperLogLog sketch of the different values and one of the frequent ones.
    Only this part is read; kept again, it replaces itself.
    """
    fields = [f for f in profilable(df).schema if not isinstance(f.dataType, NESTED)]
    texts = [groupable_text(field).alias(str(i)) for i, field in enumerate(fields)]
    found = df.select(*texts).agg(F.count(F.lit(1)).alias("rows"), *[
        measure for i in range(len(fields)) for measure in (
            F.count(F.col(f"`{i}`")).alias(f"{i}_filled"), F.hll_sketch_agg(F.col(f"`{i}`")).alias(f"{i}_distinct"),
            F.expr(f"approx_top_k_accumulate(`{i}`, {TRACKED})").alias(f"{i}_frequent"))
    ])
    columns = [
        F.struct(F.lit(field.name).alias("column"), F.lit(field.dataType.simpleString()).alias("type"),
                 *[F.col(f"{i}_{m}").alias(m) for m in ("filled", "distinct", "frequent")])
        for i, field in enumerate(fields)
    ]
    found.select("rows", F.inline(F.array(*columns))).write.mode("overwrite").parquet(f"{path}/part={part}")


def kept_profile(spark: SparkSession, path: str) -> DataFrame:
    """Rows, null share and estimated distinct count of each column, from the sketches of all parts."""
    parts = spark.read.parquet(path)
    return parts.groupBy("column", "type").agg(
        F.sum("rows").alias("rows_profiled"), F.sum("filled").alias("filled"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct"),
    ).select(
        "rows_profiled", "column", "type", (F.col("rows_profiled") - F.col("filled")).alias("nulls"),
        pct(F.col("rows_profiled") - F.col("filled"), F.col("rows_profiled")).alias("null_pct"), "distinct",
    )


def kept_top_values(df: DataFrame, path: str, col: str, k: int = 15) -> DataFrame:
    """As `top_values` of the whole table, counting exactly only what the sketches of its parts call frequent.

    A sketch of TRACKED values loses none that stands in more than 7 / TRACKED of the rows, and those beyond the first
    CANDIDATES are no more frequent than the last of these. Where the k-th of the counted values is not above that, all values
    are counted.
    """
    spark = df.sparkSession
    parts = spark.read.parquet(path).filter(F.col("column") == col)
    known = parts.agg(F.sum("rows").alias("rows"), F.expr(
        f"approx_top_k_estimate(approx_top_k_combine(frequent, {TRACKED}), {min(CANDIDATES, TRACKED)})").alias("items")).first()
    column, text = F.col(f"`{col}`"), groupable_text(df.schema[col])
    texts = [item["item"] for item in known["items"] or () if item["item"] is not None]
    some = df.filter(column.isNull() | text.isin(texts)) if texts else df.filter(column.isNull())
    counted = some.groupBy(column.alias("value")).agg(F.count(F.lit(1)).alias("cnt")).orderBy(
        F.desc("cnt"), F.asc_nulls_first("value")).limit(k)
    rows = counted.collect()  # k rows
    most = 7 * known["rows"] / TRACKED  # of a value that was not counted
    if len(texts) >= min(CANDIDATES, TRACKED) - 1:
        most = max(most, min(item["count"] for item in known["items"]))
    whole = sum(row["cnt"] for row in rows) == known["rows"]
    if not whole and (len(rows) < k or rows[-1]["cnt"] <= most):
        return top_values(df, col, k)
    top = spark.createDataFrame(rows, counted.schema)
    shown = F.sum("cnt").over(Window.partitionBy())  # over the k rows kept
    return top.select("value", "cnt", pct(F.col("cnt"), shown).alias("pct_of_top"), pct(F.col("cnt"), F.lit(known["rows"])).alias("pct_of_rows"))
