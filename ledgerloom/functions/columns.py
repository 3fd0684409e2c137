"""Column helpers shared by the operators."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Money is decimal at scale 4 everywhere; sums get room to grow.
MONEY = "decimal(18,4)"
MONEY_TOTAL = "decimal(38,4)"

NUMERIC = (
    T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType,
)
NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def total(column: str | Column) -> Column:
    """Sum of a money column; no rows and NULL amounts count as zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.sum(column.cast(MONEY_TOTAL)), F.lit(0)).cast(MONEY_TOTAL)


def zero() -> Column:
    return F.lit(0).cast(MONEY_TOTAL)


def pct(part: Column, whole: Column) -> Column:
    """Percentage as double, NULL when there is nothing to divide by."""
    return F.try_divide(part.cast("double") * 100, whole)


def is_blank(column: Column) -> Column:
    """NULL, empty, or white space only, tabs and line feeds included."""
    return column.isNull() | ~column.rlike(r"[^\s]")


def all_of(conditions: list[Column]) -> Column:
    return reduce(and_, conditions, F.lit(True)) if conditions else F.lit(True)


def any_of(conditions: list[Column]) -> Column:
    return reduce(or_, conditions) if conditions else F.lit(False)


def any_null(names: list[str]) -> Column:
    return any_of([F.col(name).isNull() for name in names])


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def is_float(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.FloatType, T.DoubleType))


def comparable_text(field: T.StructField) -> Column:
    """As `groupable_text`, but equal also for equal numbers, and equal times, of different types."""
    column = F.col(f"`{field.name}`")
    if is_float(field.dataType):
        whole = (F.abs(column) < 1e18) & (column == F.floor(column))
        return F.when(whole, column.cast("decimal(38,0)").cast("string")).otherwise((column + F.lit(0.0)).cast("double").cast("string"))
    if isinstance(field.dataType, T.DecimalType) and field.dataType.scale > 0:
        return F.regexp_replace(column.cast("string"), r"\.?0+$", "")
    if isinstance(field.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(column.cast("timestamp")).cast("string")
    return groupable_text(field)


def groupable_text(field: T.StructField) -> Column:
    """Text that is equal exactly when the values are, for counting distinct values.

    Long texts are replaced by a digest of the whole text so that they are not
    shuffled in full.
    """
    column = F.col(f"`{field.name}`")
    if is_float(field.dataType):
        column = column + F.lit(0.0).cast(field.dataType)  # -0.0 equals 0.0
    elif isinstance(field.dataType, T.TimestampType):
        column = F.unix_micros(column)
    elif isinstance(field.dataType, T.StringType):
        return F.when(F.length(column) > 64, F.concat(F.lit("#"), F.sha2(column, 256))).otherwise(
            F.concat(F.lit("="), column)
        )
    return column.cast("string")
