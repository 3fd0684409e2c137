"""Cutover: crosswalks, repeatable loads, reconciliation and fitness checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY_TOTAL, all_of, same, total, zero


def apply_crosswalk(
    df: DataFrame, mapping: DataFrame, old: str, new: str
) -> tuple[DataFrame, DataFrame]:
    """Translate a code column; returns the mapped rows and the codes that do not map.

    ``mapping`` has the columns ``old`` and ``new`` with one row per old code. Unmapped
    codes come with their number of rows, NULL among them.
    """
    mapped = df.join(mapping.select(old, new), old)
    unmapped = (
        df.groupBy(F.col(old).alias("code")).agg(F.count(F.lit(1)).alias("rows"))
        .join(mapping.select(F.col(old).alias("code")), "code", "left_anti")
    )
    return mapped, unmapped


def idempotent_load(target: DataFrame, batch: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """The table after loading a batch; loading it again changes nothing.

    Without ``order`` rows whose key is already there are ignored. With it the row
    with the highest value wins. A key that occurs several times in the batch counts
    once: the smallest row, or with ``order`` the largest, is taken.
    """
    columns = target.columns
    rest = [c for c in columns if c not in keys and c != order]

    def one_per_key(df: DataFrame, pick) -> DataFrame:
        row = F.struct(*([order] if order else []), *rest)
        return df.groupBy(*keys).agg(pick(row).alias("row")).select(*keys, "row.*").select(*columns)

    if order is None:
        fresh = one_per_key(batch.select(columns), F.min)
        known = target.select(*[F.col(k).alias(f"known/{k}") for k in keys])
        match = all_of([same(F.col(k), F.col(f"`known/{k}`")) for k in keys])
        return target.unionByName(fresh.join(known, match, "left_anti"))
    return one_per_key(target.unionByName(batch.select(columns)), F.max)


def reconcile(
    left: DataFrame, right: DataFrame, keys: list[str], measures: list[str], tol=0
) -> DataFrame:
    """Compare counts and totals of two sources by key.

    Both sides are summed by key first; keys match null-safe. A measure that differs by
    more than ``tol``, or another number of rows, makes the status ``differ``.
    """
    def summed(df: DataFrame, side: str) -> DataFrame:
        return df.groupBy(*[F.col(k).alias(f"{side}/{k}") for k in keys]).agg(
            F.count(F.lit(1)).alias(f"{side}_rows"), *[total(m).alias(f"{side}_{m}") for m in measures]
        )

    both = summed(left, "left").join(
        summed(right, "right"), all_of([same(F.col(f"`left/{k}`"), F.col(f"`right/{k}`")) for k in keys]), "full_outer"
    )
    numbers = ["rows", *measures]

    def value(side: str, name: str) -> Column:
        return F.coalesce(f"{side}_{name}", F.lit(0).cast("long") if name == "rows" else zero())

    def diff(name: str) -> Column:
        kind = "long" if name == "rows" else MONEY_TOTAL
        return (value("left", name) - value("right", name)).cast(kind)

    equal = all_of([diff("rows") == 0, *[F.abs(diff(m)) <= F.lit(tol) for m in measures]])
    status = (
        F.when(F.col("right_rows").isNull(), "left_only").when(F.col("left_rows").isNull(), "right_only")
        .when(equal, "match").otherwise("differ")
    )
    return both.select(
        *[F.coalesce(F.col(f"`left/{k}`"), F.col(f"`right/{k}`")).alias(k) for k in keys],
        *[column for name in numbers for column in (
            value("left", name).alias(f"left_{name}"), value("right", name).alias(f"right_{name}"),
            diff(name).alias(f"diff_{name}"),
        )],
        status.alias("status"),
    )


def trial_balance_compare(legacy_tb: DataFrame, new_tb: DataFrame, account_map: DataFrame, tol=0) -> DataFrame:
    """Legacy against new trial balance through the account crosswalk.

    ``legacy_tb`` has legacy_account, debit, credit. Accounts that do not map stay
    visible: they are compared as NULL.
    """
    legacy = legacy_tb.join(account_map, "legacy_account", "left").select("account_id", "debit", "credit")
    return reconcile(legacy, new_tb.select("account_id", "debit", "credit"), ["account_id"], ["debit", "credit"], tol)


def lossless_check(df: DataFrame, target_schema: dict[str, str]) -> DataFrame:
    """Can the target schema hold the data?

    ``target_schema`` maps a column to a type such as ``decimal(9,2)``, ``varchar(20)`` or
    ``int``, optionally followed by ``not null``. A value is lossy when it is longer than the
    target allows, does not survive the cast there and back, or is NULL where that
    is forbidden. One pass over the table.
    """
    measures, entries = [], []
    for i, (name, spec) in enumerate(target_schema.items()):
        kind = spec.lower().strip()
        required = kind.endswith("not null")
        kind = kind.removesuffix("not null").strip()
        column, source = F.col(f"`{name}`"), df.schema[name].dataType.simpleString()
        if kind.startswith(("varchar(", "char(")):
            lossy = F.length(column.cast("string")) > int(kind[kind.index("(") + 1:-1])
        else:
            lossy = ~same(column.try_cast(kind).try_cast(source), column)
        lossy = F.when(column.isNull(), F.lit(required)).otherwise(lossy)
        measures += [
            F.count_if(lossy).alias(f"{i}_lossy"), F.min(F.when(lossy, column.cast("string"))).alias(f"{i}_example"),
        ]
        entries.append(
            F.struct(F.lit(name).alias("column"), F.col(f"{i}_lossy").alias("lossy_rows"), F.col(f"{i}_example").alias("example"))
        )
    return df.agg(F.count(F.lit(1)).alias("rows"), *measures).select(F.inline(F.array(*entries)), "rows").select(
        "column", "rows", "lossy_rows", "example"
    )


def fiscal_calendar_profile(periods: DataFrame, journal: DataFrame) -> DataFrame:
    """Shape of each fiscal calendar and how the journal fits it.

    ``periods`` has calendar, fiscal_year, period_no, is_closing; ``journal`` has calendar,
    fiscal_year, period_no. Counts fiscal years, the fewest and most regular periods of a year, closing
    periods, rows stored under period 0, and periods the journal uses that do not exist, with their rows.
    """
    key = ["calendar", "fiscal_year", "period_no"]
    stored = journal.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    known = periods.select(*key).distinct()
    lost = stored.join(known, key, "left_anti").groupBy("calendar").agg(
        F.count(F.lit(1)).alias("unmatched_periods"), F.sum("n").alias("unmatched_rows"))
    zeros = stored.groupBy("calendar").agg(F.sum(F.when(F.col("period_no") == 0, F.col("n"))).alias("journal_zero"))
    years = periods.groupBy("calendar", "fiscal_year").agg(
        F.count_if(~F.col("is_closing")).alias("regular"), F.count_if("is_closing").alias("closing"),
        F.max(F.when(~F.col("is_closing"), F.col("period_no"))).alias("last_period_no"),
        F.count_if(F.col("period_no") == 0).alias("zero"),
    )
    none = F.lit(0).cast("long")
    return (
        years.groupBy("calendar").agg(
            F.count(F.lit(1)).alias("years"), F.min("regular").alias("least_periods"), F.max("regular").alias("most_periods"),
            F.sum("closing").alias("closing_periods"), F.max("last_period_no").alias("last_period_no"),
            F.sum("zero").alias("calendar_zero"),
        )
        .join(zeros, "calendar", "full_outer").join(lost, "calendar", "left")
        .select(
            "calendar", *[F.coalesce(c, none).alias(c) for c in ("years", "least_periods", "most_periods", "closing_periods")],
            "last_period_no",
            (F.coalesce("calendar_zero", none) + F.coalesce("journal_zero", none)).alias("period0_rows"),
            *[F.coalesce(c, none).alias(c) for c in ("unmatched_periods", "unmatched_rows")],
        )
    )


def _party_name(name: str | Column) -> Column:
    return F.upper(F.trim(F.col(name) if isinstance(name, str) else name))


def party_master(parties: DataFrame) -> DataFrame:
    """One row per party name with what it is to us and how many ids it has.

    ``parties`` has kind (customer or vendor), name, external_id and optionally active.
    The ids themselves are rows of `party_ids`: a name such as an empty
    one may carry any number of them.
    """
    active = F.col("active") if "active" in parties.columns else F.lit(True)
    ids = parties.groupBy(_party_name("name").alias("name_key"), "kind", "external_id").agg(F.max(active).alias("active"))
    customer = F.max(F.col("kind") == "customer")
    vendor = F.max(F.col("kind") == "vendor")
    return ids.groupBy("name_key").agg(
        F.when(customer & vendor, "both").when(customer, "customer").otherwise("vendor").alias("type"),
        F.max("active").alias("active"), F.count("external_id").alias("external_id_count"),
        F.min("external_id").alias("first_external_id"),
    )


def party_ids(parties: DataFrame) -> DataFrame:
    """The external ids of each party, one per row."""
    return parties.select(_party_name("name").alias("name_key"), "kind", "external_id").distinct()


def except_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, with how many copies.

    Both sides are counted as multisets in one aggregation; copies are not spelled out.
    """
    if len(a.columns) != len(b.columns):
        raise ValueError("both sides need the same columns")
    b = b.select(a.columns)
    signed = a.withColumn("copies", F.lit(1).cast("long")).unionByName(b.withColumn("copies", F.lit(-1).cast("long")))
    counted = signed.groupBy(*[F.col(f"`{c}`") for c in a.columns]).agg(F.sum("copies").alias("copies"))
    return counted.filter("copies <> 0").select(
        *[F.col(f"`{c}`") for c in a.columns], F.when(F.col("copies") > 0, "left").otherwise("right").alias("side"),
        F.abs("copies").alias("copies"),
    )


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: how many rows each side has too many, and whether both are equal."""
    counts = except_rows(a, b).agg(
        F.coalesce(F.sum(F.when(F.col("side") == "left", F.col("copies"))), F.lit(0)).alias("left_extra"),
        F.coalesce(F.sum(F.when(F.col("side") == "right", F.col("copies"))), F.lit(0)).alias("right_extra"),
    )
    return counts.withColumn("same", (F.col("left_extra") == 0) & (F.col("right_extra") == 0))
