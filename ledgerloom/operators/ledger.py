"""Journal checks, posting decisions, corrections and balances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.columns import MONEY_TOTAL, all_of, is_blank, same, total, zero
from ledgerloom.functions.skew import join_hot

DIMENSIONS = ["site_id", "cost_center_id", "business_unit_id"]


def journal_query(
    entries: DataFrame,
    lines: DataFrame,
    source_type: str | None = None,
    source_id=None,
    date_from=None,
    date_to=None,
    dims: dict | None = None,
) -> DataFrame:
    """Lines of the entries that meet every given filter; both dates are inclusive."""
    wanted = [
        *([F.col("source_type") == source_type] if source_type is not None else []),
        *([F.col("source_id") == source_id] if source_id is not None else []),
        *([F.col("entry_date") >= F.lit(date_from).cast("date")] if date_from is not None else []),
        *([F.col("entry_date") <= F.lit(date_to).cast("date")] if date_to is not None else []),
    ]
    kept = lines.filter(all_of([F.col(c) == value for c, value in (dims or {}).items()]))
    return entries.filter(all_of(wanted)).join(kept, "entry_id")


def _with_sums(entries: DataFrame, lines: DataFrame) -> DataFrame:
    """Entries with debits, credits, their difference and number of lines, and whether they balance."""
    sums = lines.groupBy("entry_id").agg(
        total("debit").alias("debit"), total("credit").alias("credit"), F.count(F.lit(1)).alias("line_count")
    )
    checked = entries.join(sums, "entry_id", "left").withColumns({
        "debit": F.coalesce("debit", zero()), "credit": F.coalesce("credit", zero()),
        "line_count": F.coalesce("line_count", F.lit(0)),
    })
    diff = (F.col("debit") - F.col("credit")).cast(MONEY_TOTAL)
    return checked.withColumn("diff", diff).withColumn("balanced", (F.col("line_count") > 0) & (F.col("diff") == 0))


def balance_check(entries: DataFrame, lines: DataFrame) -> DataFrame:
    """Debits, credits and their difference per entry; an entry needs lines to balance."""
    return _with_sums(entries.select("entry_id"), lines).select(
        "entry_id", "debit", "credit", "diff", "line_count", "balanced"
    )


def period_days(periods: DataFrame, *extra: str) -> DataFrame:
    """One row per day that some period covers, with the number of periods covering it.

    Turning ranges into days makes period lookup an equality join, which is hashed or
    broadcast like any other, instead of comparing each entry with each period.
    """
    days = periods.filter("start_date <= end_date").select(
        F.explode(F.sequence("start_date", "end_date")).alias("day"), "period_id", *extra
    )
    return days.groupBy("day").agg(
        F.count(F.lit(1)).alias("match_count"),
        F.min("period_id").alias("period_id"),
        *[F.min(name).alias(name) for name in extra],
    )


def assign_period(entries: DataFrame, periods: DataFrame, date: str = "entry_date", extra: tuple = ()) -> DataFrame:
    """Add the period that holds the date (the day of a timestamp), both ends inclusive, and how many hold it.

    Anything but one match is an error, and the period is then NULL.
    """
    days = period_days(periods, *extra)
    one = F.col("match_count") == 1
    return entries.join(days, F.col(date).cast("date") == F.col("day"), "left").select(
        *[F.col(c) for c in entries.columns],
        *[F.when(one, F.col(name)).alias(name) for name in ("period_id", *extra)],
        F.coalesce("match_count", F.lit(0)).alias("match_count"),
    )


def period_calendar_check(periods: DataFrame, calendar: list[str] | None = None) -> DataFrame:
    """Periods that are inverted, start before an earlier one ends, or leave a gap.

    Compared with the latest end of all earlier periods, so nested ranges count. The
    window holds one calendar's periods, not ledger rows.
    """
    earlier = (
        Window.partitionBy(*(calendar or [])).orderBy("start_date", "end_date", "period_id")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ends = F.max(F.greatest("start_date", "end_date")).over(earlier)
    issues = F.array_compact(
        F.array(
            F.when(F.col("start_date") > F.col("end_date"), "inverted"),
            F.when(F.col("start_date") <= F.col("ends"), "overlap"),
            F.when(F.col("start_date") > F.date_add("ends", 1), "gap"),
        )
    )
    return periods.withColumn("ends", ends).select(*(calendar or []), "period_id", F.explode(issues).alias("issue"))


def classify_posting(entries: DataFrame, lines: DataFrame, periods: DataFrame) -> DataFrame:
    """Whether each entry may be posted, and the first rule that forbids it."""
    dated = assign_period(entries, periods, extra=("status",)) if "status" not in entries.columns else assign_period(
        entries.withColumnRenamed("status", "entry_status"), periods, extra=("status",)
    )
    checked = _with_sums(dated, lines)
    period = F.col("status")
    reason = (
        F.when(F.col("entry_status") == "posted", "already_posted")
        .when(F.col("line_count") == 0, "no_lines")
        .when(~F.col("balanced"), "unbalanced")
        .when(F.col("match_count") == 0, "no_period")
        .when(F.col("match_count") > 1, "ambiguous_period")
        .when(period == "closed", "period_closed")
        .when(period.isNull() | ~period.isin("open", "reopened"), "period_not_open")
        .when((period == "reopened") & ~F.coalesce("is_adjusting", F.lit(False)), "reopened_requires_adjusting")
        .when(F.coalesce("is_adjusting", F.lit(False)) & is_blank(F.col("adjusting_reason")), "adjusting_reason_required")
    )
    return checked.select(
        "entry_id", F.when(reason.isNull(), "post").otherwise("reject").alias("decision"), reason.alias("reason")
    )


def reversal_entries(
    entries: DataFrame, lines: DataFrame, ids: DataFrame, date, prefix: str = "REV-"
) -> tuple[DataFrame, DataFrame]:
    """Draft entries and lines that undo posted entries; the originals are not touched.

    ``ids`` has a column entry_id. Drafts cannot be reversed and are left out. Ids of the
    new entries are text: the prefix and the original id.
    """
    undone = entries.filter("status = 'posted'").join(ids.select("entry_id").distinct(), "entry_id", "left_semi")
    new_id = F.concat(F.lit(prefix), F.col("entry_id").cast("string"))
    new_entries = undone.select(
        new_id.alias("entry_id"), F.lit(date).cast("date").alias("entry_date"),
        F.lit("reversal").alias("source_type"), F.col("entry_id").cast("string").alias("source_id"),
        F.lit("draft").alias("status"), F.col("entry_id").alias("reverses_entry_id"),
    )
    rest = [c for c in lines.columns if c not in ("entry_id", "debit", "credit")]
    new_lines = join_hot(lines, undone.select("entry_id"), ["entry_id"], "left_semi").select(
        new_id.alias("entry_id"), *rest, F.col("credit").alias("debit"), F.col("debit").alias("credit"),
    )
    return new_entries, new_lines


def correcting_entries(
    entries: DataFrame, lines: DataFrame, corrections: DataFrame, corrected_lines: DataFrame, date
) -> DataFrame:
    """Reversal and replacement of posted entries, with the check each must pass.

    ``corrections`` has columns entry_id (of the new entry) and corrects_entry_id.
    """
    new_entries, new_lines = reversal_entries(
        entries, lines, corrections.select(F.col("corrects_entry_id").alias("entry_id")), date
    )
    replaced = corrections.join(
        new_entries.select(F.col("reverses_entry_id").alias("corrects_entry_id")), "corrects_entry_id", "left_semi"
    )
    both = new_entries.select("entry_id", F.lit("reversal").alias("role"), F.col("reverses_entry_id").alias("original_id"))
    both = both.unionAll(
        replaced.select(F.col("entry_id").cast("string"), F.lit("correction"), F.col("corrects_entry_id"))
    )
    amounts = new_lines.select("entry_id", "debit", "credit").unionAll(
        corrected_lines.select(F.col("entry_id").cast("string"), "debit", "credit")
    )
    return both.join(balance_check(both, amounts), "entry_id")


def posted_lines(entries: DataFrame, lines: DataFrame, as_of=None, *columns: str) -> DataFrame:
    """Lines of posted entries up to a date, with the entry columns asked for."""
    posted = entries.filter("status = 'posted'")
    if as_of is not None:
        posted = posted.filter(F.col("entry_date") <= F.lit(as_of).cast("date"))
    return lines.join(posted.select("entry_id", *columns), "entry_id")


def _sums() -> list[Column]:
    return [total("debit").alias("debit"), total("credit").alias("credit")]


def _net() -> Column:
    return (F.col("debit") - F.col("credit")).cast(MONEY_TOTAL).alias("net")


def trial_balance(entries: DataFrame, lines: DataFrame, accounts: DataFrame, as_of=None) -> DataFrame:
    """Totals of posted entries per account; accounts without activity show zero."""
    sums = posted_lines(entries, lines, as_of).groupBy("account_id").agg(*_sums())
    return accounts.select("account_id").join(sums, "account_id", "full_outer").select(
        "account_id", F.coalesce("debit", zero()).alias("debit"), F.coalesce("credit", zero()).alias("credit")
    ).select("*", _net())


def balances_by_dimension(
    entries: DataFrame,
    lines: DataFrame,
    dims: list[str] | None = None,
    mode: str = "rollup",
    as_of=None,
    sets: list[list[str]] | None = None,
) -> DataFrame:
    """Balances by dimension with subtotals.

    ``gid`` is the grouping id: its bit is set where a NULL stands for a subtotal and
    clear where the line really has no value. Lines are first reduced to one row per
    combination of dimensions, so only that small result is expanded into subtotals.
    """
    dims = dims or DIMENSIONS
    finest = posted_lines(entries, lines, as_of).groupBy(*dims).agg(*_sums(), F.count(F.lit(1)).alias("lines"))
    if mode == "rollup":
        grouped = finest.rollup(*dims)
    elif mode == "cube":
        grouped = finest.cube(*dims)
    elif mode == "sets":
        grouped = finest.groupingSets([[F.col(c) for c in one] for one in sets or []], *[F.col(c) for c in dims])
    else:
        raise ValueError(f"unknown mode {mode}")
    summed = grouped.agg(F.grouping_id().cast("long").alias("gid"), *_sums(), F.sum("lines").alias("lines"))
    return summed.select(*dims, "gid", "debit", "credit", _net(), "lines")


def immutability_audit(
    before: DataFrame, after: DataFrame, keys: list[str], cols: list[str], posted: Column | None = None
) -> DataFrame:
    """Rows frozen in ``before`` that changed or are gone in ``after``.

    ``posted`` says which rows are frozen; all of them by default. New rows are fine.
    """
    old = before.filter(posted) if posted is not None else before
    old = old.select(*[F.col(k).alias(f"key/{k}") for k in keys], F.struct(*cols).alias("old"))
    new = after.select(*[F.col(k).alias(f"now/{k}") for k in keys], F.struct(*cols).alias("new"), F.lit(True).alias("kept"))
    match = all_of([same(F.col(f"`key/{k}`"), F.col(f"`now/{k}`")) for k in keys])
    change = F.when(F.col("kept").isNull(), "deleted").when(~same(F.col("old"), F.col("new")), "updated")
    return (
        old.join(new, match, "left").withColumn("change", change).filter("change is not null")
        .select(*[F.col(f"`key/{k}`").alias(k) for k in keys], "change")
    )


def opening_balances(
    entries: DataFrame,
    lines: DataFrame,
    cutover_date,
    dims: list[str] | None = None,
    entry_id: str = "OPENING",
    balancing_account: int | None = None,
) -> DataFrame:
    """Lines of one opening entry that carries the balances before a date.

    Zero balances are dropped. The entry balances when the ledger does; with
    ``balancing_account`` a remaining difference is booked there.
    """
    dims = DIMENSIONS if dims is None else dims
    before = F.date_sub(F.lit(cutover_date).cast("date"), 1)
    nets = (
        posted_lines(entries, lines, before).groupBy("account_id", *dims)
        .agg((total("debit") - total("credit")).cast(MONEY_TOTAL).alias("net"))
    )
    if balancing_account is not None:
        # One more grouping over the balances gives what is left to book.
        columns = ["account_id", *dims]
        grouped = nets.groupingSets([[F.col(c) for c in columns], []], *[F.col(c) for c in columns])
        rest = F.grouping_id() != 0
        nets = grouped.agg(rest.alias("rest"), total("net").alias("sum")).select(
            F.when(F.col("rest"), F.lit(balancing_account)).otherwise(F.col("account_id")).alias("account_id"), *dims,
            F.when(F.col("rest"), -F.col("sum")).otherwise(F.col("sum")).alias("net"),
        )
    debit = F.when(F.col("net") > 0, F.col("net")).otherwise(zero())
    credit = F.when(F.col("net") < 0, -F.col("net")).otherwise(zero())
    return nets.filter("net <> 0").select(
        F.lit(entry_id).alias("entry_id"), "account_id", *dims,
        debit.cast(MONEY_TOTAL).alias("debit"), credit.cast(MONEY_TOTAL).alias("credit"),
    )
